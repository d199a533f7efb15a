"""Keyed tables: deduplication, registries, merges, comparisons, set operations, numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions.text import row_key
from ordermill.session import cut


def keep_first(df: DataFrame, keys: list[str], order: list[str], last: bool = False) -> DataFrame:
    """One row per key, the first (or last) by order: an aggregation, so rows of a hot key are combined before the shuffle."""
    at = F.struct(*order)
    row = F.struct(*df.columns)
    best = F.max_by(row, at) if last else F.min_by(row, at)
    return df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(best.alias("_r")).select("_r.*")


def not_yet(df: DataFrame, registry: DataFrame, keys: list[str], key: str = "row_key") -> DataFrame:
    """Rows whose key isn't registered, each key once (the first by all columns)."""
    keyed = df.withColumn(key, row_key(*[F.col(k) for k in keys]))
    fresh = keyed.join(registry.select(key).distinct(), key, "left_anti")
    return keep_first(fresh, [key], keys + [c for c in df.columns if c not in keys])


def merged(base: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """base with updates by key: set fields of the update win, unset ones keep the old value, new keys are added."""
    columns = list(dict.fromkeys([*base.columns, *updates.columns]))
    a, b = base.alias("a"), updates.alias("b")
    pick = []
    for c in columns:
        if c == key:
            pick.append(F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}")).alias(c))
        elif c in updates.columns and c in base.columns:
            pick.append(F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}")).alias(c))
        else:
            pick.append(F.col(f"{'b' if c in updates.columns else 'a'}.{c}").alias(c))
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer").select(*pick)


def compared(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """key, field, outcome for every field of a full comparison: same, changed, only_left, only_right."""
    a, b = left.select(key, *[F.col(c).cast("string").alias(f"l_{c}") for c in columns], F.lit(1).alias("in_l")), right.select(key, *[F.col(c).cast("string").alias(f"r_{c}") for c in columns], F.lit(1).alias("in_r"))
    both = a.join(b, key, "full_outer")
    outcome = lambda c: F.when(F.col("in_r").isNull(), "only_left").when(F.col("in_l").isNull(), "only_right").when(F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}")), "same").otherwise("changed")
    return both.select(key, F.inline(F.array(*[F.struct(F.lit(c).alias("field"), outcome(c).alias("outcome")) for c in columns])))


def in_window_or_all(df: DataFrame, inside: Column) -> DataFrame:
    """Rows inside the window; all rows if none is. The question is answered by one aggregate, not by a window over all rows."""
    n = df.agg(F.count_if(inside).alias("_inside"))
    return df.crossJoin(F.broadcast(n)).filter(inside | (F.col("_inside") == 0)).drop("_inside")


def numbered(df: DataFrame, prefix: str, keys: list[str], order: list[str], digits: int = 4) -> DataFrame:
    """Numbers within each key, as text: 'SO-0001'."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("number", F.format_string(f"{prefix}-%0{digits}d", n))


def one_of(df: DataFrame, *lookups: tuple[DataFrame, str]) -> DataFrame:
    """Adds flag: whether any lookup holds the row's key; each is a semi join on distinct keys."""
    out, flags = df, []
    for i, (other, key) in enumerate(lookups):
        out = out.join(other.select(key).distinct().withColumn(f"_f{i}", F.lit(True)), key, "left")
        flags.append(F.coalesce(F.col(f"_f{i}"), F.lit(False)))
    found = flags[0]
    for f in flags[1:]:
        found = found | f
    return out.withColumn("flag", found).drop(*[f"_f{i}" for i in range(len(lookups))])


def placed(df: DataFrame, order: list[str]) -> DataFrame:
    """Adds place, 1 to n over all rows by order, without one sorted task: rows are ranged and written once, counted by
    range, and numbered inside. Rows must differ in order."""
    ranged = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id()))
    before = ranged.groupBy("_p").agg(F.count("*").alias("_n"), F.min("_i").alias("_first"))
    before = before.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # one row for each range
    return ranged.join(F.broadcast(before), "_p").select(*df.columns, (F.col("_before") + F.col("_i") - F.col("_first") + 1).alias("place"))
