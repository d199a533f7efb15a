"""Profiles of tables: completeness, missing values by group, ambiguous mappings, modes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions.numbers import percent
from ordermill.functions.text import is_nullish


def completeness(df: DataFrame, columns: list[str] | None = None, policy: str = "profile") -> DataFrame:
    """column_name, total, missing, present, present_pct: one pass over the table, one row per column."""
    columns = columns or df.columns
    counts = df.agg(F.count("*").alias("total"), *[F.count_if(is_nullish(F.col(c).cast("string"), policy)).alias(f"m_{i}") for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"m_{i}").alias("missing")) for i, c in enumerate(columns)])
    return counts.select("total", F.inline(rows)).select("column_name", "total", "missing", (F.col("total") - F.col("missing")).alias("present"), percent(F.col("total") - F.col("missing"), F.col("total")).alias("present_pct"))


def missing_by_group(df: DataFrame, group: str, column: str, policy: str = "profile") -> DataFrame:
    out = df.groupBy(group).agg(F.count("*").alias("total"), F.count_if(is_nullish(F.col(column).cast("string"), policy)).alias("missing"))
    return out.withColumn("missing_pct", percent(F.col("missing"), F.col("total")))


def groups_without(df: DataFrame, group: str, condition: Column) -> DataFrame:
    """Groups none of whose rows meets the condition."""
    return df.groupBy(group).agg(F.bool_or(F.coalesce(condition, F.lit(False))).alias("_any")).filter("not _any").select(group)


def ambiguous(df: DataFrame, keys: list[str], value: str, more_than: int = 1) -> DataFrame:
    """Keys that map to several values, and to how many."""
    return df.groupBy(*keys).agg(F.count_distinct(value).alias("values")).filter(F.col("values") > more_than)


def mode_by(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """Most frequent value of each group and its count; of equals the one that came first by order.

    Counts are combined before the shuffle, so a hot group costs as many rows as it has different values.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(order).alias("_at"))
    best = F.min_by(F.struct(value, "n"), F.struct(-F.col("n"), "_at", value))
    return counted.groupBy(*keys).agg(best.alias("_b")).select(*keys, F.col(f"_b.{value}").alias(value), F.col("_b.n").alias("n"))


def mode_with_fallback(df: DataFrame, grains: list[list[str]], value: str, order: str) -> DataFrame:
    """Rows of the finest grain with the mode of the finest grain that has one, and its level (0 is the finest)."""
    out = df.select(*grains[0]).distinct()
    names = []
    for i, keys in enumerate(grains):
        m = mode_by(df, keys, value, order).select(*keys, F.col(value).alias(f"_m{i}"))
        out = out.join(m, keys, "left") if keys else out.crossJoin(F.broadcast(m))
        names.append(f"_m{i}")
    level = F.coalesce(*[F.when(F.col(n).isNotNull(), i) for i, n in enumerate(names)])
    return out.select(*grains[0], F.coalesce(*names).alias(value), level.alias("level"))


def first_filled_by(df: DataFrame, keys: list[str], values: list[str], order: str) -> DataFrame:
    """First value of each column that is not blank, by order; every column on its own."""
    return df.groupBy(*keys).agg(*[F.min_by(v, F.when(~is_nullish(F.col(v).cast("string"), "blank"), F.col(order))).alias(v) for v in values])


def listed(df: DataFrame, keys: list[str], value: str, separator: str = ", ") -> DataFrame:
    """Distinct values of each group, sorted and joined; '-' for none."""
    out = df.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(value)), separator).alias("listed"))
    return out.withColumn("listed", F.when(F.col("listed") == "", "-").otherwise(F.col("listed")))


def most_severe(df: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """Of each group the value that stands first in order."""
    rank = F.coalesce(*[F.when(F.col(value) == v, i) for i, v in enumerate(order)], F.lit(len(order)))
    return df.groupBy(*keys).agg(F.min_by(value, F.struct(rank, value)).alias(value))


def pivot_counts(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Counts of row x column, 0 where there are none; values are named, so no job looks for them."""
    return df.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(v) for v in values])


def coverage_of_first(df: DataFrame, key: str, group: str, column: str, order: str) -> DataFrame:
    """Per group: keys, and how many have a value in their first row by order."""
    first = df.groupBy(key).agg(F.min_by(F.struct(group, column), order).alias("r")).select(F.col(f"r.{group}").alias(group), F.col(f"r.{column}").alias(column))
    out = first.groupBy(group).agg(F.count("*").alias("keys"), F.count_if(~is_nullish(F.col(column).cast("string"))).alias("covered"))
    return out.withColumn("covered_pct", percent(F.col("covered"), F.col("keys")))


def top_groups(df: DataFrame, group: str, k: int) -> DataFrame:
    """The k largest groups, ties by name."""
    return df.groupBy(group).agg(F.count("*").alias("n")).orderBy(F.desc("n"), group).limit(k)


def cut_off(df: DataFrame, keys: list[str], size: str, order: list[str], limit: float, most: int | None = None) -> DataFrame:
    """Rows of each group in order until their sizes exceed limit: the first that would ends it, later small ones included."""
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn("_sum", F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_n", F.row_number().over(w))
    kept = (F.col("_sum") <= limit) & (F.col("_n") <= most if most else F.lit(True))
    return out.filter(kept).drop("_sum", "_n")


def listed_in_order(df: DataFrame, keys: list[str], value: str, order: str, separator: str = "; ") -> DataFrame:
    """Distinct values of each group in the order in which they first came, joined."""
    first = df.groupBy(*keys, value).agg(F.min(order).alias("_at"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", value))), lambda x: x[value].cast("string")), separator)
    return first.groupBy(*keys).agg(listed.alias("listed"))
