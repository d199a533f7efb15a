"""Writers. No path is overwritten while it is read: what replaces a table is written beside it and takes its name."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.functions.text import row_key
from ordermill.operators.keyed import merged
from ordermill.sources import files


def recover(spark: SparkSession, path: str) -> None:
    """Puts a table back into its place that a crash between two renamings left without one: the complete new version,
    else the old one."""
    if files.exists(spark, path):
        return
    for kind in ("new", "bak"):
        whole = [p for p in files.matching(spark, f"{path}.{kind}.*") if files.exists(spark, f"{p}/_SUCCESS")]
        if whole:
            files.rename(spark, whole[-1], path)
            return


def table(spark: SparkSession, path: str) -> DataFrame:
    """A table that these writers keep, recovered first if need be."""
    recover(spark, path)
    return spark.read.parquet(path)


def _replace(df: DataFrame, path: str, keep: bool = False) -> str | None:
    """Writes df beside path and swaps names; returns where the old table went, if it is kept."""
    spark, stamp = df.sparkSession, time.time_ns()
    fresh, old = f"{path}.new.{stamp}", f"{path}.bak.{stamp}"
    df.write.parquet(fresh)
    had = files.exists(spark, path)
    if had:
        files.rename(spark, path, old)
    files.rename(spark, fresh, path)
    if had and not keep:
        files.remove(spark, old)
    return old if had and keep else None


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append_aligned(df: DataFrame, path: str, keys: list[str]) -> str | None:
    """Appends; where columns differ, both sides are aligned by name (as text where their types differ), the last row of
    each key is kept, and the table is replaced. Returns where the former table is kept in that case."""
    spark = df.sparkSession
    recover(spark, path)
    if not files.exists(spark, path):
        df.write.parquet(path)
        return None
    old = spark.read.parquet(path)
    if old.dtypes == df.dtypes:
        append(df, path)
        return None
    kinds = dict(old.dtypes)
    other = {c for c, k in df.dtypes if kinds.get(c, k) != k}
    text = lambda x: x.select(*[F.col(c).cast("string").alias(c) if c in other else F.col(c) for c in x.columns])
    both = text(old).withColumn("_new", F.lit(0)).unionByName(text(df).withColumn("_new", F.lit(1)), allowMissingColumns=True)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("_new"), *[F.desc(c) for c in df.columns if c not in keys]))
    last = both.withColumn("_rank", rank).filter("_rank = 1").drop("_rank", "_new").na.fill("")
    return _replace(last, path, keep=True)


def backup(df: DataFrame, folder: str, label: str) -> str:
    path = f"{folder}/{label}_{time.strftime('%Y%m%d_%H%M%S', time.gmtime())}_{time.time_ns() % 1000000}"
    df.write.parquet(path)
    return path


def register(df: DataFrame, path: str, keys: list[str]) -> None:
    """Adds the keys of df to the registry; known ones stay as they are."""
    fresh = df.select(row_key(*[F.col(k) for k in keys]).alias("row_key")).distinct()
    if files.exists(df.sparkSession, path):
        fresh = fresh.join(df.sparkSession.read.parquet(path).select("row_key"), "row_key", "left_anti")
    fresh.withColumn("registered_at", F.current_timestamp()).write.mode("append").parquet(path)


def upsert(updates: DataFrame, path: str, key: str) -> None:
    """Inserts or merges by key; unset fields of an update keep the old value."""
    recover(updates.sparkSession, path)
    if not files.exists(updates.sparkSession, path):
        updates.write.parquet(path)
        return
    _replace(merged(updates.sparkSession.read.parquet(path), updates, key), path)


def replace_where(df: DataFrame, path: str, condition: str) -> None:
    """The table without the rows that meet the condition, and df."""
    spark: SparkSession = df.sparkSession
    kept = spark.read.parquet(path).filter(f"not coalesce({condition}, false)")
    _replace(kept.unionByName(df, allowMissingColumns=True), path)


def split_by(df: DataFrame, path: str, column: str) -> None:
    """One folder per value of the column."""
    df.write.mode("overwrite").partitionBy(column).parquet(path)


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def text_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def audit(df: DataFrame, path: str) -> None:
    """Appends records of a run below its day; nothing that is there is read or rewritten."""
    df.withColumn("run_date", F.date_format(F.coalesce(F.col("timestamp").try_cast("timestamp"), F.current_timestamp()), "yyyy-MM-dd")).write.mode("append").partitionBy("run_date").json(path)


def sheets(tables: dict[str, DataFrame], folder: str) -> None:
    """A report of several tables: one CSV folder each."""
    for name, df in tables.items():
        text_table(df, f"{folder}/{name}")


def load(tables: dict[str, DataFrame], folder: str, index: dict[str, list[str]] | None = None) -> dict[str, int]:
    """Writes tables as Parquet, ordered within files by their lookup columns (so scans can skip row groups), registers
    them as views and returns their counts."""
    counts = {}
    for name, df in tables.items():
        keys = (index or {}).get(name)
        (df.repartitionByRange(*keys).sortWithinPartitions(*keys) if keys else df).write.mode("overwrite").parquet(f"{folder}/{name}")
        written = df.sparkSession.read.parquet(f"{folder}/{name}")
        written.createOrReplaceTempView(name)
        counts[name] = written.count()
    return counts


def migrate(source: DataFrame, path: str, key: str) -> int:
    """Merges source into a keyed table and returns how many of its keys that then lacks: 0 if all went well."""
    upsert(source, path, key)
    return source.select(key).distinct().join(table(source.sparkSession, path), key, "left_anti").count()


def restore(parts: list[DataFrame], path: str, keys: list[str], order: str) -> None:
    """A table anew from saved parts, aligned by name as text; the last row of each key by order counts."""
    from functools import reduce

    from ordermill.operators.keyed import keep_first

    text = [p.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in p.columns]) for p in parts]
    all_ = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), text).na.fill("")
    _replace(keep_first(all_, keys, [order, *[c for c in all_.columns if c not in keys and c != order]], last=True), path)


def report(df: DataFrame, path: str) -> None:
    """A small result as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)
