"""Streams: files that arrive, deduplicated and merged by batches; windows over event time."""

from __future__ import annotations

import time as clock
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ordermill.operators.keyed import keep_first
from ordermill.sources import files, sinks


def arriving(spark: SparkSession, folder: str, schema: T.StructType, per_batch: int = 100, form: str = "parquet") -> DataFrame:
    """A stream of the files that appear in a folder, at most per_batch in a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).format(form).load(folder)


def without_repeats(stream: DataFrame, keys: list[str], time: str, lateness: str = "7 days") -> DataFrame:
    """Repeats of a key within the lateness dropped; the state is bounded by it."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark(keys)


def windowed(stream: DataFrame, time: str, length: str, *by: str, lateness: str = "1 hour") -> DataFrame:
    """Counts per window of event time."""
    out = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, lateness).groupBy(F.window(time, length), *by).agg(F.count("*").alias("n"))
    return out.select(F.col("window.start").alias("window_start"), *by, "n")


def into_registry(stream: DataFrame, keys: list[str], order: list[str], table: str, registry: str, checkpoint: str, once: bool = True, every: str = "60 seconds") -> StreamingQuery:
    """Appends rows with new keys to table, each key once for ever: every batch is joined against the registry.

    A batch that is run again after a failure finds its keys registered with its own number and writes the same rows
    to the same folder, so nothing is lost or doubled.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        first = keep_first(batch, keys, order)
        if files.exists(spark, registry):
            known = spark.read.parquet(registry).filter(F.col("batch") != number).select(*keys)
            first = first.join(known, keys, "left_anti")
        first = first.persist()
        first.write.mode("overwrite").parquet(f"{table}/batch={number}")
        first.select(*keys).write.mode("overwrite").parquet(f"{registry}/batch={number}")
        first.unpersist()

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def latest_of(aggregate: DataFrame, keys: list[str], table: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Keeps the latest values of a streaming aggregate as a table: each batch's changed groups replace theirs."""

    def run(batch: DataFrame, _: int) -> None:
        changed = batch.withColumn("_key", F.to_json(F.struct(*keys)))
        sinks.upsert(changed, table, "_key")

    writer = aggregate.writeStream.outputMode("update").foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def worker(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, tries: int = 3, wait: float = 1.0, once: bool = True, every: str = "5 seconds") -> StreamingQuery:
    """At-least-once work on batches: a batch counts as done when handle returned; a failing one is tried again after
    growing waits, and in the next run if it fails to the end. handle must bear repetition (its number tells)."""
    writer = stream.writeStream.foreachBatch(retried(handle, tries, wait)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def retried(f: Callable, tries: int = 3, wait: float = 1.0, growth: float = 2.0) -> Callable:
    """f, called again after wait, wait * growth ... seconds if it raises; the last error goes through."""

    def run(*args):
        for i in range(tries):
            try:
                return f(*args)
            except Exception:
                if i == tries - 1:
                    raise
                clock.sleep(wait * growth**i)

    return run


def into_table(stream: DataFrame, key: str, order: list[str], table: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Keeps a keyed table at its latest state: the last row of a key in each batch is merged in."""

    def run(batch: DataFrame, _: int) -> None:
        sinks.upsert(keep_first(batch, [key], order, last=True), table, key)

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
