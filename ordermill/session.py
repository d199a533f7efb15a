"""Session set-up and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int = 8, shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the session is given."""
    builder = SparkSession.builder.master(f"local[{cores}]").config("spark.driver.memory", "12g")
    for key, value in {**DEFAULTS, "spark.sql.shuffle.partitions": str(shuffle_partitions), **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared checkpoint folder and cut its lineage.

    Reads spark.checkpoint.dir from the session. Only where that is unset (tests, a single machine) a folder
    is made under the local temporary directory.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(shared or "file://" + tempfile.mkdtemp(prefix="ordermill-"))
    return df.checkpoint(eager=True)


def spread(df: DataFrame, *keys: str, per_core: int = 3) -> DataFrame:
    """Repartition small files' rows over all cores; without keys round robin."""
    n = max(df.sparkSession.sparkContext.defaultParallelism * per_core, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(n, *keys)




def bind(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns behind a Generate node.

    The optimizer neither merges projections nor pushes filters through it, so an expression that later
    expressions use many times is evaluated once and the generated code stays small.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
