"""Session defaults and lineage cuts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Joins with stored tables carry no broadcast hints: Spark broadcasts a side only after checking
# its size, at plan time or from the measured shuffle size, and otherwise shuffles both sides. A
# hot key in such a shuffle is split by the skew rule, which must also act where it costs one more
# exchange.
_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A scan of stored rows beyond this size is first cut by a bloom filter of a small batch's keys.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "256MB",
    # A name repeated inside a nested value of a body is no reason to refuse the typed reading.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # The JVM never compiles a method beyond 8000 bytes: steps of wide rows that would give one run
    # faster as several generated projections than as one whole stage.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A task that writes a table by day needs no sort by day where it holds a few days only: rows of
    # one day compress so well in a shuffle that a task may get a gigabyte of them.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # Shuffle files go when the action that made them ends, not when the driver collects its garbage: a
    # plan in several steps then holds the files of one step on disk, not of all.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Turn on adaptive skew handling and lenient variants; timestamps are in UTC."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for lineage cuts that the cluster names in `spark.checkpoint.dir`.

    It must be storage that the driver and all executors see. A local session, whose driver and
    executors are one process, may do without and gets a folder in its warehouse; a cluster that
    names none is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"


def materialise(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write `df` once as Parquet in the shared folder and read it back.

    Used where several outputs share one plan: the work is not repeated per output, it survives
    the loss of executors, and each output reads only its own columns. `compression` is that of the
    session unless given.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/leadloom/{label}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", compression) if compression else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
