"""Request batches from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    """Request batch from text files with one JSON body per line.

    A request is named by its file and its place in the scan. Both are fixed by the files and
    their splits, so a lost task reads the same requests again; `arrival_seq` is unique and
    increasing, not dense.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("body"),
        F.monotonically_increasing_id().alias("arrival_seq"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("arrival_ts"),
    )
    return lines.select(
        F.concat_ws("#", "file", "arrival_seq").alias("request_id"),
        "arrival_seq",
        "arrival_ts",
        "body",
    )
