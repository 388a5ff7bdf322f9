"""Engine tables at rest: Parquet with explicit schemas."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from leadloom.operators.store import conform
from leadloom.schemas import columns, schema

# Date column by which the growing tables are partitioned, so day ranges prune files.
DAY_OF = {
    "leads": "order_dt",
    "lead_requests": "order_dt",
    "status_log": "status_dt",
    "inquiry_log": "dtm_crt",
    "api_request_log": "request_dt",
    "api_response_log": "response_dt",
}


def read_days(spark: SparkSession, path: str, table: str) -> DataFrame:
    """All columns of a stored table, and `day` where it is kept by day."""
    fields = schema(table).fields
    if table in DAY_OF:
        fields = [*fields, StructField("day", DateType())]
    return spark.read.schema(StructType(fields)).parquet(path)


def stored_day(day: date | None) -> str:
    """Name of the folder of a day; rows without a date have one of their own."""
    return f"day={day or '__HIVE_DEFAULT_PARTITION__'}"


def with_day(rows: DataFrame, table: str) -> DataFrame:
    """Rows in the form of a stored table with their `day`, dealt so that a day has few files."""
    rows = conform(rows, table).withColumn("day", F.to_date(DAY_OF[table]))
    # Adaptive execution splits a large day over several tasks and puts small ones together.
    return rows.hint("rebalance", "day")


def read_table(
    spark: SparkSession,
    path: str,
    table: str,
    first_day: date | None = None,
    last_day: date | None = None,
) -> DataFrame:
    """Scan one engine table; the schema is given, not inferred.

    A range of days, both included, reads only their directories.
    """
    rows = read_days(spark, path, table)
    if first_day is not None:
        rows = rows.filter(F.col("day") >= F.lit(first_day))
    if last_day is not None:
        rows = rows.filter(F.col("day") <= F.lit(last_day))
    return rows.select(*columns(table))


def append_table(rows: DataFrame, path: str, table: str) -> None:
    """Append rows, one directory per day where the table has a day column."""
    _write(rows, path, table, "append")


def write_version(rows: DataFrame, path: str, table: str) -> None:
    """Write a new version of a table to a path that does not exist yet."""
    _write(rows, path, table, "errorifexists")


def _write(rows: DataFrame, path: str, table: str, mode: str) -> None:
    if table not in DAY_OF:
        conform(rows, table).write.mode(mode).parquet(path)
        return
    with_day(rows, table).write.mode(mode).partitionBy("day").parquet(path)
