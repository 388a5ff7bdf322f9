"""Keys of stored leads in buckets, so that a batch finds its duplicates without shuffling them.

The table has the comparable order and partner of every lead, bucketed and sorted by both. A join on
these two columns sends the batch to the buckets and leaves the stored side where it is. Each appended
batch adds at most one file per bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.functions.text import key

BUCKETS = 64
KEYS = ("order_key", "partner_key")


def lead_keys(leads: DataFrame) -> DataFrame:
    """(order_key, partner_key) of leads; one without either key can have no duplicate."""
    keys = leads.select(key("order_id").alias(KEYS[0]), key("partner_id").alias(KEYS[1]))
    return keys.dropna().withColumn(KEYS[0], F.concat(KEYS[0], F.lit("")))


def append_lead_keys(leads: DataFrame, name: str, path: str, buckets: int = BUCKETS) -> None:
    """Add the keys of new leads to the bucketed table `name`, whose files lie at `path`.

    The rows are dealt by bucket first, so that a bucket gets one file.
    """
    rows = lead_keys(leads).repartition(buckets, *KEYS)
    writer = rows.write.format("parquet").bucketBy(buckets, *KEYS).sortBy(*KEYS)
    writer.mode("append").option("path", path).saveAsTable(name)


def open_lead_keys(
    spark: SparkSession, name: str, path: str, buckets: int = BUCKETS
) -> DataFrame:
    """The bucketed table; a session whose catalogue does not know it yet is told of its files."""
    spark.sql(
        f"""CREATE TABLE IF NOT EXISTS {name} (order_key STRING, partner_key STRING) USING parquet
        CLUSTERED BY ({', '.join(KEYS)}) SORTED BY ({', '.join(KEYS)}) INTO {buckets} BUCKETS
        LOCATION '{path}'"""
    )
    return spark.table(name)
