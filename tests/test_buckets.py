from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from leadloom.operators import rules
from leadloom.sources import buckets
from tests.conftest import rows

BLOOM = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"


@pytest.fixture
def tables(spark, tmp_path):
    """20,000 stored leads and a batch of 200 requests, both at rest; nothing is broadcast."""
    number = F.col("id")
    leads = spark.range(20_000).select(
        F.concat(F.lit("O"), number).alias("order_id"), F.concat(F.lit("P"), number % 50).alias("partner_id")
    )
    leads = leads.unionByName(spark.createDataFrame(
        [(None, "P1"), ("O1", None)], "order_id string, partner_id string"))
    asked = spark.range(200).select(
        number.cast("string").alias("request_id"),
        F.when(number % 10 > 0, F.concat(F.lit("o"), number * 101, F.lit(" "))).alias("order_id"),
        F.concat(F.lit("p"), (number * 101 + F.when(number % 7 == 0, 1).otherwise(0)) % 50).alias("partner_id"),
    )
    places = [str(tmp_path / n) for n in ("leads", "asked")]
    for frame, place in zip((leads, asked), places, strict=True):
        frame.write.parquet(place)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield tuple(spark.read.parquet(place) for place in places)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_duplicates_without_a_shuffle_of_the_stored_side(spark, tables, tmp_path):
    leads, asked = tables
    path = str(tmp_path / "keys")
    half = F.crc32("order_id") % 2
    for part in (leads.where((half == 0) | half.isNull()), leads.where(half == 1)):
        buckets.append_lead_keys(part, "lead_keys_test", path, 8)
    # A session that does not know the table finds it by its files.
    spark.sql("DROP TABLE lead_keys_test")
    keys = buckets.open_lead_keys(spark, "lead_keys_test", path, 8)
    assert keys.count() == 20_000
    found = rules.check_duplicate(asked, keys)
    assert rows(found, "request_id", "is_stored") == rows(
        rules.check_duplicate(asked, leads), "request_id", "is_stored"
    )
    assert found.where("is_stored").count() == sum(i % 10 > 0 and i % 7 > 0 and i * 101 < 20_000 for i in range(200))
    lines = plan(found).splitlines()
    scan = next(i for i, line in enumerate(lines) if "lead_keys_test" in line)
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    above, at = [], depth[scan]
    for i in range(scan - 1, -1, -1):
        if depth[i] < at:
            above.append(lines[i])
            at = depth[i]
        if "Join" in above[-1] if above else False:
            break
    assert "Bucketed: true" in lines[scan]
    assert "LeftSemi" in above[-1] and not any("Exchange" in line for line in above)
    spark.sql("DROP TABLE lead_keys_test")


def test_bloom_filter_of_the_batch_cuts_the_scan(spark, tables):
    """Far fewer than the stored rows reach the shuffle of the stored side."""
    leads, asked = tables
    before = spark.conf.get(BLOOM)
    spark.conf.set(BLOOM, "1")
    try:
        found = rules.check_duplicate(asked, leads)
        text = found._jdf.queryExecution().optimizedPlan().toString()
        assert "bloom_filter_agg" in text and "might_contain" in text
        without = rows(found, "request_id", "is_stored")
    finally:
        spark.conf.set(BLOOM, before)
    assert rows(rules.check_duplicate(asked, leads), "request_id", "is_stored") == without
