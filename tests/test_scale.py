"""Plans: pushdown, no Cartesian products, hot keys; sources and streaming."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks import inputs
from checks.queries import QUERIES, masters
from leadloom.operators import enrich, reports, requests, rules, status
from leadloom.plans.ingest import ingest
from leadloom.schemas import schema
from leadloom.sources.bodies import read_bodies
from leadloom.sources.tables import append_table, read_table, write_version
from leadloom.streaming.intake import run_batch, start_intake
from tests.conftest import SF, rows

AS_OF = datetime(2024, 6, 1)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_report_filters_reach_the_scan(spark):
    text = plan(QUERIES["detail_report_product_dates"](spark, SF))
    assert "GreaterThanOrEqual(order_dt" in text and "LessThan(order_dt" in text


def test_row_local_part_does_not_shuffle(spark):
    text = plan(QUERIES["pivot_params"](spark, SF))
    # The only exchanges build the broadcast catalogue.
    outer = text.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in outer


@pytest.fixture
def shuffled(spark):
    """Joins shuffle, and small partitions already count as skewed."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_partner_is_split(shuffled):
    """A third of all requests name one partner."""
    requests = shuffled.range(0, 30_000, 1, 8).select(
        F.col("id").cast("string").alias("request_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("partner_id"),
    )
    partners = requests.select(F.col("partner_id").alias("id_partner")).distinct().select(
        "id_partner",
        F.col("id_partner").alias("name"),
        F.lit(1).alias("flag_master"),
        F.lit("Main_Dealer").alias("flag_master_partner"),
    )
    checked = rules.check_partner(requests, partners).withColumn(
        "name_length", F.length("partner_id")
    )
    assert checked.filter("is_registered").count() == 30_000
    joined = checked.groupBy().agg(F.count_if("is_registered"), F.max("name_length"))
    joined.collect()
    assert "skew=true" in plan(joined)


def test_long_history_spreads_by_date(shuffled):
    """A third of the history belongs to one key; its dates are part of the join key."""
    log = shuffled.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("order_id"),
        F.lit("t").alias("transaction_id"),
        F.lit("p").alias("partner_id"),
        F.col("id").cast("int").alias("sequence"),
        F.lit(1).alias("id_status"),
        F.timestamp_seconds(F.col("id") - F.col("id") % 2).alias("status_dt"),
    )
    latest = status.latest_status(log)
    assert latest.count() == 20_001
    # 29997 is the last row of the hot key; 29996 has its date but another key.
    assert rows(latest.filter("order_id = 'hot'"), "sequence") == [(29997,)]


def test_shuffled_lookups_give_the_same_codes(shuffled):
    source = inputs.frame(shuffled, SF, "lead_source").withColumn("flag_master", F.lit(1))
    tables = {n: inputs.table(shuffled, SF, n) for n in ("zipcodes", "districts")}
    out = rules.check_masters(enrich.master_lookup(source, tables))
    found = rows(out, "request_id", "master_code")
    shuffled.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(out.select("*"), "request_id", "master_code") == found


def test_hot_api_is_split(shuffled):
    """All requests name one API; the catalogue is too large to broadcast."""
    catalogue = inputs.catalogue(shuffled, SF)
    frame = shuffled.range(0, 30_000, 1, 8).select(
        F.col("id").cast("string").alias("request_id"),
        F.when(F.col("id") >= 0, "lead_api").alias("id_name"),
        F.array(
            F.struct(
                F.lit(1).alias("element_id"),
                F.lit("fullName").alias("name"),
                F.col("id").cast("string").alias("string_value"),
                F.lit("string").alias("value_type"),
            )
        ).alias("members"),
    )
    bound = requests.bind(frame, catalogue).groupBy().agg(
        F.count("*"), F.max(F.size("bound")), F.max(F.length("request_id"))
    )
    assert bound.first()[0] == 30_000
    bound.collect()
    assert "skew=true" in plan(bound)


def test_lookups_shuffle_the_wide_request_once(shuffled):
    """Ten lookups: one exchange of narrow rows, one of their results, one of the request."""
    source = inputs.frame(shuffled, SF, "lead_source").withColumn("flag_master", F.lit(1))
    tables = {n: inputs.table(shuffled, SF, n) for n in ("zipcodes", "districts")}
    text = enrich.master_lookup(source, tables)._jdf.queryExecution().executedPlan().toString()
    before = source._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") - 2 * before.count(
        "Exchange hashpartitioning"
    ) <= 5
    assert text.count("SortMergeJoin") - 2 * before.count("SortMergeJoin") == 2


def test_report_cuts_the_history_before_it_is_aggregated(shuffled):
    names = ("leads", "partners", "status_log", "status_master", "offices")
    tables = [inputs.table(shuffled, SF, n) for n in names]
    report = reports.ReportFilter(datetime(1996, 1, 1, 8), datetime(1998, 12, 31), partner="P1")
    found = reports.detail_report(*tables, report)._jdf.queryExecution()
    lines = found.optimizedPlan().toString().splitlines()
    depth = {i: len(line) - len(line.lstrip(" :+-")) for i, line in enumerate(lines)}
    latest = next(i for i, line in enumerate(lines) if "max(struct(status_dt" in line)
    below = []
    for i in range(latest + 1, len(lines)):
        if depth[i] <= depth[latest]:
            break
        below.append(lines[i])
    assert any("LeftSemi" in line for line in below)


def test_report_opens_the_days_of_its_filter_only(spark, tmp_path):
    path = str(tmp_path / "leads")
    leads = inputs.table(spark, SF, "leads")
    append_table(leads, path, "leads")
    report = reports.ReportFilter(datetime(1997, 5, 1, 8), datetime(1997, 5, 28))
    found = reports.stored_leads(spark, path, report)
    assert "PartitionFilters: [isnotnull(day" in plan(found)
    day = F.to_date("order_dt")
    first, last = report.days()
    assert rows(found) == rows(leads.filter(day.between(F.lit(first), F.lit(last))))
    assert first.day == 2


def test_tables_round_trip(spark, tmp_path):
    leads = inputs.table(spark, SF, "leads")
    path = str(tmp_path / "leads")
    append_table(leads.filter("acq_id < 700"), path, "leads")
    append_table(leads.filter("acq_id >= 700"), path, "leads")
    back = read_table(spark, path, "leads")
    assert back.schema == schema("leads") and rows(back) == rows(leads)
    day = datetime(1997, 5, 28).date()
    one_day = read_table(spark, path, "leads", day, day)
    assert rows(one_day) == rows(leads.filter(F.to_date("order_dt") == F.lit(day)))
    assert "PartitionFilters: [isnotnull(day" in plan(one_day)
    write_version(back, str(tmp_path / "v2"), "leads")
    with pytest.raises(Exception, match="already exists"):
        write_version(back, str(tmp_path / "v2"), "leads")


def test_bodies_from_text(spark, tmp_path):
    (tmp_path / "a.txt").write_text('{"idName":"a"}\n{"idName":"b"}\n')
    (tmp_path / "b.txt").write_text('{"idName":"c"}\n')
    found = read_bodies(spark, str(tmp_path))
    assert found.columns == ["request_id", "arrival_seq", "arrival_ts", "body"]
    assert found.select("request_id").distinct().count() == 3
    assert found.select("arrival_seq").distinct().count() == 3


def test_stream_equals_one_batch(spark, tmp_path):
    """Two files through the stream, one batch run again, against one static batch."""
    batch = inputs.lead_requests(spark, SF)
    middle = batch.approxQuantile("arrival_seq", [0.5], 0.0)[0]
    landing, state = str(tmp_path / "landing"), str(tmp_path / "state")

    def stream():
        source = spark.readStream.schema(schema("requests")).option("maxFilesPerTrigger", 1)
        query = start_intake(
            source.parquet(landing),
            lambda: masters(spark, SF),
            state,
            str(tmp_path / "checkpoint"),
            now=lambda: AS_OF,
            availableNow=True,
        )
        query.awaitTermination(120)
        assert query.exception() is None

    def land(part):
        part.coalesce(1).write.mode("append").parquet(landing)

    land(batch.filter(F.col("arrival_seq") <= middle))
    stream()
    second = batch.filter(F.col("arrival_seq") > middle)
    land(second)
    stream()
    run_batch(second, 1, masters(spark, SF), state, AS_OF)
    no_leads = spark.createDataFrame([], schema("leads"))
    whole = ingest(batch, masters(spark, SF), no_leads, AS_OF)
    stored = spark.read.schema(schema("leads")).parquet(f"{state}/leads").drop("batch")
    assert rows(stored) == rows(whole.leads)
    log = spark.read.parquet(f"{state}/status_log")
    assert log.count() == whole.status_log.count()
