"""What large intakes were slowed by: a shuffle of whole bodies, structs built in lambdas, code too long to compile."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs, queries
from leadloom.functions.members import add_members
from leadloom.operators import requests
from leadloom.plans import ingest
from leadloom.session import materialise, tune
from tests.conftest import SF

def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lead_bodies_are_not_shuffled(spark, tmp_path):
    tune(spark)
    spark.sql(
        "SELECT id AS o_orderkey, id AS o_custkey, timestamp'2024-01-01' AS o_orderdate FROM range(9)"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("SELECT id AS c_custkey, 'M' AS c_mktsegment FROM range(9)").write.parquet(
        f"{tmp_path}/customer.parquet"
    )
    spark.sql(
        "SELECT id AS s_suppkey, 'S' || id AS s_name, id AS s_nationkey FROM range(9)"
    ).write.parquet(f"{tmp_path}/supplier.parquet")
    spark.sql(
        "SELECT id AS n_nationkey, 'N' AS n_name, 0L AS n_regionkey FROM range(9)"
    ).write.parquet(f"{tmp_path}/nation.parquet")
    spark.sql("SELECT 0L AS r_regionkey, 'R' AS r_name").write.parquet(f"{tmp_path}/region.parquet")
    kept = []
    original, inputs.stored = inputs.stored, lambda s, d, n, make: kept.append((n, make())) or kept[-1][1]
    try:
        bodies = inputs.lead_requests(spark, str(tmp_path))
    finally:
        inputs.stored = original
    plan = _plan(bodies)
    assert "hashpartitioning(o_orderkey" in plan and "hashpartitioning(request_id" not in plan
    assert bodies.count() == 9


def test_codes_bound_once_or_twice_and_mixed_kinds(spark):
    tune(spark)
    bodies = spark.createDataFrame(
        [(1, '{"a":"x","b":"y"}'), (2, '{"a":"x","A ":2.50,"b":null}'), (3, "[]"), (4, "{}")],
        "request_id int, body string",
    )
    members = {r["request_id"]: r["members"] for r in add_members(bodies).collect()}
    assert [tuple(m) for m in members[2]] == [
        (1, "a", "x", "string"),
        (2, "A ", "2.5", "real"),
        (3, "b", "null", "null"),
    ]
    assert members[3] is None and members[4] == []
    bound = spark.sql(
        """SELECT array(named_struct('question_code', 'c', 'string_value', '1'),
            named_struct('question_code', 'C', 'string_value', '2')) AS bound"""
    )
    assert requests.with_params(bound).first()["params"] == {"C": "2"}


def test_generated_code_stays_small_enough_to_be_compiled(spark):
    assert tune(spark).conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_wide_requests_are_shuffled_once(spark):
    """Rules, duplicates and numbers move narrow rows; the rest of a request is joined by its row."""
    masters, batch = queries.masters(spark, SF), inputs.lead_requests(spark, SF)
    leads = inputs.table(spark, SF, "stored_leads", "leads")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = ingest.validate_requests(batch, masters, leads)
        assert "full_name" in rows.columns
        judged = [spark.read.parquet(f).columns for f in rows.inputFiles() if "/judged-" in f]
        assert judged and not any("full_name" in columns for columns in judged)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_repeated_and_missing_request_ids_keep_their_rows(spark):
    masters = queries.masters(spark, SF)
    some = inputs.lead_requests(spark, SF).where("arrival_seq < 30")
    twice = some.unionAll(some.withColumn("arrival_seq", F.col("arrival_seq") + 1000)).withColumn(
        "request_id", F.when(F.col("arrival_seq") % 7 > 0, F.col("request_id"))
    )
    leads = inputs.table(spark, SF, "stored_leads", "leads")
    found = ingest.validate_requests(twice, masters, leads)
    assert found.count() == twice.count() == found.select("acq_id").distinct().count()
    assert ingest.ROW_ID not in found.columns


def _block_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = blocks.getAllFiles()
    return {files.apply(i).getName() for i in range(files.length())}


def test_shuffle_files_go_with_their_action(spark, tmp_path):
    tune(spark)
    before = _block_files(spark)
    spark.range(1000).groupBy(F.col("id") % 7).count().write.parquet(f"{tmp_path}/counts")
    left = {f for f in _block_files(spark) - before if f.startswith("shuffle_")}
    assert not left and spark.read.parquet(f"{tmp_path}/counts").count() == 7


def test_a_frame_can_be_read_again_after_its_shuffle_files_went(spark):
    tune(spark)
    counted = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert sorted(counted.collect()) == sorted(counted.collect())
    assert counted.count() == 7 == counted.count()


def test_cuts_of_the_intake_are_written_with_zstd(spark):
    masters, batch = queries.masters(spark, SF), inputs.lead_requests(spark, SF)
    read = ingest.numbered_rows(ingest.read_requests(batch, masters))
    assert read.inputFiles() and all(f.endswith(".zstd.parquet") for f in read.inputFiles())


def test_answers_of_the_echo_row_are_kept_once(spark):
    """Only an answer that is no lead column has a column for the echo row."""
    masters, batch = queries.masters(spark, SF), inputs.lead_requests(spark, SF)
    options = ingest.IntakeOptions(echo={"name": "full_name", "no": "ORDER_ID", "other": "SEGMENT"})
    read = ingest.read_requests(batch, masters, options)
    assert [c for c in read.columns if "echo" in c] == ["echoed_order_id", "echoed_segment"]
    echoes = ingest.echo_rows(read, options)
    assert echoes.columns == ["request_id", "name", "no", "other"]
    found = echoes.join(read.select("request_id", "full_name"), "request_id")
    assert found.where(~F.col("name").eqNullSafe(F.col("full_name"))).count() == 0
    assert found.where("name is not null and other is null").count() > 0


def test_replies_and_first_status_need_no_wide_rows(spark):
    masters, batch = queries.masters(spark, SF), inputs.lead_requests(spark, SF)
    leads = inputs.table(spark, SF, "stored_leads", "leads")
    result = ingest.ingest(batch, masters, leads, queries.AS_OF)
    for narrow in (result.replies, result.response_log, result.status_log):
        assert all("/outcome-" in f for f in narrow.inputFiles())
    assert "full_name" not in spark.read.parquet(*result.replies.inputFiles()).columns
    assert any("/read-" in f for f in result.leads.inputFiles())


def test_requests_are_joined_once_with_all_their_lookups(spark):
    """Masters, code map and sub zip codes come in one step; their joins move no address column."""
    masters, batch = queries.masters(spark, SF), inputs.lead_requests(spark, SF)
    leads = inputs.table(spark, SF, "stored_leads", "leads")
    wide = ingest.numbered_rows(ingest.read_requests(batch, masters))
    checked = materialise(ingest.check_requests(wide.drop("body"), masters, leads), "checked")
    judged = ingest.judge_requests(checked, masters)
    assert not {"survey_village", "city_id"} & set(judged.columns)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = [
            line for line in _plan(judged).splitlines() if "Exchange hashpartitioning(request_id" in line
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The requests once; masters and sub zip codes once each; the mapped codes lie at rest.
    assert 1 <= len(moved) <= 4
