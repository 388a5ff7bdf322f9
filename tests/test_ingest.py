"""Properties of the lead intake."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks import inputs
from checks.queries import masters
from leadloom.operators import store
from leadloom.operators.status import max_sequence
from leadloom.plans import gate
from leadloom.plans.ingest import IntakeOptions, ingest
from leadloom.schemas import TABLES, columns, schema
from tests.conftest import SF, mapping, rows

AS_OF = datetime(2024, 6, 1)


@pytest.fixture(scope="module")
def batch(spark):
    return inputs.lead_requests(spark, SF)


@pytest.fixture(scope="module")
def no_leads(spark):
    return spark.createDataFrame([], schema("leads"))


@pytest.fixture(scope="module")
def whole(spark, batch, no_leads):
    return ingest(batch, masters(spark, SF), no_leads, AS_OF)


def test_every_request_is_stored_once(batch, whole):
    assert whole.lead_requests.count() == batch.count() == whole.replies.count()
    assert whole.request_log.count() == whole.response_log.count() == batch.count()


def test_tables_have_their_schemas(whole):
    for name in ("lead_requests", "leads", "status_log"):
        assert getattr(whole, name).columns == columns(name)
    assert whole.response_log.columns == columns("api_response_log")
    assert all(schema(t).fields for t in TABLES)


def test_accepted_requests_become_leads_with_a_first_status(whole):
    accepted = rows(whole.replies.filter("responseCode = '00'"), "orderId")
    assert len(accepted) > 100
    assert rows(whole.leads, "transaction_id") == accepted
    assert rows(whole.status_log.filter("sequence = 1"), "transaction_id") == accepted
    assert whole.status_log.count() == len(accepted)
    keys = whole.leads.select(F.lower("order_id"), "partner_id")
    assert keys.distinct().count() == keys.count()
    assert max_sequence(whole.status_log).count() == whole.leads.select("order_id").distinct().count()


def test_all_outcomes_occur(whole):
    found = {r[0] for r in whole.replies.select("responseCode").distinct().collect()}
    assert {"00", "02", "03", "08", "09", "10", "11", "12", "13", "14", "30"} <= found


def test_ids_are_dense(whole):
    acq = [r[0] for r in rows(whole.lead_requests, "acq_id")]
    assert sorted(acq) == list(range(1, len(acq) + 1))
    numbers = sorted(r[0] for r in whole.leads.select("transaction_id").collect())
    assert numbers == [f"MD{i:07d}" for i in range(1, len(numbers) + 1)]


def test_result_does_not_depend_on_partitioning(spark, batch, no_leads, whole):
    again = ingest(batch.repartition(13, "body"), masters(spark, SF), no_leads, AS_OF)
    assert rows(again.lead_requests) == rows(whole.lead_requests)
    assert rows(again.leads) == rows(whole.leads)


def test_two_halves_equal_the_whole(spark, batch, no_leads, whole):
    middle = batch.approxQuantile("arrival_seq", [0.5], 0.0)[0]
    first = ingest(
        batch.filter(F.col("arrival_seq") <= middle), masters(spark, SF), no_leads, AS_OF
    )
    acq, taken = first.lead_requests.count(), first.leads.count()
    second = ingest(
        batch.filter(F.col("arrival_seq") > middle),
        masters(spark, SF),
        first.leads,
        AS_OF,
        acq_start=acq + 1,
        transaction_start=taken + 1,
    )
    assert rows(first.leads.unionByName(second.leads)) == rows(whole.leads)
    both = first.lead_requests.unionByName(second.lead_requests)
    assert rows(both, "acq_id", "order_id", "transaction_id", "response_code") == rows(
        whole.lead_requests, "acq_id", "order_id", "transaction_id", "response_code"
    )


def test_label_check_gives_parameter_error(spark, batch, no_leads):
    def check(frame):
        failed = F.size("members") < 25
        return frame.withColumn("label_error", F.when(failed, F.lit("x" * 150)))

    result = ingest(
        batch, masters(spark, SF), no_leads, AS_OF, options=IntakeOptions(label_check=check)
    )
    short = result.replies.filter("errorMessage like 'xxx%'").first()
    assert short.responseCode == "02" and len(short.errorMessage) == 100
    assert short.responseMessage == "Param Error - " + "x" * 150
    assert '"errorMessage":"xxx' in short.reply and '"orderId":""' in short.reply


def test_rejected_request_keeps_the_words_of_the_partner(whole):
    mapped = whole.lead_requests.filter("survey_city like 'px-%' and response_code = '00'")
    pairs = mapped.select("acq_id", F.col("survey_city").alias("sent")).join(
        whole.leads.select("acq_id", "survey_city"), "acq_id"
    )
    found = [(r.sent, r.survey_city) for r in pairs.collect()]
    assert found and all(kept in (None, sent.removeprefix("px-")) for sent, kept in found)
    assert any(kept for _, kept in found)


def test_rollback_touches_only_the_named_transaction(spark, whole, codes):
    lead = whole.leads.orderBy("acq_id").first()
    failed = spark.createDataFrame(
        [
            (lead.partner_id, lead.order_id, lead.transaction_id.lower()),
            (lead.partner_id, lead.order_id, "MD9999999"),
            (None, lead.order_id, lead.transaction_id),
        ],
        "partner_id string, order_id string, transaction_id string",
    )
    later = datetime(2024, 7, 1)
    leads, stored, history = store.rollback_failed(
        whole.leads, whole.lead_requests, whole.status_log, failed, codes, later
    )
    assert leads.count() == whole.leads.count() - 1
    assert history.count() == whole.status_log.count() - 1
    assert stored.count() == whole.lead_requests.count()
    row = stored.filter(F.col("acq_id") == lead.acq_id).first()
    assert (row.response_code, row.message, row.transaction_id, row.dtm_response) == (
        "30",
        "System error",
        None,
        later,
    )
    untouched = stored.filter(F.col("acq_id") != lead.acq_id)
    before = whole.lead_requests.filter(F.col("acq_id") != lead.acq_id)
    assert rows(untouched) == rows(before)
    kept = store.rollback_failed(
        whole.leads, whole.lead_requests, whole.status_log, failed, codes, later, keep_status=True
    )[2]
    assert kept.count() == whole.status_log.count()


def test_gate_splits_a_mixed_batch(spark, batch, codes):
    parameters = spark.createDataFrame(
        [("lead_api", "leads")], "parameter_id string, parameter_value string"
    )
    groups = spark.createDataFrame([("lead_api",)], "questiongroup_name string")
    parts = gate.split_by_handler(batch, parameters, groups, ["leads"])
    assert parts["leads"].count() + parts[None].count() == batch.count()
    assert parts["leads"].columns == batch.columns
    texts = mapping(gate.refusals(parts[None], codes), "responseMessage", "reply")
    assert texts["System error - IDNAME is required"] == (
        '{"responseCode":"30","responseMessage":"System error - IDNAME is required"}'
    )


def test_gate_loses_no_request(spark, batch, codes):
    parameters = spark.createDataFrame(
        [("lead_api", None), ("other", "elsewhere")], "parameter_id string, parameter_value string"
    )
    groups = spark.createDataFrame([("lead_api",), ("other",)], "questiongroup_name string")
    for handlers in (["leads"], []):
        parts = gate.split_by_handler(batch, parameters, groups, handlers)
        assert sum(p.count() for p in parts.values()) == batch.count()
        assert parts[None].filter("response_code IS NULL OR error IS NULL").count() == 0
