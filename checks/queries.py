"""One query per operator, over whole test tables."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs
from checks.inputs import catalogue, frame, part_catalogue, table
from leadloom.constants import ADDRESS_COLUMNS, SUCCESS
from leadloom.functions.checks import bad_date, bad_id_number
from leadloom.operators import catalogue as catalogues
from leadloom.operators import (
    enrich,
    export,
    ids,
    lookups,
    replies,
    reports,
    requests,
    rules,
    status,
    store,
    users,
)
from leadloom.plans import changes, gate
from leadloom.plans.ingest import (
    JOB_NAME,
    IntakeOptions,
    Masters,
    commit_intake,
    ingest,
    stored_rows,
    validate_requests,
)
from leadloom.plans.inquiry import inquire
from leadloom.session import shared_folder, tune
from leadloom.sources.batches import BatchStore
from leadloom.sources.buckets import append_lead_keys, open_lead_keys
from leadloom.sources.latest import LatestStatus
from leadloom.sources.tables import DAY_OF, read_table, write_version

AS_OF = datetime(2024, 6, 1, 12, 0, 0)
WHOLE = reports.ReportFilter(datetime(1990, 1, 1), datetime(2030, 1, 1))
SEGMENT = reports.ReportFilter(
    datetime(1996, 1, 1, 8), datetime(1998, 12, 31), product="2-HIGH"
)
BRANCH = reports.ReportFilter(datetime(1995, 1, 1), datetime(2001, 12, 31), status=4, branch=5)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(tune(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


def text_time(column: str) -> F.Column:
    """A timestamp as text, the same in every engine."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def texts(df: DataFrame) -> DataFrame:
    """All timestamps of a result as text."""
    return df.select(
        *[text_time(f.name) if f.dataType.typeName() == "timestamp" else f.name for f in df.schema]
    )


def masters(spark: SparkSession, sf_dir: str) -> Masters:
    return Masters(
        catalogue=catalogue(spark, sf_dir),
        response_codes=table(spark, sf_dir, "response_codes"),
        partners=table(spark, sf_dir, "lead_partners", "partners"),
        code_map=table(spark, sf_dir, "code_map"),
        zipcodes=table(spark, sf_dir, "zipcodes"),
        districts=table(spark, sf_dir, "districts"),
    )


def bound_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = requests.with_members(inputs.lead_requests(spark, sf_dir))
    return requests.bind(parsed, catalogue(spark, sf_dir))


def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate_requests(
        inputs.lead_requests(spark, sf_dir),
        masters(spark, sf_dir),
        table(spark, sf_dir, "stored_leads", "leads"),
        acq_start=1001,
        transaction_start=501,
    )


# --- requests ----------------------------------------------------------------------------------


@query
def shred_requests(spark, sf_dir):
    return requests.shred_requests(inputs.customer_requests(spark, sf_dir))


@query
def shred_event_props(spark, sf_dir):
    events = frame(spark, sf_dir, "events")
    bodies = events.select(F.col("event_id").alias("request_id"), F.col("props").alias("body"))
    return requests.shred_requests(bodies)


@query
def bind_questions(spark, sf_dir):
    return requests.bind_questions(
        inputs.customer_requests(spark, sf_dir), catalogue(spark, sf_dir)
    )


@query
def pivot_params(spark, sf_dir):
    return requests.pivot_params(bound_leads(spark, sf_dir))


@query
def echo_params(spark, sf_dir):
    parsed = requests.with_members(inputs.customer_requests(spark, sf_dir))
    return requests.echo_params(
        requests.bind(parsed, catalogue(spark, sf_dir)), inputs.CUSTOMER_API
    )


@query
def inject_param(spark, sf_dir):
    parsed = requests.with_members(inputs.customer_requests(spark, sf_dir))
    bound = requests.bind(parsed, catalogue(spark, sf_dir))
    injected = requests.inject_param(bound, "channel", "CHANNEL", F.col("request_id"))
    return requests.bound_rows(injected)


@query
def route_requests(spark, sf_dir):
    parameters, groups = _gate_tables(spark)
    return requests.route_requests(inputs.event_requests(spark, sf_dir), parameters, groups)


def _gate_tables(spark):
    parameters = spark.sql(
        """SELECT * FROM VALUES ('VIEW', 'inquiry'), ('click', 'leads'), ('signup', 'users')
        AS t(parameter_id, parameter_value)"""
    )
    groups = spark.sql(
        "SELECT * FROM VALUES ('view'), ('click '), ('error') AS t(questiongroup_name)"
    )
    return parameters, groups


@query
def gate_replies(spark, sf_dir):
    parameters, groups = _gate_tables(spark)
    parts = gate.split_by_handler(
        inputs.event_requests(spark, sf_dir), parameters, groups, ["inquiry", "leads"]
    )
    answered = gate.refusals(parts[None], table(spark, sf_dir, "response_codes"))
    return texts(gate.log_refusals(answered, AS_OF))


# --- rules -------------------------------------------------------------------------------------


@query
def rule_catalogue(spark, sf_dir):
    return catalogues.rule_catalogue(part_catalogue(spark, sf_dir))


@query
def check_mandatory(spark, sf_dir):
    return rules.check_mandatory(bound_leads(spark, sf_dir)).select("request_id", "blank_param")


@query
def check_date(spark, sf_dir):
    return rules.check_date(bound_leads(spark, sf_dir)).select("request_id", "bad_date_param")


@query
def check_numeric(spark, sf_dir):
    return rules.check_numeric(bound_leads(spark, sf_dir)).select(
        "request_id", "bad_number_param"
    )


@query
def check_length(spark, sf_dir):
    return rules.check_length(bound_leads(spark, sf_dir)).select(
        "request_id", "long_param", "length_limit"
    )


@query
def check_dates_of_lineitem(spark, sf_dir):
    """The date check on three notations of one date, and on days that may not exist."""
    item = frame(spark, sf_dir, "lineitem")
    line = F.col("l_linenumber")
    value = (
        F.when(line == 1, F.date_format("l_shipdate", "yyyy-MM-dd"))
        .when(line == 2, F.date_format("l_shipdate", "yyyyMMdd"))
        .when(line == 3, F.date_format("l_shipdate", "MM/dd/yyyy"))
        .when(line == 4, F.concat(F.date_format("l_shipdate", "yyyy-MM"), F.lit("-31")))
        .when(line == 5, F.lit(""))
    )
    return item.select("l_orderkey", "l_linenumber", bad_date(value).alias("is_bad_date"))


def _duplicate_inputs(spark, sf_dir):
    orders = frame(spark, sf_dir, "orders")
    batch = orders.select(
        F.col("o_orderkey").cast("string").alias("request_id"),
        F.col("o_orderkey").alias("arrival_seq"),
        F.when(F.col("o_orderkey") % 23 > 0, F.col("o_orderpriority")).alias("order_id"),
        F.col("o_custkey").cast("string").alias("partner_id"),
        F.col("o_orderstatus"),
    )
    stored = frame(spark, sf_dir, "customer").select(
        F.when(F.col("c_custkey") % 3 == 0, "3-medium").otherwise("2-high ").alias("order_id"),
        F.col("c_custkey").cast("string").alias("partner_id"),
    )
    return batch, stored


def _duplicates(batch, stored):
    judged = rules.check_duplicate(batch, stored).withColumns(
        {
            "own_code": F.when(F.col("o_orderstatus") == "P", "12")
            .when(F.col("is_stored"), "03")
            .when(F.col("o_orderstatus") == "F", "13")
            .otherwise(SUCCESS),
            "is_unreadable": F.lit(False),
        }
    )
    return rules.check_batch_duplicates(judged).select("request_id", "is_stored", "response_code")


@query
def check_duplicate(spark, sf_dir):
    return _duplicates(*_duplicate_inputs(spark, sf_dir))


@query
def check_duplicate_bucketed(spark, sf_dir):
    """The same against the keys of the stored leads in buckets."""
    batch, stored = _duplicate_inputs(spark, sf_dir)
    name = f"lead_keys_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/leadloom/{name}"
    append_lead_keys(stored, name, path, buckets=8)
    return _duplicates(batch, open_lead_keys(spark, name, path, buckets=8))


@query
def check_partner(spark, sf_dir):
    orders = frame(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("partner_id")
    )
    partners = table(spark, sf_dir, "partners")
    return rules.check_partner(orders, partners, kind="building").select(
        "o_orderkey", "is_registered", "flag_master"
    )


@query
def check_id_number(spark, sf_dir):
    customer = frame(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    number = key.cast("string")
    value = (
        F.when(key % 8 == 0, number)
        .when(key % 8 == 1, F.concat(F.lit("  "), number, F.lit(" ")))
        .when(key % 8 == 2, F.concat(number, F.lit(".5")))
        .when(key % 8 == 3, F.col("c_name"))
        .when(key % 8 == 4, F.lit("  "))
        .when(key % 8 == 5, F.concat(number, F.lit(" "), number))
        .when(key % 8 == 6, F.concat(number, F.lit("\n")))
    )
    return customer.select("c_custkey", bad_id_number(value).alias("is_bad_id_number"))


def _wide_source(spark, sf_dir):
    return rules.check_partner(
        frame(spark, sf_dir, "lead_source"), table(spark, sf_dir, "lead_partners", "partners")
    )


def _looked_up(spark, sf_dir, only_when=None):
    tables = {n: table(spark, sf_dir, n) for n in ("zipcodes", "districts")}
    return enrich.master_lookup(_wide_source(spark, sf_dir), tables, only_when=only_when)


@query
def master_lookup(spark, sf_dir):
    return _looked_up(spark, sf_dir).select(
        "request_id", *[f"{c}_found" for c in ADDRESS_COLUMNS]
    )


@query
def catalogue_lookups(spark, sf_dir):
    """Three fields by the lookups stored in the catalogue, the others by those in code."""
    tables = {n: table(spark, sf_dir, n) for n in ("zipcodes", "districts")}
    specs = lookups.catalogue_lookups(catalogue(spark, sf_dir, active_only=True), "lookup_api", tables)
    return enrich.master_lookup(_wide_source(spark, sf_dir), tables, specs).select(
        "request_id", *[f"{c}_found" for c in ADDRESS_COLUMNS]
    )


@query
def check_masters(spark, sf_dir):
    looked_up = _looked_up(spark, sf_dir, F.col("flag_master") == 1)
    return rules.check_masters(looked_up).select("request_id", "flag_master", "master_code")


@query
def first_failure(spark, sf_dir):
    item = frame(spark, sf_dir, "lineitem")

    def part(n: int) -> F.Column:
        return F.col("l_partkey") % n == 1

    flags = item.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.when(part(11), F.col("l_linestatus")).alias("blank_param"),
        part(7).alias("is_stored"),
        (~part(6)).alias("is_registered"),
        part(5).alias("is_bad_id_number"),
        F.when(part(4), F.lit("birthDate")).alias("bad_date_param"),
        F.when(part(3), F.lit("mobilePhone")).alias("bad_number_param"),
        F.when(part(2), F.col("l_returnflag")).alias("long_param"),
        F.col("l_linenumber").alias("length_limit"),
        F.when(F.col("l_linenumber") == 3, "17").alias("master_code"),
    )
    return rules.first_failure(flags, table(spark, sf_dir, "response_codes")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "response_code", "response_message"
    )


@query
def response_message(spark, sf_dir):
    orders = frame(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.format_string("%02d", F.col("o_orderkey") % 33).alias("response_code"),
    )
    return rules.response_message(orders, table(spark, sf_dir, "response_codes"))


# --- enrichment and ids ------------------------------------------------------------------------


@query
def map_codes(spark, sf_dir):
    mapped = enrich.map_codes(
        _wide_source(spark, sf_dir), table(spark, sf_dir, "code_map"), F.col("flag_master") == 2
    )
    return mapped.select("request_id", "is_ambiguous", *[f"{c}_mapped" for c in ADDRESS_COLUMNS])


@query
def resolve_sub_zipcode(spark, sf_dir):
    return enrich.resolve_sub_zip_code(
        frame(spark, sf_dir, "lead_source"),
        table(spark, sf_dir, "zipcodes"),
        table(spark, sf_dir, "districts"),
    ).select("request_id", "survey_sub_zip_code", "legal_sub_zip_code")


@query
def allocate_ids(spark, sf_dir):
    events = frame(spark, sf_dir, "events").select("event_id", "event_type")
    return ids.allocate_ids(
        events,
        "event_id",
        F.col("event_type") == "purchase",
        acq_start=100,
        transaction_start=9_999_990,
    )


@query
def running_numbers_per_user(spark, sf_dir):
    events = frame(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    counts = {"nth": F.lit(True), "nth_click": F.col("event_type") == "click"}
    return ids.running_numbers(events, "event_id", counts, within=["user_id"])


# --- intake ------------------------------------------------------------------------------------


@query
def store_requests(spark, sf_dir):
    return texts(store.store_requests(validated(spark, sf_dir), AS_OF))


@query
def store_leads(spark, sf_dir):
    return texts(store.store_leads(validated(spark, sf_dir), AS_OF)).drop(
        "agrmnt_no", "instalment_amt", "po_dp", "po_no", "po_date", "po_tenor", "office_code"
    )


@query
def open_status(spark, sf_dir):
    return texts(store.open_status(validated(spark, sf_dir), AS_OF)).drop("dtm_upd", "usr_upd")


LEAD_REPLY = ("responseCode", "responseMessage", "errorMessage", "orderIdDealer", "orderId", "mtType")


def _read_reply(rows, column, names):
    """The fields of a JSON reply, next to the other columns, in its place."""
    fields = [F.get_json_object(column, f"$.{n}").alias(f"reply_{n}") for n in names]
    return rows.select(*rows.columns, *fields).drop(column)


def _intake(spark, sf_dir):
    return ingest(
        inputs.lead_requests(spark, sf_dir),
        masters(spark, sf_dir),
        table(spark, sf_dir, "stored_leads", "leads"),
        AS_OF,
        acq_start=1001,
        transaction_start=501,
        options=IntakeOptions(echo=inputs.LEAD_API),
    )


@query
def ingest_leads(spark, sf_dir):
    """The replies; those in JSON are compared field by field."""
    return _read_reply(_intake(spark, sf_dir).replies, "reply", LEAD_REPLY)


@query
def intake_echo(spark, sf_dir):
    """The row that goes with each reply: the answers under their names in the API."""
    return _intake(spark, sf_dir).echoes


@query
def intake_request_log(spark, sf_dir):
    """The request log of the intake; the bodies by their length and hash."""
    log = texts(_intake(spark, sf_dir).request_log)
    body = F.coalesce("parameter", F.lit(""))
    return log.withColumns({"n_chars": F.length(body), "md5": F.md5(body)}).drop("parameter")


def _committed(spark, sf_dir):
    """The lead batch as two committed batches; the second one failed in its first run.

    They are the orders of odd and of even number.
    """
    batches = BatchStore(spark, f"{shared_folder(spark)}/leadloom/intake-{uuid.uuid4().hex}")
    asked, known = inputs.lead_requests(spark, sf_dir), masters(spark, sf_dir)
    for remainder, name in ((1, "odd"), (0, "even")):
        part = asked.where(F.col("arrival_seq") % 2 == remainder)
        if not remainder:
            with contextlib.suppress(Broken):
                batches.run(name, JOB_NAME, _broken, lambda: AS_OF)
        commit_intake(batches, name, part, known, lambda: AS_OF)
        commit_intake(batches, name, part, known, lambda: AS_OF)
    return batches


class Broken(Exception):
    """A failure made for a check."""


def _broken():
    raise Broken("no space left")


@query
def intake_job_log(spark, sf_dir):
    """The job log after two committed batches and one failure."""
    return texts(_committed(spark, sf_dir).job_log()).drop("err_line", "err_number")


@query
def intake_committed(spark, sf_dir):
    """What committed batches hold together: rows, ids and codes of all requests."""
    stored = stored_rows(_committed(spark, sf_dir), "lead_requests")
    return stored.select(
        F.count("*").alias("n"),
        F.countDistinct("acq_id").alias("ids"),
        F.min("acq_id").alias("first_id"),
        F.max("acq_id").alias("last_id"),
    )


@query
def lead_response_log(spark, sf_dir):
    answered = replies.lead_replies(validated(spark, sf_dir))
    return _read_reply(texts(replies.log_lead_replies(answered, AS_OF)), "parameter", LEAD_REPLY)


def _to_roll_back(spark, sf_dir):
    leads = table(spark, sf_dir, "leads")
    stored = store.conform(
        leads.withColumns({"response_code": F.lit(SUCCESS), "message": F.lit("Success")}),
        "lead_requests",
    )
    history = table(spark, sf_dir, "status_log")
    # Errors for the orders with an urgent priority; every other one names another transaction.
    orders = frame(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    failed = orders.select(
        F.col("o_custkey").cast("string").alias("partner_id"),
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey").cast("string"))
        .otherwise("none")
        .alias("transaction_id"),
    )
    return {"leads": leads, "lead_requests": stored, "status_log": history}, failed


def _versions(leads, stored, history):
    none = F.lit(None).cast("string")
    return (
        leads.select(F.lit("leads").alias("table"), "order_id", "transaction_id", none.alias("code"))
        .unionByName(
            stored.select(
                F.lit("lead_requests").alias("table"),
                "order_id",
                "transaction_id",
                F.concat("response_code", F.lit(" "), "message").alias("code"),
            )
        )
        .unionByName(
            history.select(
                F.lit("status_log").alias("table"),
                "order_id",
                "transaction_id",
                F.col("sequence").cast("string").alias("code"),
            )
        )
    )


@query
def rollback_failed(spark, sf_dir):
    tables, failed = _to_roll_back(spark, sf_dir)
    codes = table(spark, sf_dir, "response_codes")
    return _versions(*store.rollback_failed(*tables.values(), failed, codes, AS_OF))


def _stored_version(spark, sf_dir, tables):
    """A root folder with a version of some tables at rest, to be changed by one query.

    The test tables spread few rows over some 2,400 days. Dates are set back to the first day of their
    quarter, so that a folder holds about as many rows as a day of a real table would.
    """
    root = f"{shared_folder(spark)}/leadloom/version-{uuid.uuid4().hex}"
    for name, rows in tables.items():
        rows = rows.withColumn(DAY_OF[name], F.date_trunc("quarter", DAY_OF[name]))
        write_version(rows, f"{root}/{name}", name)
    return root


@query
def rollback_stored(spark, sf_dir):
    """The rollback on tables at rest, read back: only the days of the failed leads are rewritten."""
    tables, failed = _to_roll_back(spark, sf_dir)
    root = _stored_version(spark, sf_dir, tables)
    changes.rollback(spark, root, failed, table(spark, sf_dir, "response_codes"), AS_OF)
    return _versions(*[read_table(spark, f"{root}/{n}", n) for n in tables])


# --- replies and logs --------------------------------------------------------------------------


@query
def response_envelope(spark, sf_dir):
    events = frame(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_type").alias("responseMessage"),
        F.when(F.col("event_id") % 3 > 0, F.col("user_id").cast("string")).alias("orderId"),
    )
    enveloped = replies.response_envelope(events, ["responseMessage", "orderId"])
    return enveloped.select(
        "event_id",
        F.get_json_object("reply", "$.responseMessage").alias("message"),
        F.get_json_object("reply", "$.orderId").alias("order_id"),
        F.contains("reply", F.lit("orderId")).alias("has_order_id"),
    )


@query
def log_requests(spark, sf_dir):
    parsed = requests.with_members(inputs.event_requests(spark, sf_dir))
    return texts(replies.log_requests(parsed, AS_OF))


@query
def log_responses(spark, sf_dir):
    events = frame(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("request_id"),
        F.col("event_type").alias("id_name"),
        F.col("user_id").cast("string").alias("order_id"),
        F.lit(SUCCESS).alias("response_code"),
        F.lit("Success").alias("response_message"),
        F.col("props").alias("reply"),
    )
    return texts(replies.log_responses(events, AS_OF))


@query
def job_audit(spark, sf_dir):
    events = frame(spark, sf_dir, "events")
    runs = events.select(
        F.concat("event_type", F.col("event_id").cast("string")).alias("proc_name"),
        F.when(F.col("event_type") == "error", "error")
        .when(F.col("event_id") % 2 == 0, "start")
        .otherwise("end")
        .alias("status"),
        F.when(F.col("event_id") % 3 > 0, F.col("props")).alias("error"),
        F.lit(AS_OF).cast("timestamp").alias("at"),
    )
    return texts(replies.job_audit(runs)).drop("err_line", "err_number")


# --- status ------------------------------------------------------------------------------------


def _inquired(spark, sf_dir):
    return status.status_inquiry(
        frame(spark, sf_dir, "inquiries"),
        table(spark, sf_dir, "leads"),
        table(spark, sf_dir, "partners"),
        table(spark, sf_dir, "status_master"),
        table(spark, sf_dir, "response_codes"),
        kind="BUILDING",
    )


@query
def status_inquiry(spark, sf_dir):
    return texts(_inquired(spark, sf_dir))


@query
def inquiry_response(spark, sf_dir):
    answered = status.inquiry_response(_inquired(spark, sf_dir))
    return _read_reply(answered, "reply", status.INQUIRY_FIELDS)


@query
def log_inquiries(spark, sf_dir):
    return texts(status.log_inquiries(_inquired(spark, sf_dir), AS_OF))


@query
def inquire_by_body(spark, sf_dir):
    """Inquiry bodies end to end; the bodies carry the values of `inquiries`."""
    asked = frame(spark, sf_dir, "inquiries")
    bodies = asked.select(
        "request_id",
        F.to_json(
            F.struct(
                F.lit("lead_api").alias("idName"),
                F.col("order_id").alias("orderIdDealer"),
                F.col("partner_id").alias("dealerId"),
            )
        ).alias("body"),
    )
    result = inquire(
        bodies,
        catalogue(spark, sf_dir),
        table(spark, sf_dir, "leads"),
        table(spark, sf_dir, "partners"),
        table(spark, sf_dir, "status_master"),
        table(spark, sf_dir, "response_codes"),
        AS_OF,
        kind="BUILDING",
    )
    return _read_reply(result.replies, "reply", status.INQUIRY_FIELDS).drop("id_name")


@query
def max_sequence(spark, sf_dir):
    return status.max_sequence(table(spark, sf_dir, "status_log"))


def _transitioned(spark, sf_dir):
    return status.status_transition(
        table(spark, sf_dir, "leads"),
        table(spark, sf_dir, "status_log"),
        frame(spark, sf_dir, "changes"),
        AS_OF,
    )


@query
def status_transition(spark, sf_dir):
    leads, _ = _transitioned(spark, sf_dir)
    return leads.select("transaction_id", "id_status")


@query
def status_transition_log(spark, sf_dir):
    _, appended = _transitioned(spark, sf_dir)
    return texts(appended).drop("dtm_upd", "usr_upd")


def _transitioned_at_rest(spark, sf_dir):
    tables = {n: table(spark, sf_dir, n) for n in ("leads", "status_log")}
    root = _stored_version(spark, sf_dir, tables)
    changes.transition(spark, root, frame(spark, sf_dir, "changes"), AS_OF)
    return root


@query
def status_transition_stored(spark, sf_dir):
    """Transitions of leads at rest, read back: only the days of changed leads are rewritten."""
    root = _transitioned_at_rest(spark, sf_dir)
    return read_table(spark, f"{root}/leads", "leads").select("transaction_id", "id_status")


@query
def status_transition_stored_log(spark, sf_dir):
    """The status rows that transitions of leads at rest have appended to the history."""
    root = _transitioned_at_rest(spark, sf_dir)
    history = read_table(spark, f"{root}/status_log", "status_log")
    return texts(history.where(F.col("dtm_crt") == F.lit(AS_OF))).drop("dtm_upd", "usr_upd")


@query
def latest_status(spark, sf_dir):
    return texts(
        status.latest_status(table(spark, sf_dir, "status_log")).select(
            "order_id", "transaction_id", "partner_id", "sequence", "id_status", "status_dt"
        )
    )


# --- reports and exports -----------------------------------------------------------------------


def _detail(spark, sf_dir, report):
    names = ("leads", "partners", "status_log", "status_master", "offices")
    return reports.detail_report(*[table(spark, sf_dir, n) for n in names], report)


def _recap(spark, sf_dir, report):
    names = ("leads", "status_log", "status_master", "offices")
    return reports.status_recap(*[table(spark, sf_dir, n) for n in names], report)


@query
def detail_report(spark, sf_dir):
    return _detail(spark, sf_dir, WHOLE)


@query
def detail_report_product_dates(spark, sf_dir):
    return _detail(spark, sf_dir, SEGMENT)


@query
def detail_report_branch_status(spark, sf_dir):
    return _detail(spark, sf_dir, BRANCH)


@query
def status_recap(spark, sf_dir):
    return _recap(spark, sf_dir, WHOLE)


@query
def status_recap_product_dates(spark, sf_dir):
    return _recap(spark, sf_dir, SEGMENT)


@query
def status_recap_branch_status(spark, sf_dir):
    return _recap(spark, sf_dir, BRANCH)


def _kept(spark, sf_dir):
    """The latest statuses as a table that took the history in by ten batches, and merged once."""

    def make():
        kept = LatestStatus(spark, f"{shared_folder(spark)}/leadloom/latest-{uuid.uuid4().hex}")
        history = table(spark, sf_dir, "status_log")
        batch = F.pmod(F.xxhash64("order_id", "sequence"), F.lit(10))
        for number in range(10):
            kept.add(f"b{number}", history.where(batch == number))
            if number == 5:
                kept.merge()
        return kept.read()

    return inputs.stored(spark, sf_dir, "latest_kept", make)


def _from_kept(spark, sf_dir, report, run):
    names = {"detail": ("partners", "status_master", "offices"), "recap": ("status_master", "offices")}
    masters_ = [table(spark, sf_dir, n) for n in names[run]]
    leads, kept = table(spark, sf_dir, "leads"), _kept(spark, sf_dir)
    if run == "detail":
        return reports.detail_report(leads, masters_[0], kept, *masters_[1:], report)
    return reports.status_recap(leads, kept, *masters_, report)


@query
def detail_report_kept(spark, sf_dir):
    """The detail report from the maintained table."""
    return _from_kept(spark, sf_dir, WHOLE, "detail")


@query
def detail_report_kept_product_dates(spark, sf_dir):
    return _from_kept(spark, sf_dir, SEGMENT, "detail")


@query
def detail_report_kept_branch_status(spark, sf_dir):
    return _from_kept(spark, sf_dir, BRANCH, "detail")


@query
def status_recap_kept(spark, sf_dir):
    """The recap from the maintained table."""
    return _from_kept(spark, sf_dir, WHOLE, "recap")


@query
def status_recap_kept_product_dates(spark, sf_dir):
    return _from_kept(spark, sf_dir, SEGMENT, "recap")


@query
def status_recap_kept_branch_status(spark, sf_dir):
    return _from_kept(spark, sf_dir, BRANCH, "recap")


@query
def export_projection(spark, sf_dir):
    urgent = frame(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    return export.export_projection(
        table(spark, sf_dir, "leads"),
        table(spark, sf_dir, "partners"),
        catalogue(spark, sf_dir, active_only=True),
        "export_api",
        urgent.select(F.col("o_orderkey").cast("string").alias("transaction_id")),
    )


@query
def export_column_list(spark, sf_dir):
    return export.export_column_list(part_catalogue(spark, sf_dir, active_only=True))


@query
def config_row(spark, sf_dir):
    return export.config_row(table(spark, sf_dir, "file_parameters"))


# --- users -------------------------------------------------------------------------------------


def _added(spark, sf_dir):
    return users.add_users(
        frame(spark, sf_dir, "new_users"),
        table(spark, sf_dir, "users"),
        table(spark, sf_dir, "response_codes"),
        AS_OF,
    )


@query
def add_users(spark, sf_dir):
    inserted, _ = _added(spark, sf_dir)
    return texts(inserted)


@query
def add_users_replies(spark, sf_dir):
    _, answered = _added(spark, sf_dir)
    return answered
