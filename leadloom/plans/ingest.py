"""Lead intake: from JSON requests to stored leads, first status rows, replies and logs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from leadloom.constants import (
    ADDRESS_COLUMNS,
    DATE_FORMATS,
    EMPTY_BODY,
    LEAD_CODES,
    LEAD_NAME_UNREGISTERED,
    PARAMETER_ERROR,
    PARTNER_KIND,
    SUCCESS,
    SYSTEM_ERROR,
)
from leadloom.functions.text import flag
from leadloom.operators import enrich, ids, replies, requests, rules, store
from leadloom.schemas import schema
from leadloom.session import materialise
from leadloom.sources.batches import BatchStore

JOB_NAME = "lead_intake"


def _cut(df: DataFrame, label: str) -> DataFrame:
    """A lineage cut with zstd: bodies and repeated texts take about half the space they take with snappy.

    Spark deals files to tasks by their bytes, so the bodies to be parsed, which cost most work a byte,
    are left as they come.
    """
    return materialise(df, label, "zstd")


@dataclass(frozen=True)
class Masters:
    """Metadata and reference tables the intake reads."""

    catalogue: DataFrame
    response_codes: DataFrame
    partners: DataFrame
    code_map: DataFrame
    zipcodes: DataFrame
    districts: DataFrame


@dataclass(frozen=True)
class IntakeOptions:
    """Settings of the intake.

    `label_check` adds `label_error` (NULL when the body passes) to a request frame; by default
    every body passes. `lookups` are the specs of the master lookups. `echo` maps the names of the
    echo row to question codes.
    """

    partner_kind: str = PARTNER_KIND
    date_formats: tuple[str, ...] = DATE_FORMATS
    lookups: Sequence[enrich.LookupSpec] = field(default_factory=enrich.address_lookups)
    label_check: Callable[[DataFrame], DataFrame] | None = None
    echo: Mapping[str, str] = field(default_factory=lambda: {c.lower(): c for c in LEAD_CODES})


@dataclass(frozen=True)
class Intake:
    """Results of one intake; the tables hold the rows to append."""

    replies: DataFrame
    lead_requests: DataFrame
    leads: DataFrame
    status_log: DataFrame
    request_log: DataFrame
    response_log: DataFrame
    # With every reply goes the wide row of the request as it arrived.
    echoes: DataFrame


def read_requests(
    batch: DataFrame, masters: Masters, options: IntakeOptions = IntakeOptions()
) -> DataFrame:
    """Row-local part: members, bound answers, answer rules and the 25 lead columns.

    `is_unreadable` marks requests that end before the rules: no JSON object (30), an API name
    without questions (02), a label error (02), or a missing lead field (30).
    """
    parsed = requests.with_members(batch).withColumn("no_body", F.col("members").isNull())
    frame = requests.bind(parsed, masters.catalogue)
    if options.label_check is not None:
        frame = options.label_check(frame)
    else:
        frame = frame.withColumn("label_error", F.lit(None).cast("string"))
    frame = rules.check_answers(requests.with_params(frame), options.date_formats)
    missing = F.array_except(F.array(*[F.lit(c) for c in LEAD_CODES]), F.map_keys("params"))
    parameter_error = F.when(
        F.col("id_name").isNotNull() & ~F.col("registered"), LEAD_NAME_UNREGISTERED
    ).otherwise(F.col("label_error"))
    lost = F.when(F.col("no_body"), EMPTY_BODY).when(
        F.size("missing") > 0, F.concat(F.lit("missing "), F.array_join("missing", ", "))
    )
    return (
        frame.withColumn("missing", missing)
        .withColumn("parameter_error", parameter_error)
        .withColumn("error_detail", F.coalesce("parameter_error", lost))
        .withColumn(
            "early_code",
            F.when(F.col("parameter_error").isNotNull(), PARAMETER_ERROR).when(
                lost.isNotNull(), SYSTEM_ERROR
            ),
        )
        .select(
            "request_id",
            "arrival_seq",
            "arrival_ts",
            F.col("id_name"),
            "error_detail",
            "early_code",
            F.col("early_code").isNotNull().alias("is_unreadable"),
            "blank_param",
            "bad_date_param",
            "bad_number_param",
            "long_param",
            "length_limit",
            # The reply names the order even where the lead fields are incomplete.
            F.coalesce(requests.param("ORDER_ID"), F.col("order_id")).alias("order_id"),
            *[
                requests.param(c).alias(c.lower())
                for c in LEAD_CODES
                if c not in ("ORDER_ID", "ID_NAME")
            ],
            # For the request log and the echo row, which need no second parsing.
            "body",
            F.col("order_id").alias("named_order"),
            *[
                requests.param(c).alias(column)
                for c, column in _echo_columns(options).items()
                if column.startswith(_ECHOED)
            ],
        )
    )


_ECHOED = "echoed_"


def _echo_columns(options: IntakeOptions) -> dict[str, str]:
    """Question code of the echo row -> column of a request that has its answer.

    Answers that are lead columns anyway are kept once.
    """
    kept = {c: c.lower() for c in LEAD_CODES if c not in ("ORDER_ID", "ID_NAME")}
    codes = dict.fromkeys(c.upper() for c in options.echo.values())
    return {c: kept.get(c, f"{_ECHOED}{c.lower()}") for c in codes}


def _without_logged(read: DataFrame) -> DataFrame:
    """The requests without what only the request log and the echo row need."""
    return read.drop("body", "named_order", *[c for c in read.columns if c.startswith(_ECHOED)])


def echo_rows(read: DataFrame, options: IntakeOptions) -> DataFrame:
    """The answers of every request under the names of the echo row."""
    columns = _echo_columns(options)
    return read.select(
        "request_id", *[F.col(columns[c.upper()]).alias(n) for n, c in options.echo.items()]
    )


# What the rules, lookups and replies read of a request.
_CHECKED = (
    "request_id",
    "arrival_seq",
    "id_name",
    "order_id",
    "partner_id",
    "id_no",
    "early_code",
    "is_unreadable",
    "error_detail",
    "blank_param",
    "bad_date_param",
    "bad_number_param",
    "long_param",
    "length_limit",
    *ADDRESS_COLUMNS,
)
# What batch duplicates and the numbering read of a judged one.
_COUNTED = ("request_id", "arrival_seq", "order_id", "partner_id", "own_code", "is_unreadable")

ROW_ID = "row_id"


def numbered_rows(read: DataFrame) -> DataFrame:
    """The wide requests, written once, with a number of its own for every row."""
    if ROW_ID in read.columns:
        return read
    return _cut(read.withColumn(ROW_ID, F.monotonically_increasing_id()), "read")


def check_requests(
    requests: DataFrame, masters: Masters, leads: DataFrame, partner_kind: str = PARTNER_KIND
) -> DataFrame:
    """Add the outcome of the rules that need no address, and `is_mapped`.

    Only a request that passed every rule is mapped. Its partner uses its own vocabulary, so the
    masters are not asked for it, and the rules seen here decide.
    """
    checked = rules.check_duplicate(rules.check_id_number(requests), leads)
    checked = rules.check_partner(checked, masters.partners, partner_kind)
    own_vocabulary = F.col("flag_master") == 2
    passed = F.coalesce("early_code", rules.failure_code(F.lit(None))) == SUCCESS
    return checked.withColumn("is_mapped", flag(own_vocabulary & passed))


def judge_requests(
    checked: DataFrame, masters: Masters, options: IntakeOptions = IntakeOptions()
) -> DataFrame:
    """Add `own_code`, the outcome of every request before duplicates within the batch, mapped
    addresses and both pairs of sub zip codes; takes the address columns off.

    `checked` is at rest, as it is read several times. Masters, code map and sub zip codes are asked
    in narrow rows, and what they answer is joined to the requests at once. An ambiguous mapping is a
    system error. A request that is not mapped has no `<field>_mapped`, and the sub zip codes of its
    own addresses in both pairs.
    """
    specs = list(options.lookups)
    tables = {"zipcodes": masters.zipcodes, "districts": masters.districts}
    codes = _cut(
        enrich.mapped_codes(checked, masters.code_map, F.col("is_mapped")), "mapped"
    )
    own = enrich.SUB_ZIP_ADDRESSES
    translated = {f"{output}_mapped": (prefix, "_mapped") for output, (prefix, _) in own.items()}
    asked = enrich.asked_sub_zips(checked, own).unionAll(enrich.asked_sub_zips(codes, translated))
    sub_zips = enrich.found_sub_zips(
        asked,
        enrich.active_sub_zips(masters.zipcodes, masters.districts),
        [*own, *translated],
    )
    judged = checked.drop(*ADDRESS_COLUMNS)
    if specs:
        in_masters = enrich.found_in_masters(checked, tables, specs, F.col("flag_master") == 1)
        judged = judged.join(in_masters, "request_id", "left")
    judged = (
        rules.check_masters(judged)
        .drop(*[f"{c}_found" for c in ADDRESS_COLUMNS])
        .join(codes, "request_id", "left")
        .join(sub_zips, "request_id", "left")
        .withColumn("is_ambiguous", flag(F.col("is_ambiguous")))
        .withColumn("own_code", F.coalesce("early_code", rules.failure_code()))
    )
    return judged.withColumns(
        {
            "own_code": F.when(F.col("is_ambiguous"), SYSTEM_ERROR).otherwise(F.col("own_code")),
            "error_detail": F.when(F.col("is_ambiguous"), "ambiguous code mapping").otherwise(
                F.col("error_detail")
            ),
            **{
                f"{output}_mapped": F.when(
                    F.col("is_mapped"), F.col(f"{output}_mapped")
                ).otherwise(F.col(output))
                for output in own
            },
        }
    )


def outcomes(
    wide: DataFrame,
    masters: Masters,
    leads: DataFrame,
    acq_start: int = 1,
    transaction_start: int = 1,
    options: IntakeOptions = IntakeOptions(),
) -> DataFrame:
    """One narrow row per request, by its row number: outcome, message, ids and mapped addresses.

    It is all that replies and first status rows need. The joins take only the columns that the rules
    and lookups read, batch duplicates and the numbering a few of these. Rows that several of these
    steps read are written in between.
    """
    checked = _cut(
        check_requests(wide.select(ROW_ID, *_CHECKED), masters, leads, options.partner_kind), "checked"
    )
    judged = _cut(judge_requests(checked, masters, options), "judged")
    final = _cut(
        rules.check_batch_duplicates(judged.select(ROW_ID, *_COUNTED)).select(
            ROW_ID, "arrival_seq", "response_code"
        ),
        "codes",
    )
    counted = ids.allocate_ids(
        final,
        "arrival_seq",
        F.col("response_code") == SUCCESS,
        acq_start,
        transaction_start,
    ).select(ROW_ID, "response_code", "acq_id", "transaction_id")
    found = judged.join(counted, ROW_ID).withColumn(
        "error_detail", F.when(F.col("response_code") == F.col("own_code"), F.col("error_detail"))
    )
    return rules.with_message(found, masters.response_codes)


def whole_requests(wide: DataFrame, outcome: DataFrame) -> DataFrame:
    """The wide requests with their outcome, joined by the number of the row, as request ids may repeat."""
    known = [c for c in outcome.columns if c != ROW_ID]
    mapped = {
        f"{c}_mapped": F.when(F.col("is_mapped"), F.col(f"{c}_mapped")).otherwise(F.col(c))
        for c in ADDRESS_COLUMNS
    }
    rest = _without_logged(wide).drop(*known)
    return rest.join(outcome, ROW_ID).withColumns(mapped).drop(ROW_ID, "is_mapped")


def validate_requests(
    batch: DataFrame,
    masters: Masters,
    leads: DataFrame,
    acq_start: int = 1,
    transaction_start: int = 1,
    options: IntakeOptions = IntakeOptions(),
) -> DataFrame:
    """One row per request with outcome, message, ids, mapped addresses and sub zip codes.

    The wide requests are written once, and joined last and once with their outcomes.
    """
    wide = numbered_rows(read_requests(batch, masters, options))
    outcome = outcomes(wide, masters, leads, acq_start, transaction_start, options)
    return whole_requests(wide, outcome)


def ingest(
    batch: DataFrame,
    masters: Masters,
    leads: DataFrame,
    as_of: datetime,
    acq_start: int = 1,
    transaction_start: int = 1,
    options: IntakeOptions = IntakeOptions(),
) -> Intake:
    """Validate a batch and derive the seven outputs; the bodies are parsed once.

    What is kept between the outputs are the requests as read and their outcomes. Only the stored
    requests and leads join the two: a wide row is not written a second time for the others.
    """
    read = numbered_rows(read_requests(batch, masters, options))
    outcome = _cut(
        outcomes(read, masters, leads, acq_start, transaction_start, options), "outcome"
    )
    validated = whole_requests(read, outcome)
    answered = replies.lead_replies(outcome)
    return Intake(
        replies=answered,
        lead_requests=store.store_requests(validated, as_of),
        leads=store.store_leads(validated, as_of),
        status_log=store.open_status(outcome, as_of),
        request_log=replies.log_requests(read.withColumn("order_id", F.col("named_order")), as_of),
        response_log=replies.log_lead_replies(answered, as_of),
        echoes=echo_rows(read, options),
    )


_STORED = {
    "lead_requests": "lead_requests",
    "leads": "leads",
    "status_log": "status_log",
    "request_log": "api_request_log",
    "response_log": "api_response_log",
}
_COUNTERS = StructType(
    [StructField("acq_next", LongType()), StructField("transaction_next", LongType())]
)


def stored_rows(batches: BatchStore, output: str) -> DataFrame:
    """Rows of one output of all committed batches."""
    return batches.read(output, schema(_STORED[output]))


def commit_intake(
    batches: BatchStore,
    batch_id: str,
    batch: DataFrame,
    masters: Masters,
    now: Callable[[], datetime],
    options: IntakeOptions = IntakeOptions(),
) -> bool:
    """Ingest a batch against the committed ones and commit all its results at once.

    Ids continue from the committed batches, so a batch that is run again after a failure gets the
    same ids. False if the batch is committed already. The job log gets START and END, or ERROR.
    """

    def outputs() -> dict[str, DataFrame]:
        # One row per batch, reduced to one.
        last = batches.read("counters", _COUNTERS).agg(
            F.coalesce(F.max("acq_next"), F.lit(1)),
            F.coalesce(F.max("transaction_next"), F.lit(1)),
        )
        acq_start, transaction_start = last.first()
        leads = stored_rows(batches, "leads")
        result = ingest(batch, masters, leads, now(), acq_start, transaction_start, options)
        counts = result.replies.agg(
            (F.count("*") + acq_start).alias("acq_next"),
            (F.count_if(F.col("responseCode") == SUCCESS) + transaction_start).alias(
                "transaction_next"
            ),
        )
        tables = {name: getattr(result, name) for name in (*_STORED, "replies", "echoes")}
        return tables | {"counters": counts}

    return batches.run(batch_id, JOB_NAME, outputs, now)
