"""Validation rules and the outcome of a request: the first rule that fails gives its code."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.constants import (
    BAD_ID_NUMBER,
    DATE_FORMATS,
    DUPLICATE_ORDER,
    MANDATORY,
    MASTER_CODES,
    NOT_A_DATE,
    NOT_NUMERIC,
    PARTNER_KIND,
    SUCCESS,
    TOO_LONG,
    UNKNOWN_PARTNER,
)
from leadloom.functions.checks import bad_date, bad_id_number, bad_number, too_long
from leadloom.functions.joins import lookup
from leadloom.functions.text import fill, flag, is_blank, key, spread_key


# --- rules over the bound answers of a request (row-local) -------------------------------------


def check_mandatory(frame: DataFrame) -> DataFrame:
    """Add `blank_param`: the first mandatory answer that is present and blank."""
    return _first_offender(
        frame, "blank_param", lambda b: b["is_mandatory"] & is_blank(b["string_value"])
    )


def check_date(frame: DataFrame, formats: tuple[str, ...] = DATE_FORMATS) -> DataFrame:
    """Add `bad_date_param`: the first date answer that no accepted notation reads."""
    return _first_offender(
        frame, "bad_date_param", lambda b: b["is_date"] & bad_date(b["string_value"], formats)
    )


def check_numeric(frame: DataFrame) -> DataFrame:
    """Add `bad_number_param`: the first numeric answer that is not a number."""
    return _first_offender(
        frame, "bad_number_param", lambda b: b["is_numeric"] & bad_number(b["string_value"])
    )


def check_length(frame: DataFrame) -> DataFrame:
    """Add `long_param` and `length_limit`: the first answer longer than its limit."""
    found = F.get(
        F.filter("bound", lambda b: too_long(b["string_value"], b["max_length"])), F.lit(0)
    )
    return frame.withColumns({"long_param": found["name"], "length_limit": found["max_length"]})


def check_answers(frame: DataFrame, formats: tuple[str, ...] = DATE_FORMATS) -> DataFrame:
    """All four answer rules at once."""
    return check_length(check_numeric(check_date(check_mandatory(frame), formats)))


def _first_offender(
    frame: DataFrame, column: str, fails: Callable[[Column], Column]
) -> DataFrame:
    return frame.withColumn(column, F.get(F.filter("bound", fails), F.lit(0))["name"])


# --- rules over the wide request ---------------------------------------------------------------


def check_duplicate(requests: DataFrame, leads: DataFrame) -> DataFrame:
    """Add `is_stored`: a lead of the same partner and order exists already.

    The stored leads are first cut down to the orders of this batch, so a small batch is sent
    to the leads and not the other way round. In place of the leads there may be their keys in
    buckets (`sources.buckets`): then the keys of the batch are sent to the buckets, and the stored
    side is not shuffled.
    """
    order, partner = key("order_id"), key("partner_id")
    if set(leads.columns) == {"order_key", "partner_key"}:
        wanted = requests.select(order.alias("order_key"), partner.alias("partner_key"))
        stored = wanted.dropna().distinct().join(leads, ["order_key", "partner_key"], "left_semi")
    else:
        # Semi-joins need no distinct keys, and the comparison lets Spark send a bloom filter of
        # the batch's keys to a large scan of the leads (a missing key passes it neither).
        wanted = requests.select(order.alias("order_key")).where(F.col("order_key") >= "")
        stored = (
            leads.select(order.alias("order_key"), partner.alias("partner_key"))
            .join(wanted, "order_key", "left_semi")
            .distinct()
        )
    stored = stored.withColumn("is_stored", F.lit(True))
    keyed = requests.withColumns(
        {"order_key": spread_key("order_id", "request_id"), "partner_key": partner}
    )
    return (
        keyed.join(lookup(stored, "order_key", "partner_key"), ["order_key", "partner_key"], "left")
        .drop("order_key", "partner_key")
        .withColumn("is_stored", flag(F.col("is_stored")))
    )


def check_batch_duplicates(requests: DataFrame) -> DataFrame:
    """Turn later requests of an already accepted (partner, order) into duplicates.

    Only accepted requests become leads, so a request is a duplicate when an earlier one of the
    batch was accepted. The mandatory rule comes first and keeps its code. Keys seen once, and
    requests without a key, cannot be duplicates and are left out of the key table.
    """
    keyed = requests.withColumns(
        {"order_key": key("order_id"), "partner_key": key("partner_id")}
    )
    accepted = F.when(F.col("own_code") == SUCCESS, F.col("arrival_seq"))
    first_accepted = (
        keyed.dropna(subset=["order_key", "partner_key"])
        .groupBy("order_key", "partner_key")
        .agg(F.min(accepted).alias("first_accepted"), F.count("*").alias("n"))
        .filter("n > 1 and first_accepted is not null")
        .drop("n")
    )
    late = flag(F.col("arrival_seq") > F.col("first_accepted"))
    # Rules tested before the duplicate rule keep their code.
    earlier = F.col("own_code").isin(MANDATORY) | F.col("is_unreadable")
    return (
        keyed.withColumn("order_key", spread_key("order_id", "request_id"))
        .join(
            lookup(first_accepted, "order_key", "partner_key"), ["order_key", "partner_key"], "left"
        )
        .withColumn(
            "response_code", F.when(late & ~earlier, DUPLICATE_ORDER).otherwise(F.col("own_code"))
        )
        .drop("order_key", "partner_key", "first_accepted")
    )


def check_partner(
    requests: DataFrame, partners: DataFrame, kind: str = PARTNER_KIND
) -> DataFrame:
    """Add `is_registered` (a partner of that kind) and `flag_master` (of any kind).

    Where the rows have a `request_id`, those without a partner are spread by it.
    """
    asked = key("partner_id")
    if "request_id" in requests.columns:
        asked = spread_key("partner_id", "request_id")
    known = (
        partners.filter(F.col("id_partner").isNotNull())
        .groupBy(key("id_partner").alias("known_partner"))
        .agg(
            F.max(flag(key("flag_master_partner") == kind.lower())).alias("is_registered"),
            F.max("flag_master").alias("flag_master"),
        )
    )
    return (
        requests.join(lookup(known, "known_partner"), asked == F.col("known_partner"), "left")
        .drop("known_partner")
        .withColumn("is_registered", flag(F.col("is_registered")))
    )


def check_id_number(requests: DataFrame) -> DataFrame:
    """Add `is_bad_id_number`."""
    return requests.withColumn("is_bad_id_number", bad_id_number(F.col("id_no")))


def check_masters(requests: DataFrame) -> DataFrame:
    """Add `master_code`: the first address field missing from the masters, in fixed order.

    Reads the `<field>_found` columns of `master_lookup`; only partners whose addresses are
    given in master vocabulary (`flag_master` = 1) are tested.
    """
    tested = flag(F.col("flag_master") == 1)
    missing = [
        F.when(tested & F.col(f"{field}_found").isNull(), code)
        for field, code in MASTER_CODES.items()
    ]
    return requests.withColumn("master_code", F.coalesce(*missing))


# --- outcome -----------------------------------------------------------------------------------


def first_failure(requests: DataFrame, response_codes: DataFrame) -> DataFrame:
    """Add `response_code` and `response_message` from the rule columns, in rule order."""
    return with_message(requests.withColumn("response_code", failure_code()), response_codes)


def failure_code(master_code: Column | str = "master_code") -> Column:
    """Code of the first failing rule, `00` when none fails; `master_code` is that of the masters."""
    return F.coalesce(
        F.when(F.col("blank_param").isNotNull(), MANDATORY),
        F.when(F.col("is_stored"), DUPLICATE_ORDER),
        F.when(~F.col("is_registered"), UNKNOWN_PARTNER),
        F.when(F.col("is_bad_id_number"), BAD_ID_NUMBER),
        F.when(F.col("bad_date_param").isNotNull(), NOT_A_DATE),
        F.when(F.col("bad_number_param").isNotNull(), NOT_NUMERIC),
        F.when(F.col("long_param").isNotNull(), TOO_LONG),
        F.col(master_code) if isinstance(master_code, str) else master_code,
        F.lit(SUCCESS),
    )


def with_message(requests: DataFrame, response_codes: DataFrame) -> DataFrame:
    """Add `response_message`: the template of the code with its places filled in.

    The code always comes from the rule, so a code the master lacks only loses its message.
    """
    code = F.col("response_code")
    offender = (
        F.when(code == MANDATORY, F.col("blank_param"))
        .when(code == NOT_A_DATE, F.col("bad_date_param"))
        .when(code == NOT_NUMERIC, F.col("bad_number_param"))
        .when(code == TOO_LONG, F.col("long_param"))
    )
    return (
        requests.join(message_templates(response_codes), "response_code", "left")
        .withColumn(
            "response_message",
            fill(F.col("template"), Param_IN=offender, n=F.col("length_limit")),
        )
        .drop("template")
    )


def message_templates(response_codes: DataFrame) -> DataFrame:
    """`response_code, template`, one row per code."""
    templates = response_codes.groupBy(F.rtrim("response_code").alias("response_code")).agg(
        F.min("response_message").alias("template")
    )
    return lookup(templates, "response_code")


def response_message(codes: DataFrame, response_codes: DataFrame) -> DataFrame:
    """`response_code, response_message` of each asked code; NULL where the master lacks it."""
    templates = message_templates(response_codes).withColumnRenamed("template", "response_message")
    return codes.join(templates, "response_code", "left")
