"""Order status: inquiry, history and transitions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.constants import (
    PARTNER_KIND,
    STATUS_FAILED,
    SUCCESS,
    UNKNOWN_ORDER,
    UNKNOWN_PARTNER,
)
from leadloom.functions.joins import lookup
from leadloom.functions.text import flag, key, short, spread_key
from leadloom.operators.ids import running_numbers
from leadloom.operators.replies import response_envelope
from leadloom.operators.rules import check_partner, message_templates
from leadloom.operators.store import conform

_LEAD_FIELDS = (
    "partner_id",
    "phone_number",
    "id_status",
    "agrmnt_no",
    "instalment_amt",
    "transaction_id",
    "full_name",
    "po_dp",
    "po_no",
    "po_date",
    "po_tenor",
)


def status_inquiry(
    inquiries: DataFrame,
    leads: DataFrame,
    partners: DataFrame,
    status_master: DataFrame,
    response_codes: DataFrame,
    kind: str = PARTNER_KIND,
) -> DataFrame:
    """Outcome and details per inquiry (`request_id, id_name, partner_id, order_id`).

    08: the partner is not registered; 07: the order is unknown or belongs to other partners
    only; else 00. Leads are first cut down to the orders asked for. An `early_code` of the inquiry,
    where the column is there, comes before all of these.
    """
    early = F.col("early_code") if "early_code" in inquiries.columns else F.lit(None)
    order = key("order_id")
    # No distinct keys are needed, and the comparison lets Spark send a bloom filter of them to a
    # large scan of the leads (a missing key passes it neither).
    wanted = inquiries.select(order.alias("order_key")).where(F.col("order_key") >= "")
    asked = leads.withColumns({"order_key": order, "partner_key": key("partner_id")}).join(
        wanted, "order_key", "left_semi"
    )
    # The newest lead of a (partner, order); NULL keys match nothing.
    found = (
        asked.dropna(subset=["partner_key"])
        .groupBy("order_key", "partner_key")
        .agg(F.max_by(F.struct(*_LEAD_FIELDS), "acq_id").alias("lead"))
    )
    names = partners.filter(F.col("id_partner").isNotNull()).groupBy(
        key("id_partner").alias("name_key")
    ).agg(F.max("name").alias("dealer_name"))
    statuses = status_master.groupBy(F.col("id_status").cast("string").alias("status_key")).agg(
        F.max("status").alias("status")
    )
    # Few statuses are shared by all leads, and unknown orders have none.
    status_key = spread_key(F.col("lead.id_status").cast("string"), "request_id")
    name_key = spread_key(F.col("lead.partner_id"), "request_id")
    code = (
        F.when(early.isNotNull(), early)
        .when(~F.col("is_registered"), UNKNOWN_PARTNER)
        .when(F.col("lead").isNull(), UNKNOWN_ORDER)
        .otherwise(SUCCESS)
    )
    messages = message_templates(response_codes).withColumnRenamed("template", "response_message")
    return (
        check_partner(inquiries, partners, kind)
        .withColumns(
            {"order_key": spread_key("order_id", "request_id"), "partner_key": key("partner_id")}
        )
        .join(lookup(found, "order_key", "partner_key"), ["order_key", "partner_key"], "left")
        .withColumn("response_code", code)
        .join(lookup(statuses, "status_key"), status_key == F.col("status_key"), "left")
        .join(lookup(names, "name_key"), name_key == F.col("name_key"), "left")
        .join(messages, "response_code", "left")
        .select(
            "request_id",
            "id_name",
            "partner_id",
            "order_id",
            "response_code",
            "response_message",
            "status",
            "dealer_name",
            F.col("lead.partner_id").alias("lead_partner_id"),
            *[F.col(f"lead.{c}").alias(c) for c in _LEAD_FIELDS if c not in ("partner_id", "id_status")],
        )
    )


# Reply field -> column of the inquiry result, in reply order.
INQUIRY_FIELDS = {
    "responseCode": "response_code",
    "responseMessage": "response_message",
    "orderIdDealer": "order_id",
    "orderId": "transaction_id",
    "dealerId": "partner_id",
    "dealerName": "dealer_name",
    "fullName": "full_name",
    "statusOrder": "status",
    "agrmntNo": "agrmnt_no",
    "poNo": "po_no",
    "poDate": "po_date",
    "poDp": "po_dp",
    "poTenor": "po_tenor",
    "instalmentAmt": "instalment_amt",
}

_ALWAYS_SHOWN = ("responseCode", "responseMessage", "orderIdDealer", "dealerId")


def inquiry_response(result: DataFrame) -> DataFrame:
    """The 14 reply fields and their JSON; a failed inquiry shows no details."""
    succeeded = F.col("response_code") == SUCCESS
    fields = {}
    for field, column in INQUIRY_FIELDS.items():
        value = F.col(column)
        if field == "poDate":
            value = F.date_format(value, "yyyy-MM-dd")
        if field not in _ALWAYS_SHOWN:
            value = F.when(succeeded, value)
        fields[field] = F.coalesce(value, F.lit("")).alias(field)
    replies = result.select("request_id", "id_name", *fields.values())
    return response_envelope(replies, list(INQUIRY_FIELDS))


def log_inquiries(
    result: DataFrame, as_of: datetime, strict_nulls: bool = False, width: int | None = None
) -> DataFrame:
    """Inquiry log rows; `data_inquiry` joins the details with commas.

    Details are logged whole; `width` cuts each at that many characters.

    With `strict_nulls` a missing partner, order, phone, status or status date makes the whole
    text NULL; the status date is never known here, so the text is then always NULL.
    """
    blank = F.lit("")
    missing = F.lit(None).cast("string") if strict_nulls else blank
    required = [
        short(F.col(c), width) for c in ("lead_partner_id", "order_id", "phone_number", "status")
    ] + [missing]
    optional = [
        short(F.col("po_no"), width),
        short(F.col("po_dp"), width),
        F.date_format("po_date", "yyyy-MM-dd"),
        short(F.col("po_tenor"), width),
    ]
    parts = [c if strict_nulls else F.coalesce(c, blank) for c in required] + [
        F.coalesce(c, blank) for c in optional
    ]
    joined = parts[0]
    for part in parts[1:]:
        joined = F.concat(joined, F.lit(","), part)
    return conform(
        result.withColumns(
            {
                "message": F.col("response_message"),
                "data_inquiry": joined,
                "dtm_response": _time(as_of),
                "dtm_crt": _time(as_of),
                "usr_crt": F.col("id_name"),
                "usr_upd": F.col("id_name"),
                "dtm_upd": _time(as_of),
            }
        ),
        "inquiry_log",
    )


def max_sequence(status_log: DataFrame, by: str = "order_id") -> DataFrame:
    """Highest status sequence per order (or per transaction)."""
    return (
        status_log.filter(F.col(by).isNotNull())
        .groupBy(key(by).alias(f"{by}_key"))
        .agg(F.max("sequence").alias("max_sequence"))
    )


def status_transition(
    leads: DataFrame,
    status_log: DataFrame,
    changes: DataFrame,
    as_of: datetime,
    status: int = STATUS_FAILED,
    keep_unmatched: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Set the status of leads: `(new version of leads, status rows to append)`.

    `changes` has `change_seq` (unique), `transaction_id` and `id_name`. Each change appends a
    row with the next sequence of its transaction; several changes of one transaction count on
    in the order of `change_seq`. A transaction without history has no next sequence (NULL).
    With `keep_unmatched`, changes of unknown transactions append a row too.
    """
    changes = changes.withColumn("change_key", key("transaction_id"))
    changed = changes.select("change_key").dropna().distinct().withColumn("is_changed", F.lit(True))
    changed = lookup(changed, "change_key")
    lead_key = key("transaction_id")
    new_leads = (
        leads.join(changed, lead_key == F.col("change_key"), "left")
        .withColumn(
            "id_status",
            F.when(F.col("is_changed"), F.lit(status)).otherwise(F.col("id_status")),
        )
        .select(*leads.columns)
    )
    owners = (
        leads.withColumn("change_key", lead_key)
        .join(changed, "change_key", "left_semi")
        .groupBy("change_key")
        .agg(F.max_by(F.struct("order_id", "partner_id"), "acq_id").alias("owner"))
    )
    history = (
        status_log.withColumn("change_key", key("transaction_id"))
        .join(changed, "change_key", "left_semi")
        .groupBy("change_key")
        .agg(F.max("sequence").alias("max_sequence"))
    )
    counted = running_numbers(changes, "change_seq", {"nth": F.lit(True)}, within=["change_key"])
    appended = (
        counted.join(
            lookup(owners, "change_key"), "change_key", "left" if keep_unmatched else "inner"
        )
        .join(lookup(history, "change_key"), "change_key", "left")
        .select(
            F.col("owner.order_id").alias("order_id"),
            "transaction_id",
            F.col("owner.partner_id").alias("partner_id"),
            (F.col("max_sequence") + F.col("nth")).alias("sequence"),
            F.lit(status).alias("id_status"),
            _time(as_of).alias("status_dt"),
            _time(as_of).alias("dtm_crt"),
            F.col("id_name").alias("usr_crt"),
        )
    )
    return new_leads, conform(appended, "status_log")


def latest_status(status_log: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """History rows of the latest date of their (order, transaction, partner), ties kept.

    With `of`, rows with those three columns, only their histories are aggregated and returned.
    The latest dates are aggregated before the shuffle and joined back with the date as part of
    the key, so the rows of one long history spread over as many partitions as it has dates.
    """
    names = ("order_id", "transaction_id", "partner_id")
    keys = [f"{c}_key" for c in names]
    keyed = status_log.withColumns({f"{c}_key": key(c) for c in names})
    dated = keyed.dropna(subset=[*keys, "status_dt"])
    if of is not None:
        wanted = of.select(*[key(c).alias(f"{c}_key") for c in names]).dropna().distinct()
        dated = dated.join(lookup(wanted, *keys), keys, "left_semi")
    latest = (
        dated
        .groupBy(*keys)
        .agg(F.max("status_dt").alias("status_dt"))
    )
    return keyed.join(latest, [*keys, "status_dt"], "left_semi").select(*status_log.columns)


def _time(as_of: datetime) -> Column:
    return F.lit(as_of).cast("timestamp")
