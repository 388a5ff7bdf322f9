"""Status inquiry requests: from JSON bodies to replies and logs."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.constants import PARAMETER_ERROR, PARTNER_KIND, SYSTEM_ERROR
from leadloom.operators import replies, requests, status
from leadloom.session import materialise


@dataclass(frozen=True)
class Inquiry:
    """Results of one batch of inquiries; the logs hold the rows to append."""

    replies: DataFrame
    inquiry_log: DataFrame
    response_log: DataFrame


def inquire(
    batch: DataFrame,
    catalogue: DataFrame,
    leads: DataFrame,
    partners: DataFrame,
    status_master: DataFrame,
    response_codes: DataFrame,
    as_of: datetime,
    kind: str = PARTNER_KIND,
) -> Inquiry:
    """Answer a batch of inquiry bodies.

    An empty or unreadable body gets 30, an API name without questions 02. The partner and the order
    come from the bound answers; a body without them asks for nothing known and gets 08.
    """
    parsed = requests.with_members(batch).withColumn("no_body", F.col("members").isNull())
    frame = requests.with_params(requests.bind(parsed, catalogue))
    unknown = F.col("id_name").isNotNull() & ~F.col("registered")
    asked = frame.select(
        "request_id",
        "id_name",
        requests.param("PARTNER_ID").alias("partner_id"),
        F.coalesce(requests.param("ORDER_ID"), F.col("order_id")).alias("order_id"),
        F.when(F.col("no_body"), SYSTEM_ERROR).when(unknown, PARAMETER_ERROR).alias("early_code"),
    )
    result = materialise(
        status.status_inquiry(asked, leads, partners, status_master, response_codes, kind),
        "inquiries",
    )
    answered = status.inquiry_response(result)
    logged = answered.select(
        "request_id",
        "id_name",
        F.col("orderIdDealer").alias("order_id"),
        F.lit(None).cast("string").alias("transaction_id"),
        F.col("responseCode").alias("response_code"),
        F.col("responseMessage").alias("response_message"),
        F.lit(None).cast("string").alias("error_desc"),
        "reply",
    )
    return Inquiry(
        replies=answered,
        inquiry_log=status.log_inquiries(result, as_of),
        response_log=replies.log_responses(logged, as_of),
    )
