"""The front gate: split a mixed batch by handler, answer what cannot be routed."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.constants import NAME_UNREGISTERED, SYSTEM_ERROR
from leadloom.operators import replies, requests, rules
from leadloom.session import materialise


def split_by_handler(
    batch: DataFrame,
    parameters: DataFrame,
    question_group_h: DataFrame,
    handlers: list[str],
) -> dict[str | None, DataFrame]:
    """Requests of each handler, and under None all others: the parts add up to the batch.

    The routed batch is written once; each part is a filter on it.
    """
    routed = materialise(
        requests.route(requests.with_members(batch), parameters, question_group_h).drop("members"),
        "routed",
    )
    parts: dict[str | None, DataFrame] = {
        name: routed.filter(F.col("handler") == name).select(*batch.columns) for name in handlers
    }
    # Whatever goes to no named handler is refused: also a registered name without a handler here.
    taken = F.coalesce(F.col("handler").isin(handlers), F.lit(False)) if handlers else F.lit(False)
    refused = routed.filter(~taken)
    parts[None] = refused.withColumns(
        {
            "error": F.coalesce("error", F.lit(NAME_UNREGISTERED)),
            "response_code": F.coalesce("response_code", F.lit(SYSTEM_ERROR)),
        }
    )
    return parts


def refusals(unrouted: DataFrame, response_codes: DataFrame) -> DataFrame:
    """Replies to requests that cannot be routed: the message of the code, then the detail."""
    described = rules.response_message(unrouted, response_codes)
    answered = described.select(
        "request_id",
        "id_name",
        "order_id",
        "response_message",
        F.col("response_code").alias("responseCode"),
        F.concat("response_message", F.lit(" - "), "error").alias("responseMessage"),
        F.col("error").alias("errorMessage"),
    )
    return replies.response_envelope(answered, ["responseCode", "responseMessage"])


def log_refusals(answered: DataFrame, as_of: datetime) -> DataFrame:
    """Response log rows of `refusals`."""
    return replies.log_responses(
        answered.withColumns(
            {"response_code": F.col("responseCode"), "error_desc": F.col("errorMessage")}
        ),
        as_of,
    )
