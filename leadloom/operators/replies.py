"""Replies as JSON and the request, response and job logs."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.constants import (
    MESSAGE_TYPE,
    PARAMETER_ERROR,
    PARAMETER_ERROR_PREFIX,
    SUCCESS,
    SYSTEM_USER,
)
from leadloom.operators.store import conform


def response_envelope(df: DataFrame, fields: Sequence[str], output: str = "reply") -> DataFrame:
    """Add the JSON object of `fields`; a NULL field is left out."""
    return df.withColumn(output, F.to_json(F.struct(*fields)))


def lead_replies(validated: DataFrame, error_width: int = 100) -> DataFrame:
    """Reply fields of lead requests and their JSON.

    Needs `request_id, id_name, order_id, transaction_id, response_code, response_message,
    error_detail`. The reply cuts the detail of an error at `error_width` characters; the column
    `error_detail` keeps it whole for the log.
    """
    accepted = F.col("response_code") == SUCCESS
    detail = F.when(~accepted, F.col("error_detail"))
    message = F.when(
        F.col("response_code") == PARAMETER_ERROR,
        F.concat(F.lit(PARAMETER_ERROR_PREFIX), F.coalesce("error_detail", F.lit(""))),
    ).otherwise(F.col("response_message"))
    replies = validated.select(
        "request_id",
        "id_name",
        F.col("transaction_id"),
        F.col("response_message"),
        F.col("response_code").alias("responseCode"),
        message.alias("responseMessage"),
        F.substring(detail, 1, error_width).alias("errorMessage"),
        detail.alias("error_detail"),
        F.col("order_id").alias("orderIdDealer"),
        F.when(accepted, F.col("transaction_id")).otherwise("").alias("orderId"),
        F.lit(MESSAGE_TYPE).alias("mtType"),
    )
    return response_envelope(
        replies,
        ["responseCode", "responseMessage", "errorMessage", "orderIdDealer", "orderId", "mtType"],
    )


def log_requests(frame: DataFrame, as_of: datetime) -> DataFrame:
    """Request log rows: the body as received under the id of the request."""
    return conform(
        frame.withColumns(
            {
                "parameter": F.col("body"),
                "request_dt": _time(as_of),
                "response_id": F.col("request_id"),
                "dtm_crt": _time(as_of),
                "usr_crt": F.lit(SYSTEM_USER),
            }
        ),
        "api_request_log",
    )


def log_responses(replies: DataFrame, as_of: datetime) -> DataFrame:
    """Response log rows with the reply JSON.

    Needs `request_id, id_name, order_id, transaction_id, response_code, response_message,
    error_desc, reply`.
    """
    return conform(
        replies.withColumns(
            {
                "response_dt": _time(as_of),
                "response_id": F.col("request_id"),
                "dtm_crt": _time(as_of),
                "usr_crt": F.lit(SYSTEM_USER),
                "parameter": F.col("reply"),
            }
        ),
        "api_response_log",
    )


def log_lead_replies(replies: DataFrame, as_of: datetime) -> DataFrame:
    """Response log rows of `lead_replies`."""
    return log_responses(
        replies.withColumns(
            {
                "order_id": F.col("orderIdDealer"),
                "response_code": F.col("responseCode"),
                "error_desc": F.col("error_detail"),
            }
        ),
        as_of,
    )


def job_audit(runs: DataFrame) -> DataFrame:
    """Job log rows of `proc_name, status, error, at`: START, END, or ERROR with its text."""
    failed = F.upper("status") == "ERROR"
    message = F.when(
        failed, F.concat(F.lit("ERROR : "), F.coalesce("error", F.lit("-")))
    ).otherwise(F.upper("status"))
    return conform(
        runs.select("proc_name", F.col("at").alias("date_processed"), message.alias("err_message")),
        "job_log",
    )


def job_run(spark: SparkSession, name: str, started: datetime, ended: datetime) -> DataFrame:
    """START and END row of one finished job."""
    runs = [(name, "START", None, started), (name, "END", None, ended)]
    return job_audit(
        spark.createDataFrame(runs, "proc_name string, status string, error string, at timestamp")
    )


def _time(as_of: datetime) -> Column:
    return F.lit(as_of).cast("timestamp")
