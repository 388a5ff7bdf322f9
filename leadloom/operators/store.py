"""Rows for the state tables: stored requests, leads, first status, and rollback.

Parquet has no update or delete. Appends are returned as the rows to append, changes as the new
version of the table; the caller writes either.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.constants import (
    ADDRESS_COLUMNS,
    LEAD_COLUMNS,
    PRODUCT_TYPE,
    SOURCE_DATA,
    SOURCE_OF_APPLICATION,
    STATUS_RECEIVED,
    SUCCESS,
    SYSTEM_ERROR,
)
from leadloom.functions.joins import lookup
from leadloom.functions.text import key, real_value
from leadloom.operators.rules import message_templates
from leadloom.schemas import schema


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns of `df` in the order and types of a table; columns it lacks become NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema(table).fields
        ]
    )


def store_requests(validated: DataFrame, as_of: datetime) -> DataFrame:
    """Every request as a `lead_requests` row, in the vocabulary of the partner."""
    own = {c: real_value(c) for c in LEAD_COLUMNS}
    return conform(
        validated.withColumns(
            {
                **own,
                **_stamp(as_of),
                "message": F.col("response_message"),
                "dtm_response": _time(as_of),
            }
        ),
        "lead_requests",
    )


def store_leads(validated: DataFrame, as_of: datetime) -> DataFrame:
    """Accepted requests as `leads` rows, in internal vocabulary."""
    own = {c: real_value(c) for c in LEAD_COLUMNS}
    mapped = {c: real_value(f"{c}_mapped") for c in ADDRESS_COLUMNS}
    return conform(
        validated.filter(F.col("response_code") == SUCCESS).withColumns(
            {
                **own,
                **mapped,
                **_stamp(as_of),
                "survey_sub_zip_code": F.col("survey_sub_zip_code_mapped"),
                "legal_sub_zip_code": F.col("legal_sub_zip_code_mapped"),
            }
        ),
        "leads",
    )


def open_status(validated: DataFrame, as_of: datetime) -> DataFrame:
    """First status row of every accepted request."""
    return conform(
        validated.filter(F.col("response_code") == SUCCESS).withColumns(
            {
                "sequence": F.lit(1),
                "id_status": F.lit(STATUS_RECEIVED),
                "status_dt": _time(as_of),
                "dtm_crt": _time(as_of),
                "usr_crt": F.col("id_name"),
            }
        ),
        "status_log",
    )


def rollback_failed(
    leads: DataFrame,
    lead_requests: DataFrame,
    status_log: DataFrame,
    failed: DataFrame,
    response_codes: DataFrame,
    as_of: datetime,
    keep_status: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """New versions of `leads`, `lead_requests` and `status_log` after system errors.

    `failed` has `partner_id, order_id, transaction_id`. The request row gets code 30 and loses
    its transaction id; the lead goes, and with it its status rows unless `keep_status`.
    """
    names = ("partner_id", "order_id", "transaction_id")
    keys = (
        failed.select(*[key(c).alias(f"failed_{c}") for c in names])
        .dropna()
        .distinct()
        .withColumn("is_failed", F.lit(True))
    )
    keys = lookup(keys, *[f"failed_{c}" for c in names])
    matches = [key(c) == F.col(f"failed_{c}") for c in names]
    templates = message_templates(response_codes).filter(F.col("response_code") == SYSTEM_ERROR)
    failed_row = F.col("is_failed").isNotNull()
    changed = {
        "response_code": F.lit(SYSTEM_ERROR),
        "message": templates.select("template").scalar(),
        "dtm_response": _time(as_of),
        "transaction_id": F.lit(None).cast("string"),
    }
    requests = lead_requests.join(keys, matches, "left").withColumns(
        {c: F.when(failed_row, new).otherwise(F.col(c)) for c, new in changed.items()}
    )
    history = status_log if keep_status else status_log.join(keys, matches, "left_anti")
    return (
        leads.join(keys, matches, "left_anti"),
        requests.select(*lead_requests.columns),
        history,
    )


def _stamp(as_of: datetime) -> dict[str, Column]:
    return {
        "product_type_desc": F.lit(PRODUCT_TYPE),
        "soa": F.lit(SOURCE_OF_APPLICATION),
        "source_data": F.lit(SOURCE_DATA),
        "id_status": F.lit(STATUS_RECEIVED),
        "dtm_crt": _time(as_of),
        "usr_crt": F.col("id_name"),
        "order_dt": _time(as_of),
    }


def _time(as_of: datetime) -> Column:
    return F.lit(as_of).cast("timestamp")
