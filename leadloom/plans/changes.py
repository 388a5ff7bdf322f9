"""Status transitions and rollbacks on stored tables, by affected day.

The tables lie in one folder each below a root. Each change stages the new days of all its tables
before the first one is replaced: what breaks off later is finished by `recover`.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from leadloom.constants import STATUS_FAILED
from leadloom.operators.status import status_transition
from leadloom.operators.store import rollback_failed
from leadloom.session import materialise
from leadloom.sources import updates
from leadloom.sources.tables import append_table, read_days, read_table

Days = dict[str, list[date | None]]

_ROLLED_BACK = ("leads", "lead_requests", "status_log")
_KEYS = ("partner_id", "order_id", "transaction_id")


def recover(spark: SparkSession, root: str) -> None:
    """Finish changes that broke off."""
    for table in _ROLLED_BACK:
        updates.recover(spark, f"{root}/{table}", table)


def transition(
    spark: SparkSession,
    root: str,
    changes: DataFrame,
    as_of: datetime,
    status: int = STATUS_FAILED,
    keep_unmatched: bool = False,
) -> Days:
    """Set the status of stored leads and append the status rows; returns the rewritten days.

    Leads outside the days of the changed transactions are neither read whole nor written.
    """
    recover(spark, root)
    path = f"{root}/leads"
    stored = read_days(spark, path, "leads")
    days = updates.affected_days(stored, changes, "transaction_id")
    part = updates.of_days(stored, days).drop("day")
    history = read_table(spark, f"{root}/status_log", "status_log")
    new_leads, appended = status_transition(
        part, history, changes, as_of, status, keep_unmatched
    )
    appended = materialise(appended, "transition-rows")
    if days:
        updates.apply(spark, path, "leads", updates.stage(new_leads, path, "leads", days))
    append_table(appended, f"{root}/status_log", "status_log")
    return {"leads": days}


def rollback(
    spark: SparkSession,
    root: str,
    failed: DataFrame,
    response_codes: DataFrame,
    as_of: datetime,
    keep_status: bool = False,
) -> Days:
    """Take back stored leads after system errors; returns the rewritten days per table.

    `failed` has `partner_id, order_id, transaction_id`. The request keeps its row with code 30 and no
    transaction, the lead goes, and with it its status rows unless `keep_status`.
    """
    recover(spark, root)
    failed = materialise(failed.select(*_KEYS), "rollback-keys")
    tables = {t: read_days(spark, f"{root}/{t}", t) for t in _ROLLED_BACK}
    days = {t: updates.affected_days(rows, failed, *_KEYS) for t, rows in tables.items()}
    if keep_status:
        days["status_log"] = []
    parts = [updates.of_days(tables[t], days[t]).drop("day") for t in _ROLLED_BACK]
    changed = rollback_failed(*parts, failed, response_codes, as_of, keep_status)
    staged = {
        t: updates.stage(rows, f"{root}/{t}", t, days[t])
        for t, rows in zip(_ROLLED_BACK, changed, strict=True)
        if days[t]
    }
    for table, folder in staged.items():
        updates.apply(spark, f"{root}/{table}", table, folder)
    return days
