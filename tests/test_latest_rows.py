"""The rows of the latest date per key take two shuffles of the history."""

from __future__ import annotations

from datetime import datetime

from leadloom.operators.latest import _keyed, _of_any_status, latest_rows

_HISTORY = "order_id string, transaction_id string, partner_id string, status_dt timestamp, id_status int"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_rows_shuffle_a_history_twice(spark):
    day, later = datetime(2024, 1, 1), datetime(2024, 1, 2)
    rows = [
        ("o1", "t1", "p", day, 1),
        ("o1", "t1", "p", later, 2),
        ("O1 ", "t1", "p", later, 2),
        ("o1", "t1", "p", later, None),
        ("o2", "t2", "p", day, None),
        (None, "t3", "p", day, 4),
    ]
    history = spark.createDataFrame(rows, _HISTORY)
    found = latest_rows(history)
    assert _plan(found).count("Exchange hashpartitioning") == 2
    got = {(r["order_id"], r["status_dt"], r["id_status"], r["n"]) for r in found.collect()}
    assert got == {("o1", later, 2, 2), ("o1", later, None, 1), ("o2", day, None, 1)}
    other = _of_any_status(_keyed(history)).select("order_key", "status_dt", "id_status", "n")
    assert {tuple(r) for r in other.collect()} == got
    assert latest_rows(history.limit(0)).collect() == []
