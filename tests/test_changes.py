from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from leadloom.operators import store
from leadloom.plans import changes
from leadloom.sources import files, updates
from leadloom.sources.tables import read_days, read_table, stored_day, write_version
from tests.conftest import mapping, rows

AS_OF = datetime(2024, 6, 1, 12)
FIRST = datetime(2024, 1, 1, 8)


@pytest.fixture
def root(spark, tmp_path):
    """Four leads a day for ten days, one lead without a date, and their history."""
    leads = [
        (n, f"o{n}", f"p{n % 3}", f"T{n}", 1, FIRST + timedelta(days=n // 4) if n < 40 else None)
        for n in range(41)
    ]
    columns = "acq_id long, order_id string, partner_id string, transaction_id string, id_status int, order_dt timestamp"
    frame = spark.createDataFrame(leads, columns)
    where = str(tmp_path / "store")
    write_version(frame, f"{where}/leads", "leads")
    requests = frame.withColumn("response_code", F.lit("00"))
    write_version(requests, f"{where}/lead_requests", "lead_requests")
    history = frame.select(
        "order_id", "partner_id", "transaction_id", "id_status", F.lit(1).alias("sequence"),
        F.coalesce("order_dt", F.lit(FIRST).cast("timestamp")).alias("status_dt"),
    )
    write_version(history, f"{where}/status_log", "status_log")
    return where


def data_files(path):
    """Data files below a table with their times, by day folder."""
    found = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".parquet"):
                day = os.path.relpath(folder, path)
                found.setdefault(day, set()).add((name, os.stat(os.path.join(folder, name)).st_mtime_ns))
    return found


def change_rows(spark, *ids):
    return spark.createDataFrame(
        [(k, t, "user") for k, t in enumerate(ids)],
        "change_seq long, transaction_id string, id_name string",
    )


def test_transition_rewrites_only_its_days(spark, root):
    before = data_files(f"{root}/leads")
    wanted = change_rows(spark, "t1", "T2 ", "T40", "none", None)
    days = changes.transition(spark, root, wanted, AS_OF)
    assert set(days["leads"]) == {FIRST.date(), None}
    after = data_files(f"{root}/leads")
    assert {d for d in before if after[d] != before[d]} == {stored_day(d) for d in days["leads"]}
    found = mapping(read_table(spark, f"{root}/leads", "leads"), "transaction_id", "id_status")
    assert len(found) == 41 and {t for t, s in found.items() if s == 10} == {"T1", "T2", "T40"}
    log = read_table(spark, f"{root}/status_log", "status_log").where("id_status = 10")
    assert rows(log, "order_id", "sequence") == [("o1", 2), ("o2", 2), ("o40", 2)]
    # No change of a known lead: nothing is rewritten.
    assert changes.transition(spark, root, change_rows(spark, "none"), AS_OF) == {"leads": []}
    assert data_files(f"{root}/leads") == after


def test_rollback_removes_emptied_days(spark, root, codes):
    failed = spark.createDataFrame(
        [(f"p{n % 3}", f"O{n}", f"t{n}") for n in (4, 5, 6, 7, 9)] + [("p0", "o20", "other"), (None, "o1", "T1")],
        "partner_id string, order_id string, transaction_id string",
    )
    before = data_files(f"{root}/leads")
    days = changes.rollback(spark, root, failed, codes, AS_OF)
    second, third = FIRST.date() + timedelta(days=1), FIRST.date() + timedelta(days=2)
    assert set(days["leads"]) == set(days["status_log"]) == {second, third}
    after = data_files(f"{root}/leads")
    assert set(before) - set(after) == {stored_day(second)}
    assert {d for d in after if after[d] != before[d]} == {stored_day(third)}
    gone = {f"T{n}" for n in (4, 5, 6, 7, 9)}
    left = {r[0] for r in read_table(spark, f"{root}/leads", "leads").select("transaction_id").collect()}
    assert left == {f"T{n}" for n in range(41)} - gone
    stored = read_table(spark, f"{root}/lead_requests", "lead_requests")
    assert stored.count() == 41
    assert rows(stored.where("response_code = '30'"), "order_id", "transaction_id") == [
        (f"o{n}", None) for n in (4, 5, 6, 7, 9)
    ]
    log = read_table(spark, f"{root}/status_log", "status_log")
    assert log.count() == 36
    assert changes.rollback(spark, root, failed, codes, AS_OF)["leads"] == []


def test_rollback_that_breaks_off_is_finished(spark, root, codes, monkeypatch):
    """All tables are staged before the first is replaced; the next change finishes the rest."""
    failed = spark.createDataFrame(
        [("p1", "o4", "T4")], "partner_id string, order_id string, transaction_id string"
    )
    real, calls = updates.apply, []

    def breaks(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(*args)

    monkeypatch.setattr(updates, "apply", breaks)
    with pytest.raises(RuntimeError, match="lost"):
        changes.rollback(spark, root, failed, codes, AS_OF)
    monkeypatch.undo()
    changes.recover(spark, root)
    for name in ("leads", "status_log"):
        assert read_table(spark, f"{root}/{name}", name).where("transaction_id = 'T4'").count() == 0
    stored = read_table(spark, f"{root}/lead_requests", "lead_requests")
    assert rows(stored.where("order_id = 'o4'"), "response_code", "transaction_id") == [("30", None)]


def test_half_staged_update_is_dropped(spark, root):
    path = f"{root}/leads"
    part = updates.of_days(read_days(spark, path, "leads"), [FIRST.date()]).drop("day")
    folder = updates.stage(part.where("acq_id = 0"), path, "leads", [FIRST.date()])
    files.remove(spark, f"{folder}/_READY")
    assert updates.recover(spark, path, "leads") == 0
    assert read_table(spark, path, "leads").count() == 41
    moved = part.withColumn("order_dt", F.col("order_dt") + F.expr("interval 3 days"))
    with pytest.raises(ValueError, match="other days"):
        updates.stage(moved, path, "leads", [FIRST.date()])
    assert files.children(spark, f"{path}/_staged") == []
    with pytest.raises(ValueError, match="not kept by day"):
        updates.update_days(spark, path, "users", part, ("order_id",), lambda r: r)


def test_update_days_changes_rows_in_place(spark, root):
    path = f"{root}/lead_requests"
    changed = spark.createDataFrame([("O12", "P0")], "order_id string, partner_id string")
    days = updates.update_days(
        spark, path, "lead_requests", changed, ("order_id", "partner_id"),
        lambda r: r.withColumn("message", F.lit("seen")),
    )
    assert days == [FIRST.date() + timedelta(days=3)]
    found = read_table(spark, path, "lead_requests")
    assert found.count() == 41 and found.where("message = 'seen'").count() == 4
    assert store.conform(found, "lead_requests").columns == found.columns


def test_staged_files_are_moved_also_by_a_second_run(spark, root, monkeypatch):
    path = f"{root}/leads"
    days = [FIRST.date() + timedelta(days=n) for n in (0, 1)]
    part = updates.of_days(read_days(spark, path, "leads"), days).drop("day")
    folder = updates.stage(part.repartition(4).withColumn("agrmnt_no", F.lit("new")), path, "leads", days)
    written = {n.rsplit("-", 1)[-1] for d in data_files(f"{folder}/rows").values() for n, _ in d}
    times = sorted(t for d in data_files(f"{folder}/rows").values() for _, t in d)
    real, calls = files.move, []

    def breaks(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(*args)

    monkeypatch.setattr(files, "move", breaks)
    with pytest.raises(RuntimeError, match="lost"):
        updates.apply(spark, path, "leads", folder)
    monkeypatch.undo()
    assert updates.recover(spark, path, "leads") == 1
    found = read_table(spark, path, "leads")
    assert found.count() == 41 and found.where("agrmnt_no = 'new'").count() == 8
    after = data_files(path)
    moved = [f for d in days for f in after[stored_day(d)]]
    # The same files with their times: nothing was written again.
    assert sorted(t for _, t in moved) == times
    assert {n.rsplit("-", 1)[-1] for n, _ in moved} == written


def test_days_are_written_without_a_sort(spark, tmp_path):
    """Few days in a task are written side by side; beyond that the rest is sorted, and nothing is lost."""
    spark.sql(f"CREATE TABLE by_day (n BIGINT, day DATE) USING parquet PARTITIONED BY (day) LOCATION '{tmp_path}/by_day'")
    try:
        days = "SELECT id AS n, date_add(DATE'2024-01-01', CAST(id % 40 AS INT)) AS day FROM range(0, 400, 1, 1)"
        plan = spark.sql(f"EXPLAIN INSERT INTO by_day {days}").first()[0]
        assert "WriteFiles" in plan and "Sort" not in plan
        spark.sql(f"INSERT INTO by_day {days}")
        read = spark.table("by_day")
        assert read.count() == 400 and read.where("day = date_add(DATE'2024-01-01', CAST(n % 40 AS INT))").count() == 400
    finally:
        spark.sql("DROP TABLE by_day")
