from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from leadloom.schemas import schema
from leadloom.sources import files
from leadloom.sources.batches import BatchStore
from tests.conftest import rows

USERS, STATUSES = "users", "status_master"


class Lost(Exception):
    pass


@pytest.fixture
def batches(spark, tmp_path):
    return BatchStore(spark, str(tmp_path / "store"))


def outputs(spark, number):
    names = [(f"user{number}", "pw", 0, 0, None)]
    return {
        USERS: spark.createDataFrame(names, schema(USERS)),
        STATUSES: spark.createDataFrame([(number, "s"), (number, "t")], schema(STATUSES)),
    }


def clock():
    """A time that goes on by a minute each time it is asked for."""
    at = [datetime(2024, 6, 1)]

    def now():
        at[0] += timedelta(minutes=1)
        return at[0]

    return now


def seen(batches):
    return rows(batches.read(USERS), "username"), rows(batches.read(STATUSES), "id_status")


def messages(batches):
    found = batches.job_log().orderBy("date_processed").collect()
    return [r["err_message"] for r in found]


def test_committed_batches_are_seen_once(spark, batches):
    now = clock()
    assert seen(batches) == ([], []) and messages(batches) == []
    assert batches.run("1", "job", lambda: outputs(spark, 1), now)
    assert not batches.run("1", "job", lambda: outputs(spark, 7), now)
    assert batches.run("2", "job", lambda: outputs(spark, 2), now)
    assert seen(batches) == ([("user1",), ("user2",)], [(1,), (1,), (2,), (2,)])
    assert messages(batches) == ["START", "END"] * 2
    with pytest.raises(ValueError, match="committed"):
        batches.give_up("1")
    with pytest.raises(ValueError, match="batch id"):
        batches.run("../3", "job", lambda: outputs(spark, 3), now)


@pytest.mark.parametrize("failing", [0, 1, 2, 3])
def test_fault_between_any_two_writes(spark, batches, monkeypatch, failing):
    """Fails before the first table, between the two, before the commit, and in making the rows."""
    now = clock()
    batches.run("1", "job", lambda: outputs(spark, 1), now)
    real, calls = BatchStore.write, []

    def breaks(self, batch_id, table, frame):
        if len(calls) == failing:
            raise Lost("disk")
        calls.append(table)
        real(self, batch_id, table, frame)

    def make():
        if failing == 3:
            raise Lost("disk")
        return outputs(spark, 2)

    with monkeypatch.context() as patch:
        patch.setattr(BatchStore, "write", breaks)
        if failing == 2:
            patch.setattr(files, "mark", lambda *_: (_ for _ in ()).throw(Lost("disk")))
        with pytest.raises(Lost):
            batches.run("2", "job", make, now)
    assert seen(batches) == ([("user1",)], [(1,), (1,)])
    assert files.children(spark, f"{batches.root}/{USERS}") == ["batch=1"]
    assert messages(batches) == ["START", "END", "START", "ERROR : disk"]
    assert batches.run("2", "job", lambda: outputs(spark, 2), now)
    assert seen(batches) == ([("user1",), ("user2",)], [(1,), (1,), (2,), (2,)])


def test_run_that_was_cut_off(spark, batches):
    """Rows without a commit are not seen; recovery removes them and keeps the others."""
    now = clock()
    batches.run("1", "job", lambda: outputs(spark, 1), now)
    batches.write("2", USERS, outputs(spark, 2)[USERS])
    assert seen(batches)[0] == [("user1",)]
    assert batches.recover() == ["2"] and batches.recover() == []
    assert files.children(spark, f"{batches.root}/{USERS}") == ["batch=1"]
    assert batches.run("2", "job", lambda: outputs(spark, 2), now)
    assert seen(batches)[0] == [("user1",), ("user2",)]
