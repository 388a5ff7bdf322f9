from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checks import inputs
from checks.queries import BRANCH, SEGMENT, WHOLE
from leadloom.operators import latest, reports
from leadloom.sources import files
from leadloom.sources.latest import LatestStatus
from tests.conftest import SF, rows

COLUMNS = "order_id string, transaction_id string, partner_id string, status_dt timestamp, id_status int"
NOON = datetime(2024, 5, 1, 12)


def history(seed, n):
    """Random rows with ties, a hot key, keys of different case, and missing parts."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        k = "hot" if rng.random() < 0.3 else rng.choice("abcdefgh")
        order = rng.choice([k, k.upper(), k + "  ", None]) if rng.random() < 0.3 else k
        day = NOON + timedelta(days=rng.randrange(6)) if rng.random() < 0.95 else None
        out.append((order, "t", rng.choice(["p", "P", "q"]), day, rng.choice([1, 2, 3, 99, None])))
    return out


def plain(batch):
    """Key -> (latest date, sorted statuses on it)."""
    newest = {}
    for order, transaction, partner, at, status in batch:
        if order is None or at is None:
            continue
        found = newest.setdefault((order.rstrip(" ").lower(), transaction, partner.lower()), [at, []])
        if at > found[0]:
            found[:] = [at, []]
        if at == found[0]:
            found[1].append(status)
    return {k: (at, sorted(s, key=repr)) for k, (at, s) in newest.items()}


def kept(df):
    """The same of compacted rows, which name a key once per batch."""
    out = {}
    for r in df.collect():
        found = out.setdefault((r[0], r[1], r[2]), [r["status_dt"], []])
        if r["status_dt"] > found[0]:
            found[:] = [r["status_dt"], []]
        if r["status_dt"] == found[0]:
            found[1] += [r["id_status"]] * r["n"]
    return {k: (at, sorted(s, key=repr)) for k, (at, s) in out.items()}


@pytest.fixture
def table(spark, tmp_path):
    return LatestStatus(spark, str(tmp_path / "latest"))


def test_counts(spark):
    batch = history(1, 400)
    found = latest.latest_counts(spark.createDataFrame(batch, COLUMNS), [1, 2, 3])
    got = {tuple(r)[:3]: (r["status_dt"], list(r["counts"])) for r in found.collect()}
    want = {k: (at, [s.count(i) for i in (1, 2, 3)]) for k, (at, s) in plain(batch).items()}
    assert got == want
    compact = latest.latest_rows(spark.createDataFrame(batch, COLUMNS))
    assert kept(compact) == plain(batch) and compact.count() < 100
    # A compacted history in place of the rows it was made from, alone and with newer rows.
    again = latest.latest_counts(compact, [1, 2, 3])
    assert rows(again) == rows(found)


def test_maintained_table_equals_a_recomputation(spark, table):
    """Ten batches in random order of time: ties over batches, late rows, repeated batches, merges."""
    everything = []
    assert kept(table.read()) == {}
    for number in range(10):
        batch = history(100 + number, 60)
        everything += batch
        frame = spark.createDataFrame(batch, COLUMNS)
        table.add(f"b{number}", frame)
        table.add(f"b{number}", frame)
        if number in (3, 7):
            table.merge()
            table.add("b2", spark.createDataFrame(history(102, 60), COLUMNS))
        assert kept(table.read()) == plain(everything)
    assert table.batches() == {f"b{i}" for i in range(10)}
    counts = latest.latest_counts(table.read(), [1, 2, 3, 99])
    assert rows(counts) == rows(
        latest.latest_counts(spark.createDataFrame(everything, COLUMNS), [1, 2, 3, 99])
    )


def test_broken_writes(spark, table):
    """What a batch or a merge that broke off left is not read, and is replaced."""
    first, second = history(1, 50), history(2, 50)
    table.add("one", spark.createDataFrame(first, COLUMNS))
    broken = f"{table.path}/generation=0/batch=two"
    spark.createDataFrame(history(3, 50), COLUMNS).write.parquet(broken)
    files.remove(spark, f"{broken}/_SUCCESS")
    assert kept(table.read()) == plain(first) and table.batches() == {"one"}
    table.add("two", spark.createDataFrame(second, COLUMNS))
    assert kept(table.read()) == plain(first + second)
    files.mark(spark, f"{table.path}/generation=1/base/part-of-a-merge")
    assert kept(table.read()) == plain(first + second)
    table.merge()
    assert kept(table.read()) == plain(first + second)
    assert files.children(spark, table.path) == ["generation=1"]
    with pytest.raises(ValueError, match="batch id"):
        table.add("../x", spark.createDataFrame(second, COLUMNS))


@pytest.mark.parametrize("report", [WHOLE, SEGMENT, BRANCH], ids=["whole", "segment", "branch"])
def test_reports_shuffle_the_history_once(spark, report):
    """One scan of the history, and nothing but counts behind its first exchange."""
    names = ("leads", "status_log", "status_master", "offices")
    tables = [inputs.table(spark, SF, n) for n in names]
    found = reports.status_recap(*tables, report)._jdf.queryExecution().executedPlan().toString()
    assert found.count("sequence") == 0
    scans = [x for x in found.splitlines() if "FileScan" in x and "status_dt" in x]
    assert len(scans) == 1


def test_hot_key_is_compacted_before_the_shuffle(spark):
    """A key with a third of all rows leaves one row per task and date."""
    log = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("order_id"),
        F.lit("t").alias("transaction_id"),
        F.lit("p").alias("partner_id"),
        F.lit(1).alias("id_status"),
        F.timestamp_seconds(F.lit(86_400) + F.col("id") % 7).alias("status_dt"),
    )
    found = latest.latest_counts(log, [1]).where("order_key = 'hot'").first()
    assert found["counts"] == [sum(i % 7 == 6 for i in range(0, 60_000, 3))]
