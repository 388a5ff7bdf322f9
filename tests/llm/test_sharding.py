from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from leadloom.llm import sharding
from leadloom.llm.shared import table
from tests.conftest import SF
from tests.llm.cases import documents, empty, text


def frame(spark, texts):
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(texts)]
    return documents(spark, rows)


def checked(docs, n_shards=8):
    """The rows of a sharding whose law, slots, sizes and hashes are right, with their texts."""
    bodies = {}
    for r in docs.collect():
        bodies.setdefault(r["doc_id"], text(r["text"]))
    found = sharding.shards(docs, n_shards).collect()
    n = len(found)
    assert n == docs.count()
    assert {r["law"] for r in found} <= {"rows"} and all(r["grown_shard"] is None for r in found)
    by = {t: sorted(r["slot"] for r in found if r["shard"] == t) for t in range(n_shards)}
    assert sum(map(len, by.values())) == n
    assert all(s == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    for r in found:
        body = bodies[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(body) + 1, zlib.crc32(body))
    groups = {}
    for r in found:
        groups.setdefault(bodies[r["doc_id"]], []).append(r["shard"])
    return found, groups


def test_edges(spark):
    checked(documents(spark))
    assert sharding.shards(empty(spark)).count() == 0
    found, _ = checked(frame(spark, ["a", "a", "b"]))
    assert len({r["shard"] for r in found}) == 3


def test_hot_group_fills_shards_one_after_the_other(spark):
    """A third of all rows are copies: they fill two shards and most of a third one."""
    texts = ["hot"] * 1200 + [f"pair {i // 2}" for i in range(400)] + [f"own {i}" for i in range(2000)]
    _, groups = checked(frame(spark, texts))
    held = sorted((groups["hot"].count(t) for t in range(8)), reverse=True)
    # A shard holds 450 documents, some of which are pairs.
    assert held[0] >= 380 and sum(held[:3]) >= 1130
    whole = sum(len(set(s)) == 1 for b, s in groups.items() if b.startswith("pair"))
    assert whole >= 190


@pytest.mark.parametrize("copies", [2, 9])
def test_without_any_single_document(spark, copies):
    """No document is free to fill gaps, yet most copies come together."""
    texts = [f"text {i // copies}" for i in range(1440)]
    _, groups = checked(frame(spark, texts))
    together = sum(max(s.count(t) for t in set(s)) for s in groups.values())
    assert together >= 0.85 * len(texts)


def test_one_text_only(spark):
    checked(frame(spark, ["same"] * 801))


def test_links_between_several_groups(spark):
    """A node may belong to several groups: chains of eight nodes are cut less than half as often as at random."""
    nodes = spark.range(800).select(
        F.col("id").alias("node"),
        F.lit(1).cast("long").alias("weight"),
        F.when(F.col("id") % 8 == 0, F.array(F.col("id")))
        .when(F.col("id") % 8 == 7, F.array(F.col("id") - 1))
        .otherwise(F.array(F.col("id") - 1, F.col("id")))
        .alias("groups"),
    )
    placed, loads = sharding.propagate(nodes, [110] * 8)
    home = {r["node"]: r["shard"] for r in placed.collect()}
    assert max(loads) <= 110 and sum(loads) == len(home)
    links = [(i, i + 1) for i in range(800) if i % 8 != 7]
    cut = sum(home.get(a) != home.get(b) for a, b in links)
    # A random placement cuts seven of eight.
    assert cut < 0.5 * len(links), cut


def test_whole_table_without_python(spark):
    docs = table(spark, SF, "documents")
    _, groups = checked(docs)
    assert all(len(set(s)) == 1 for s in groups.values())
    plan = sharding.shards(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
