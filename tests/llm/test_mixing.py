from __future__ import annotations

import re

import pytest

from leadloom.llm import mixing
from leadloom.llm.shared import table
from tests.conftest import SF
from tests.llm.cases import documents, empty


def check(found, most=2):
    by = {}
    for r in found:
        assert 0 <= r["taken"] <= most * r["size"]
        own = by.setdefault(r["source"], [0, 0, r["source_size"], r["target"]])
        own[0] += r["size"]
        own[1] += r["taken"]
    for size, taken, source_size, target in by.values():
        assert size == source_size and abs(taken - target) <= 1
    return by


def test_targets():
    assert mixing.fill([("b", 100), ("a", 100), (None, 100)]) == {"a": 200.0, "b": 250 / 3, None: 500 / 3}
    assert mixing.fill([("a", 0), ("b", 10)]) == {"a": 0.0, "b": 15.0}
    assert mixing.fill([]) == {}


def test_whole_table(spark):
    docs = table(spark, SF, "documents")
    found = mixing.contributions(docs).collect()
    sizes = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in docs.collect()}
    assert {r["doc_id"]: r["size"] for r in found} == sizes
    by = check(found)
    assert abs(sum(v[1] for v in by.values()) - 1.5 * sum(sizes.values())) <= len(by)
    again = mixing.contributions(docs.repartition(7)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in again) == sorted((r["doc_id"], r["taken"]) for r in found)


@pytest.mark.parametrize("block", [16, 256])
def test_pieces(spark, block):
    rows, goal, pieces = mixing.mix(documents(spark), block=block)
    size = {r["uid"]: r["size"] for r in rows.collect()}
    held = {}
    for r in pieces.collect():
        assert r["at"] >= 0 and r["words"] > 0 and r["at"] + r["words"] <= size[r["uid"]]
        own = held.setdefault((r["uid"], r["pass"]), set())
        words = set(range(r["at"], r["at"] + r["words"]))
        assert not own & words
        own |= words
    slots = pieces.groupBy("slot").sum("words").collect()
    assert all(r[1] <= block for r in slots)
    check(mixing.contributions(documents(spark), block=block).collect())


def test_slots_are_spread(spark):
    goal = spark.createDataFrame(
        [("a", 0, 64_000.0, 0.0, 0.25), ("b", 0, 192_000.0, 0.25, 1.0)],
        "part string, source_size long, target double, low double, high double",
    )
    found = sorted((r["slot"], r["part"]) for r in mixing.schedule(goal, 64).collect())
    assert len(found) == 4000
    for start in range(0, 3900, 100):
        share = sum(p == "a" for _, p in found[start : start + 100])
        assert 20 <= share <= 30


def test_edges(spark):
    found = mixing.contributions(documents(spark)).collect()
    assert len(found) == 12
    check(found)
    assert mixing.contributions(empty(spark)).count() == 0
