from __future__ import annotations

import numpy as np
import xxhash

from leadloom.llm import simhash
from leadloom.llm.components import components
from leadloom.llm.shared import table
from tests.conftest import SF
from tests.llm.cases import documents, empty


def plain(text):
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    shingles = [b" ".join(parts[i : i + 3]) for i in range(max(1, len(parts) - 2))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def groups(prints, bits=3):
    """For each position the set of positions reachable, by comparing all pairs."""
    prints = np.array(prints, dtype=np.uint64)
    label = np.arange(len(prints))
    near = [np.flatnonzero(np.bitwise_count(prints ^ p) <= bits) for p in prints]
    changed = True
    while changed:
        before = label.copy()
        for k, n in enumerate(near):
            label[n] = np.minimum(label[n], label[n].min())
            label[k] = label[n].min()
        changed = (before != label).any()
    return label


def check(rows, found):
    prints = [int(r["fingerprint"], 16) for r in found]
    label = groups(prints)
    least = {}
    for r, g in zip(found, label, strict=True):
        if r["doc_id"] is not None:
            least[g] = min(least.get(g, r["doc_id"]), r["doc_id"])
    assert [r["component_id"] for r in found] == [least.get(g) for g in label]


def test_whole_table(spark):
    docs = table(spark, SF, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(texts)
    for r in found[:60]:
        assert int(r["fingerprint"], 16) == plain(texts[r["doc_id"]])
    check(texts, found)


def test_edges(spark):
    found = simhash.near_duplicates(documents(spark)).collect()
    assert len(found) == 12
    by = {r["doc_id"]: r for r in found}
    assert by[3]["fingerprint"] == by[4]["fingerprint"] == by[5]["fingerprint"] == "0" * 16
    assert by[5]["component_id"] == 3 and by[2]["component_id"] == by[10]["component_id"] == 1
    check(None, found)
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_crowded_lists_lose_no_link(spark):
    random = np.random.default_rng(5)
    base = random.integers(0, 1 << 63, 4, dtype=np.uint64)
    prints = set()
    for b in base:
        for _ in range(120):
            flips = random.choice(64, random.integers(0, 5), replace=False)
            prints.add(int(b) ^ sum(1 << int(f) for f in flips))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(s,) for s in signed], "fp long").repartition(3)
    label = groups(prints)
    want = {}
    for s, g in zip(signed, label, strict=True):
        want.setdefault(g, set()).add(s)
    want = {frozenset(g) for g in want.values() if len(g) > 1}
    for most in (256, 3):
        linked = simhash.links(frame, most_listed=most)
        found = {}
        for r in components(linked).collect():
            found.setdefault(r["component"], set()).add(r["node"])
        assert {frozenset(g) for g in found.values()} == want


def test_components_of_long_chains(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000 + i, 1000) for i in range(1, 300)]
    found = components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r["component"] for r in found} == {0, 1000} and len(found) == 201 + 300
