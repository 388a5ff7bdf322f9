from __future__ import annotations

import hashlib

import pandas as pd
import pytest
from pyspark.sql import functions as F

from leadloom.llm import fingerprint
from leadloom.llm.shared import table
from tests.conftest import SF
from tests.llm.cases import documents, empty, text


def expected(rows):
    """(n_chars, sha of the edited text) per (id, text), by brute force."""
    ordered = sorted(((r[0], text(r[1])) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    out = {}
    for k, (doc, own) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        half = len(own) // 2
        edited = own[: len(own) - half] + following[:half]
        out.setdefault((doc, len(own)), []).append(
            (hashlib.sha256(edited.encode()).hexdigest(), edited, own, following)
        )
    return out


@pytest.mark.parametrize("per_range", [3, 2000])
def test_edges(spark, per_range):
    docs = documents(spark)
    found = fingerprint.edited_neighbours(docs, per_range=per_range).collect()
    want = expected([tuple(r)[:2] for r in docs.collect()])
    assert len(found) == 12
    for r in found:
        assert r["edited_sha256"] in {w[0] for w in want[(r["doc_id"], r["n_chars"])]}
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    by = {}
    for r in found:
        by.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert by[1] == by[2] and by[3] == by[4] and by[1] != by[10] and len(by[8]) == 1
    assert fingerprint.edited_neighbours(empty(spark)).count() == 0


def test_whole_table(spark):
    docs = table(spark, SF, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = expected(rows)
    found = fingerprint.edited_neighbours(docs, per_range=30).toPandas()
    assert len(found) == len(rows)
    prints = {}
    for r in found.itertuples():
        sha, edited, own, following = want[(r.doc_id, r.n_chars)][0]
        assert r.edited_sha256 == sha
        assert prints.setdefault(own, r.fingerprint) == r.fingerprint
        assert prints.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint
        if own == following:
            assert r.near_next == 1
    assert len(set(prints.values())) == len(prints)
    assert found.near_edited.mean() > 0.35 and found.near_next.mean() < 0.1


def test_homomorphic(spark):
    texts = ["b\na\nc. d", "c. d\na\nb", "a\nb", "c. d", "a"]
    frame = spark.createDataFrame(pd.DataFrame({"doc_id": range(5), "text": texts}))
    prints = {r[0]: r[1] for r in fingerprint.fingerprint_table(frame).collect()}
    assert prints[0] == prints[1] != prints[2]
    row = spark.range(1).select(
        fingerprint.combine(F.lit(prints[2]), F.lit(prints[3])).alias("both"),
        fingerprint.combine(F.lit(prints[0]), F.lit(prints[3]), -1).alias("less"),
    ).first()
    assert row["both"] == prints[0] and row["less"] == prints[2]
    assert "Python" not in fingerprint.edited_neighbours(frame)._jdf.queryExecution().toString()


def test_many_units_do_not_overflow(spark):
    """Ten million paragraphs; the sum over parts equals the fingerprint of the whole."""

    def fingerprint_of(n):
        rows = spark.range(n).select(
            F.lit(1).alias("key"), F.lit("").alias("paragraph"), F.lit("").alias("sentence")
        )
        return fingerprint._summed(rows, ["key"]).select(fingerprint.encode()).first()[0]

    parts = fingerprint_of(9_000_000), fingerprint_of(1_000_000)
    row = spark.range(1).select(
        fingerprint.combine(F.lit(parts[0]), F.lit(parts[1])).alias("both"),
    ).first()
    assert row["both"] == fingerprint_of(10_000_000)
    assert len(row["both"]) == len(parts[0])
