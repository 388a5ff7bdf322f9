from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest

from leadloom.llm import periodic
from leadloom.llm.shared import table
from tests.conftest import SF
from tests.llm.cases import LONG, documents, empty, text

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words):
    """(start, length, period) of all runs, lag by lag."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted((b, e - b, q) for (b, e), q in found.items())


def plain_row(doc, body):
    words = WORD.findall(text(body))
    n = len(words)
    if doc is not None and n and zlib.crc32(str(doc).encode()) % 10 == 0:
        g = zlib.crc32(str(doc).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    return (
        doc, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
    )


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_random_texts(seed):
    rng = random.Random(seed)
    for _ in range(80):
        texts = []
        for _ in range(rng.randint(1, 6)):
            n, k = rng.choice([0, 1, 5, 7, 30, 100, 400, 900]), rng.choice([1, 2, 3, 30, 1000])
            words = [str(rng.randrange(k)) for _ in range(n)]
            for _ in range(rng.randint(0, 3) if n > 10 else 0):
                a = rng.randrange(n)
                m = rng.randint(1, max(1, (n - a) // rng.choice([3, 4, 5, 9])))
                for i in range(a, a + rng.randint(1, n - a)):
                    words[i] = words[a + (i - a) % m]
            texts.append(" ".join(words))
        frame = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
        found = periodic._of_batch(frame, None, periodic.LEAST_LENGTH)
        for body, runs in zip(texts, found["runs"], strict=True):
            assert [(r["start"], r["length"], r["period"]) for r in runs] == plain_runs(body.split())


def test_long_periods():
    """One text with periods over many scales, and one word 200,000 times."""
    rng = random.Random(5)
    words, want = [], []
    for q in (1, 2, 7, 8, 9, 15, 16, 17, 31, 64, 100, 1000, 4097):
        unit = [f"q{q}w{i}" for i in range(q)]
        begin, length = len(words), max(6, 4 * q) + rng.randrange(q)
        words += [unit[i % q] for i in range(length)]
        want.append((begin, length, q))
        words += [f"gap{q}"]
    flat = np.concatenate([pd.factorize(np.array(words))[0], [-1]])
    found = periodic.runs_in(flat, np.array([len(words)]))
    assert [(b, e - b, q) for b, e, q in found.tolist()] == want
    one = np.concatenate([np.zeros(200_000, np.int64), [1]])
    assert periodic.runs_in(one, np.array([200_000])).tolist() == [[0, 200_000, 1]]


def test_edges(spark):
    body = "a b c " * 4 + "x " + "y " * 5 + "z z z z z z"
    rows = [
        (41, body, "en", "a", 1), (41, body, "en", "a", 1), (None, body, None, None, None),
        (42, None, None, None, None), (43, "", "en", "b", 0), (44, "  \n", "en", "b", 3),
        (45, "a a a a a", "en", "b", 9), (46, "é\x1cé " * 8, "fr", "b", 9),
        (47, LONG, "en", "a", len(LONG)),
    ]
    docs = documents(spark, rows)
    plain = periodic.find_runs(docs)
    by = {r["doc_id"]: r for r in plain.collect()}
    assert plain.count() == len(rows)
    assert [tuple(r) for r in by[None]["runs"]] == [(0, 12, 3), (18, 6, 1)]
    assert by[None]["collapsed"] == "a b c x y y y y y z" and by[42]["collapsed"] == ""
    assert by[45]["runs"] == [] and [tuple(r) for r in by[46]["runs"]] == [(0, 8, 1)]
    assert by[47]["n_words"] == 60_000 and len(by[47]["runs"]) == 1
    short = [r for r in rows if r[0] != 47]
    found = periodic.report(documents(spark, short))
    assert ordered(found.collect()) == ordered(plain_row(r[0], r[1]) for r in short)
    assert periodic.report(empty(spark)).count() == 0


def test_whole_table(spark):
    docs = table(spark, SF, "documents")
    rows = [r for r in docs.select("doc_id", "text").collect() if len(text(r[1])) < 20_000]
    found = {r["doc_id"]: tuple(r) for r in periodic.report(docs).collect()}
    assert len(found) == docs.count() and sum(r[1] for r in found.values()) > 0
    for doc, body in rows:
        assert found[doc] == plain_row(doc, body)
