from __future__ import annotations

import pickle

import numpy as np
import pytest

from leadloom.llm import toxicity
from leadloom.llm.shared import table
from tests.conftest import SF
from tests.llm.cases import documents, empty


@pytest.mark.parametrize("common", [1, 12, 1000])
def test_index_is_exact(monkeypatch, common):
    random = np.random.default_rng(2)
    vectors = []
    for _ in range(700):
        ids = random.choice(40, random.integers(0, 6), replace=False)
        w = random.random(len(ids)) + 0.1
        vectors.append(dict(zip(ids.tolist(), (w / np.sqrt((w * w).sum())).tolist(), strict=True)) if len(ids) else {})
    vectors += vectors[:50]
    # From all terms common to none.
    monkeypatch.setattr(toxicity, "COMMON", common)
    monkeypatch.setattr(toxicity, "_FIRST_BLOCKS", 2)
    index = toxicity.Index(vectors, 40, block=16)
    dense = np.zeros((len(vectors), 40))
    for k, v in enumerate(vectors):
        dense[k, list(v)] = list(v.values())
    for k in range(0, len(vectors), 7):
        for leave in (-1, k):
            texts, values = index.nearest(vectors[k], 9, leave=leave)
            score = dense @ dense[k]
            if leave >= 0:
                score[leave] = 0
            want = [t for t in np.lexsort((np.arange(len(score)), -score.round(12))) if score[t] > 0][:9]
            assert texts.tolist() == want
            assert np.allclose(values, np.minimum(score[want], 1))


def test_index_survives_sending():
    random = np.random.default_rng(5)
    vectors = [{int(t): float(random.random()) for t in random.choice(30, 4, replace=False)} for _ in range(200)]
    for index in (toxicity.Index(vectors, 30, block=16), toxicity.Index([], 3)):
        sent = pickle.loads(pickle.dumps(index))
        index._open()
        sent._open()
        for name, value in vars(index).items():
            assert np.array_equal(getattr(sent, name), value), name


def test_held_out(spark):
    docs, labels = table(spark, SF.replace("0.001", "0.01"), "documents"), table(spark, SF.replace("0.001", "0.01"), "labels")
    found = toxicity.score(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["toxic"] for r in found)
    assert right >= 0.95 * len(found)
    assert sum(r["predicted"] for r in found if r["toxic"]) >= 5
    assert any(len(r["neighbours"]) for r in found)


def test_edges(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, None), (2, 1), (None, 1), (6, 0), (6, 0)], "doc_id long, toxic int")
    found = toxicity.score(docs, labels).collect()
    assert len(found) == 12 and all(0 <= r["score"] <= 1 for r in found)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.score(docs, none).collect()} == {0.5}
    assert toxicity.score(empty(spark), labels).count() == 0


def test_every_term_of_the_labelled_texts_counts(spark):
    rows = [(k, f"common words here topic{k // 2} only{k}", "en", "a", 1) for k in range(12)]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(k, int(k == 0)) for k in range(0, 12, 2)], "doc_id long, toxic int")
    fitted = toxicity.fit(docs, labels)
    # One toxic text: no term differs by more than chance, and still its twin finds it first.
    assert {f"topic{k}" for k in range(6)} <= set(fitted.numbers.value)
    found = {r["doc_id"]: r for r in toxicity.predict(docs, fitted).collect()}
    assert all(found[k + 1]["neighbours"][0] == k for k in range(0, 12, 2))
    assert found[1]["score"] > max(found[k]["score"] for k in range(3, 12, 2))


def test_words_of_ascii_and_other_texts():
    random = np.random.default_rng(4)
    every = [chr(c) for c in (*range(128), 0xAA, 0xE9, 0x130, 0x3B1, 0x660, 0x2028, 0x1F600)]
    for n in (0, 1, 300):
        for most in (128, len(every)):
            text = "".join(every[k] for k in random.integers(0, most, n))
            assert toxicity.words(text) == toxicity._WORD.findall(text.lower())
    assert toxicity.words(None) == []


def test_frequencies_count_each_text_once(spark):
    texts = ["b b a", "A-b", None, "", "é b", "zz"]
    docs = documents(spark, [(k, t, "en", "a", 1) for k, t in enumerate(texts)])
    numbers = spark.sparkContext.broadcast({"b": 0, "a": 1, "é": 2, "none": 3})
    seen, n = toxicity._frequencies(docs, numbers, 4)
    assert seen.tolist() == [3, 2, 1, 0] and n == 6
