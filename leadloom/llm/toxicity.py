"""Toxicity from the nearest labelled texts by exact TF-IDF cosine.

Terms are all words of the labelled texts. Texts are weighted by TF-IDF over them, with document
frequencies counted over all documents; a term whose presence differs between toxic and clean labelled
texts weighs more, by the square of the damped (logarithmic) likelihood ratio.

The labelled texts (a bounded sample) form a block-max inverted index: postings per term for most terms;
for common ones, blocks of texts with the weights of these terms side by side, and the largest weight of
each term in each block. The postings of a query's other terms give every text a lower bound, and with
the largest weights of its common terms every block has an upper bound. Queries are searched some at a
time: the blocks with the highest bounds are opened, which gives a first value for the k-th best
similarity of each query, then those that can reach it for any of them. The best are compared in full, so
the neighbours are exact. They vote with weights that fall with their distance; the vote is calibrated by
a logistic curve fitted to the leave-one-out votes of labelled texts.
No text or vector but those of the labelled sample is written.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm.shared import fold, pick, rows_of, small_batches, text_of
from leadloom.session import materialise

SAMPLE = 20_000
# So many of the labelled texts, spread by hash, calibrate the votes.
CALIBRATED = 4_000
NEIGHBOURS = 16
BLOCK = 64
# A term is common if one of so many texts has it: its weights then take at most so many numbers a posting.
COMMON = 8
# Similarities are first summed with less precision; the best are summed again.
_ROUNDING = 1e-5
_ENTRY = np.dtype([("number", np.int32), ("weight", np.float32)])
# So many texts are searched together, and so many blocks opened first for each.
QUERIES = 64
_FIRST_BLOCKS = 2
# A task remembers the scores of about so many texts.
_REMEMBERED = 20_000
_WORD = re.compile(r"\w+")
# The words of a text of ASCII only are what these leave between blanks.
_ASCII = {c: chr(c).lower() if chr(c).isalnum() or chr(c) == "_" else " " for c in range(128)}
_NONE = np.empty(0, dtype=np.int64)


def words(text: object) -> list[str]:
    """The words of the whole text in lower case, one after the other."""
    text = text_of(text)
    return text.translate(_ASCII).split() if text.isascii() else _WORD.findall(text.lower())


def terms(text: object) -> Counter:
    """The words of the whole text with counts."""
    return Counter(words(text))


Vector = tuple[np.ndarray, np.ndarray]


def _vector(found: Vector | dict[int, float]) -> Vector:
    """Term numbers and weights."""
    if not isinstance(found, dict):
        return found
    return np.fromiter(found, np.int64, len(found)), np.fromiter(found.values(), float, len(found))


def _stretches(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Several stretches of an array, one after the other."""
    pieces = [values[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
    return np.concatenate([values[:0], *pieces])


def _entries(numbers: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Numbers and weights side by side, one long value each (those are joined faster than records)."""
    both = np.empty(len(numbers), _ENTRY)
    both["number"], both["weight"] = numbers, weights
    return both.view(np.int64)


class Index:
    """Unit vectors of labelled texts as a block-max inverted index.

    Postings lie by term, then text; the same entries by text serve the full comparison.
    """

    def __init__(self, vectors: list[Vector] | list[dict[int, float]], n_terms: int, block: int = BLOCK):
        pairs = [_vector(v) for v in vectors]
        size = np.array([len(ids) for ids, _ in pairs], dtype=np.int64)
        term = np.concatenate([np.empty(0, np.int32), *[ids for ids, _ in pairs]])
        weight = np.concatenate([np.empty(0, np.float32), *[w for _, w in pairs]])
        self._post(size, term, weight, n_terms, block)

    @classmethod
    def of(cls, size: np.ndarray, term: np.ndarray, weight: np.ndarray, n_terms: int) -> Index:
        """From the numbers of terms by text and all terms and weights, text after text."""
        index = cls.__new__(cls)
        index._post(size, term, weight, n_terms, BLOCK)
        return index

    def _post(
        self, size: np.ndarray, term: np.ndarray, weight: np.ndarray, n_terms: int, block: int
    ) -> None:
        self.n, self.block, self.n_terms = len(size), block, n_terms
        order = np.argsort(term, kind="stable").astype(np.int32 if len(term) < 1 << 31 else np.int64)
        self.text = np.repeat(np.arange(self.n, dtype=np.int32), size)[order]
        self.weight = weight.astype(np.float32)[order]
        self.seen = np.bincount(term, minlength=n_terms)
        self.start = np.r_[0, np.cumsum(self.seen)]
        self.cells = None

    def _open(self) -> None:
        """What a search needs besides the postings; made where the first search runs."""
        # The weights of the query at hand by term; all zero between queries.
        self.query = np.zeros(self.n_terms)
        text, weight = self.text, self.weight
        term = np.repeat(np.arange(self.n_terms, dtype=np.int32), self.seen)
        order = np.argsort(text, kind="stable")
        self.own_start = np.r_[0, np.cumsum(np.bincount(text, minlength=self.n))]
        self.own = _entries(term[order], weight[order])
        self.posts = _entries(text, weight)
        # The weights of common terms: block, term, text within the block.
        blocks = max(1, -(-self.n // self.block))
        common = np.flatnonzero(self.seen >= max(1, self.n // COMMON))
        self.row = np.full(self.n_terms, -1, np.int32)
        self.row[common] = np.arange(len(common))
        mine = self.row[term] >= 0
        self.cells = np.zeros((blocks, len(common), self.block), np.float32)
        at = text[mine]
        self.cells[at // self.block, self.row[term[mine]], at % self.block] = weight[mine]
        self.block_most = np.ascontiguousarray(self.cells.max(axis=2).T)

    def __getstate__(self) -> dict:
        """Sent to tasks without what can be made again."""
        small = np.min_scalar_type(max(1, self.n))
        return {
            "n": self.n, "block": self.block, "n_terms": self.n_terms,
            "seen": self.seen.astype(small), "text": self.text.astype(small), "weight": self.weight,
        }

    def __setstate__(self, state: dict) -> None:
        self.n, self.block, self.n_terms = state["n"], state["block"], state["n_terms"]
        self.seen = state["seen"].astype(np.int64)
        self.start = np.r_[0, np.cumsum(self.seen)]
        self.text, self.weight, self.cells = state["text"].astype(np.int32), state["weight"], None

    def nearest(
        self, vector: Vector | dict[int, float], k: int, leave: int = -1
    ) -> tuple[np.ndarray, np.ndarray]:
        """The `k` most similar texts (without `leave`), ties by position; similarity above 0."""
        if leave >= 0:
            return without(self.nearest(vector, k + 1), leave, k)
        return next(self.search([_vector(vector)], k))

    def search(self, vectors: list[Vector], k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The `k` most similar texts of every vector, in blocks of queries."""
        if self.cells is None:
            self._open()
        for at in range(0, len(vectors), QUERIES):
            yield from self._batch(vectors[at : at + QUERIES], k)

    def _batch(self, vectors: list[Vector], k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        blocks, terms_, size = self.cells.shape
        # Sums over the terms seen so far; with the common terms once a block is opened.
        sums = np.zeros((len(vectors), blocks, size), np.float32)
        shares = np.zeros((len(vectors), terms_), np.float32)
        for q, (ids, weights) in enumerate(vectors):
            rows = self.row[ids]
            rare = rows < 0
            stretch = self.start[ids[rare]], self.start[ids[rare] + 1]
            products = np.repeat(weights[rare], self.seen[ids[rare]])
            held = _stretches(self.posts, *stretch).view(_ENTRY)
            products *= held["weight"]
            sums[q].ravel()[:] = np.bincount(held["number"], products, minlength=blocks * size)
            shares[q, rows[~rare]] = weights[~rare]
        best = sums.max(axis=2)
        high = best + shares @ self.block_most + 2 * _ROUNDING
        first = min(_FIRST_BLOCKS, blocks)
        opened = np.unique(np.argpartition(-high, first - 1, axis=1)[:, :first])
        closed = np.ones(blocks, dtype=bool)
        while len(opened):
            for b in opened:
                sums[:, b] += shares @ self.cells[b]
            closed[opened] = False
            best[:, opened] = sums[:, opened].max(axis=2)
            # The k-th best block maximum bounds the k-th best similarity.
            least = np.zeros(len(vectors), np.float32)
            if blocks >= k:
                least = np.partition(best, -k, axis=1)[:, -k]
            opened = np.flatnonzero(closed & (high >= least[:, None]).any(axis=0))
        for (ids, weights), reached, low in zip(vectors, sums.reshape(len(vectors), -1), least, strict=True):
            texts = np.flatnonzero(reached >= max(low - 2 * _ROUNDING, np.float32(1e-30)))
            if len(texts) > k:
                found = reached[texts]
                texts = texts[found >= np.partition(found, -k)[-k] - 2 * _ROUNDING]
            self.query[ids] = weights
            values = self._compared(texts)
            self.query[ids] = 0.0
            texts, values = texts[values > 0], values[values > 0]
            order = np.lexsort((texts, -values.round(12)))[:k]
            yield texts[order], np.minimum(values[order], 1.0)

    def _compared(self, texts: np.ndarray) -> np.ndarray:
        """Similarities of the query to some texts, over all terms."""
        stretch = self.own_start[texts], self.own_start[texts + 1]
        held = _stretches(self.own, *stretch).view(_ENTRY)
        products = self.query[held["number"]] * held["weight"]
        owner = np.repeat(np.arange(len(texts)), stretch[1] - stretch[0])
        return np.bincount(owner, products, minlength=len(texts))


def without(
    found: tuple[np.ndarray, np.ndarray], leave: int, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """The `k` nearest other texts, out of the `k` + 1 nearest of all."""
    others = found[0] != leave
    return found[0][others][:k], found[1][others][:k]


class Model(NamedTuple):
    """What was learned; `weighted` turns the counts of known terms into a unit vector.

    The model goes to the tasks once, as a broadcast variable whose size the sample bounds.
    """

    weight: np.ndarray
    index: Index | None
    toxic: np.ndarray
    ids: np.ndarray
    prior: float
    neighbours: int
    slope: float = 1.0
    shift: float = 0.0

    def weighted(self, ids: np.ndarray, counts: np.ndarray) -> Vector:
        weights = (1 + np.log(counts)) * self.weight[ids]
        return ids, weights / max(np.sqrt((weights * weights).sum()), 1e-300)

    def vote(self, texts: np.ndarray, similarity: np.ndarray) -> float:
        """Log odds of the distance-weighted votes, drawn to the prior by one weak vote."""
        weight = similarity / (1.05 - similarity)
        share = ((weight * self.toxic[texts]).sum() + 0.5 * self.prior) / (weight.sum() + 0.5)
        share = np.clip(share, 1e-4, 1 - 1e-4)
        return float(np.log(share / (1 - share)))

    def scores(self, counted: list[Vector]) -> Iterator[tuple[float, list, list]]:
        """Score, neighbours and similarities of texts given by numbers and counts of known terms."""
        if self.index is None:
            yield from [(self.prior, [], [])] * len(counted)
            return
        for texts, similarity in self.index.search([self.weighted(*c) for c in counted], self.neighbours):
            raw = self.slope * self.vote(texts, similarity) + self.shift
            yield float(1 / (1 + np.exp(-raw))), self.ids[texts].tolist(), similarity.tolist()


def _sampled(labels: DataFrame, most: int) -> DataFrame:
    n = labels.count()
    if n <= most:
        return labels
    share = int(most / n * (1 << 30))
    return labels.where(F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1 << 30)) < share)


def _term_counts(rows: DataFrame) -> DataFrame:
    """(term, n1, n0): toxic and clean labelled texts that have the term, summed per batch first."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in rows_of(frames):
            one, zero = Counter(), Counter()
            for text, toxic in zip(frame["text"], frame["toxic"], strict=True):
                (one if toxic else zero).update(terms(text).keys())
            names = list(one | zero)
            yield pd.DataFrame(
                {"term": names, "n1": [one[t] for t in names], "n0": [zero[t] for t in names]}
            )

    counted = rows.select("text", "toxic").mapInPandas(run, "term string, n1 long, n0 long")
    return counted.groupBy("term").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


class _Numbered:
    """A column of terms that reaches the tasks as the numbers of its terms."""

    def __init__(self, names: pa.ChunkedArray):
        self.names = names

    def __reduce__(self) -> tuple:
        return _numbers, (self.names,)


def _numbers(names: pa.ChunkedArray) -> dict[str, int]:
    return {t: k for k, t in enumerate(names.to_pylist())}


def _vocabulary(counts: DataFrame, total1: int, total0: int) -> tuple[pa.ChunkedArray, np.ndarray]:
    """All terms, the most common first, and the log-likelihood ratio of each."""
    if not total1 or not total0:
        return pa.chunked_array([[]], pa.string()), np.empty(0)
    cell = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    n = total1 + total0
    both = F.col("n1") + F.col("n0")
    m1, m0 = F.lit(total1) - F.col("n1"), F.lit(total0) - F.col("n0")
    ratio = 2 * (
        cell(F.col("n1"), both * total1 / n)
        + cell(F.col("n0"), both * total0 / n)
        + cell(m1, (n - both) * total1 / n)
        + cell(m0, (n - both) * total0 / n)
    )
    found = counts.select("term", both.alias("n"), ratio.alias("ratio")).toArrow()
    found = found.sort_by([("n", "descending"), ("term", "ascending")])
    return found.column("term"), np.maximum(found.column("ratio").to_numpy(), 0.0)


def known(text: object, numbers: dict[str, int]) -> Vector:
    """Numbers and counts of the known terms of a whole text, by ascending number."""
    found = terms(text)
    ids = np.fromiter(map(numbers.get, found, repeat(-1)), np.int64, len(found))
    counts = np.fromiter(found.values(), np.int64, len(found))
    order = np.argsort(ids)[np.count_nonzero(ids < 0) :]
    return ids[order], counts[order]


def _frequencies(docs: DataFrame, numbers: Broadcast, size: int) -> tuple[np.ndarray, int]:
    """In how many of all documents each term occurs, and the number of documents."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size + 1, dtype=np.int64)
        for frame in rows_of(frames):
            total[size] += len(frame)
            # Counted by word first: the numbers of a frame's words are looked up once each.
            found = Counter(chain.from_iterable(set(words(text)) for text in frame["text"]))
            ids = np.fromiter(map(numbers.value.get, found, repeat(-1)), np.int64, len(found))
            texts = np.fromiter(found.values(), np.int64, len(found))
            total[ids[ids >= 0]] += texts[ids >= 0]
        present = np.flatnonzero(total)
        yield pd.DataFrame({"k": present, "n": total[present]})

    sums = docs.select("text").mapInPandas(run, "k int, n long").groupBy("k").agg(F.sum("n").alias("n"))
    found = sums.toArrow()
    total = np.zeros(size + 1, dtype=np.int64)
    total[found.column("k").to_numpy()] = found.column("n").to_numpy()
    return total[:size], int(total[size])


def _vectors(rows: DataFrame, numbers: Broadcast, model: Model) -> pa.Table:
    """(doc_id, toxic, ids, weights) of labelled texts, numbers packed (big-endian ids sort well)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in rows_of(frames):
            pairs = [model.weighted(*known(t, numbers.value)) for t in frame["text"]]
            yield frame[["doc_id", "toxic"]].assign(
                ids=[ids.astype(">i4").tobytes() for ids, _ in pairs],
                weights=[w.astype("<f4").tobytes() for _, w in pairs],
            )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    found = rows.select("doc_id", "toxic", "text").mapInPandas(
        run, f"doc_id {id_type}, toxic int, ids binary, weights binary"
    )
    return found.toArrow()


def _unpacked(column: pa.ChunkedArray, packed: str, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """How many values each cell of packed numbers holds, and all of them."""
    pieces = [np.frombuffer(v.as_buffer(), packed) for part in column.chunks for v in part]
    size = np.array([len(p) for p in pieces], dtype=np.int64)
    return size, np.concatenate([np.empty(0, kind), *pieces]).astype(kind)


def _calibrated(votes: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve from votes to labels (a few Newton steps)."""
    target = np.where(toxic > 0, 1 - 1 / (toxic.sum() + 2), 1 / ((1 - toxic).sum() + 2))
    x = np.c_[votes, np.ones(len(votes))]
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-2, 1e-2])
        gradient = x.T @ (p - target) + np.array([1e-2, 1e-2]) * (w - np.array([1.0, 0.0]))
        step = np.linalg.solve(hessian, gradient)
        w = w - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return max(0.05, float(w[0])), float(w[1])


class Fitted(NamedTuple):
    """A model and the numbers of its terms, both held by the tasks, and the curve of its votes."""

    model: Broadcast
    numbers: Broadcast
    slope: float = 1.0
    shift: float = 0.0


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    neighbours: int = NEIGHBOURS,
    calibrated: int = CALIBRATED,
) -> Fitted:
    """Learn from rows (doc_id, toxic) and the texts (doc_id, text) they name.

    At most about `sample` labelled rows are used and `calibrated` of them calibrate the votes, spread
    by hash; what is gathered on the driver is bounded by that and by the length of these texts.
    Labels without id or value are left out; of repeated labels the greatest counts; repeated ids give
    a labelled text each. Where no labelled text has a term, or only one class is labelled, or a table
    has no rows, every score is the share of toxic labels (0.5 without any label).
    """
    context = docs.sparkSession.sparkContext
    small_batches(docs.sparkSession)
    marked = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    marked = marked.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = materialise(_sampled(marked, sample), "toxic-labels")
    # The sample is bounded, so it may be broadcast.
    rows = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")
    rows = materialise(rows, "toxic-sample")
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    total1 = sum(n for t, n in totals.items() if t)
    total0 = sum(n for t, n in totals.items() if not t)
    prior = total1 / (total1 + total0) if total1 + total0 else 0.5
    vocabulary, ratio = _vocabulary(_term_counts(rows), total1, total0)
    model = Model(np.empty(0), None, np.empty(0), np.empty(0), prior, neighbours)
    numbers, n_terms = context.broadcast(_Numbered(vocabulary)), len(vocabulary)
    if not n_terms:
        return Fitted(context.broadcast(model), numbers)
    del vocabulary
    seen, n = _frequencies(docs, numbers, n_terms)
    weight = (np.log((n + 1) / (seen + 1)) + 1.0) * (1.0 + np.log1p(ratio)) ** 2
    model = model._replace(weight=weight)
    found = _vectors(rows, numbers, model)
    # Similar texts side by side, so that bounds of blocks are tight; a fixed order.
    found = found.sort_by([(c, "ascending") for c in ("ids", "weights", "toxic", "doc_id")])
    size, term = _unpacked(found.column("ids"), ">i4", np.int32)
    _, share = _unpacked(found.column("weights"), "<f4", np.float32)
    model = model._replace(
        toxic=(found.column("toxic").to_numpy() > 0).astype(float),
        ids=found.column("doc_id").to_numpy(),
        index=Index.of(size, term, share, n_terms),
    )
    del found, term, share
    sent = context.broadcast(model)
    some = _sampled(rows, calibrated)
    slope, shift = _calibrated(*_left_out(some, Fitted(sent, numbers)))
    return Fitted(sent, numbers, slope, shift)


def _left_out(rows: DataFrame, fitted: Fitted) -> tuple[np.ndarray, np.ndarray]:
    """The votes for labelled texts, each without itself, and their labels."""

    def votes(model: Model, frame: pd.DataFrame) -> Iterator[float]:
        vectors = [model.weighted(*known(t, fitted.numbers.value)) for t in frame["text"]]
        near = model.index.search(vectors, model.neighbours + 1)
        for name, found in zip(frame["doc_id"], near, strict=True):
            # The text itself: among rows of one id, the most similar.
            own = np.flatnonzero(model.ids[found[0]] == name)
            yield model.vote(*without(found, found[0][own[0]] if len(own) else -1, model.neighbours))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in rows_of(frames):
            found = list(votes(fitted.model.value, frame))
            yield pd.DataFrame({"vote": np.array(found, dtype=float), "toxic": frame["toxic"] > 0})

    found = rows.mapInPandas(run, "vote double, toxic boolean").toArrow()
    found = found.sort_by([("vote", "ascending"), ("toxic", "ascending")])
    return found.column("vote").to_numpy(), found.column("toxic").to_numpy().astype(float)


def predict(docs: DataFrame, fitted: Fitted) -> DataFrame:
    """(doc_id, score, neighbours, similarities) of rows (doc_id, text); row by row.

    Null and empty texts have no neighbours. Equal texts are searched once, as long as a task
    remembers them (by hashes of 128 bits).
    """
    small_batches(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = fitted.model.value._replace(slope=fitted.slope, shift=fitted.shift)
        done: dict[bytes, tuple] = {}
        for frame in rows_of(frames):
            if len(done) > _REMEMBERED:
                done.clear()
            keys = [xxhash.xxh128_digest(text_of(t).encode("utf-8", "surrogatepass")) for t in frame["text"]]
            new = {key: t for key, t in zip(keys, frame["text"], strict=True) if key not in done}
            counted = [known(t, fitted.numbers.value) for t in new.values()]
            done.update(zip(new, model.scores(counted), strict=True))
            found = [done[key] for key in keys]
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "score": [f[0] for f in found],
                    "neighbours": [f[1] for f in found],
                    "similarities": [f[2] for f in found],
                }
            )

    return docs.select("doc_id", "text").mapInPandas(
        run, f"doc_id {id_type}, score double, neighbours array<{id_type}>, similarities array<double>"
    )


def score(
    docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, sample: int = SAMPLE
) -> DataFrame:
    """(doc_id, held_out, score, predicted, neighbours, similarities): one row per input row.

    Null and empty texts count as without terms; repeated rows get equal scores; an id may be null;
    a table without rows gives none.
    """
    rows = pick(docs, doc_id="doc_id", text="text")
    marked = pick(labels, doc_id="doc_id", toxic="toxic").where(fold(F.col("doc_id"), folds) != held)
    found = predict(rows, fit(rows, marked, sample))
    return found.select(
        "doc_id",
        (fold(F.col("doc_id"), folds) == held).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "neighbours",
        "similarities",
    )
