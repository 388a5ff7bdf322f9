"""Quality classifier by positive-unlabelled learning.

Trusted positives are texts labelled good; the unlabelled web text is a sample of all documents of
the training folds, good and bad unknown. A small neural network is trained by the non-negative
unbiased risk: with class prior p, loss l and score f the risk is

    p * E_positive[l(f)] + max(0, E_unlabelled[l(-f)] - p * E_positive[l(-f)]),

where a step that finds the second term negative goes against it instead. Labels for bad texts are
not used. The prior is estimated first: a plain classifier of positives against unlabelled texts
is trained on one half of the sample; p is the smallest ratio of the shares of unlabelled and of
positive texts above a threshold, with an allowance for their random error. The shares are counted
over the other half of the positives and over all unlabelled texts but those it was trained on.

The network sees statistics of the whole text only; nothing of a row but its text is an input.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.llm.shared import fold, pick, rows_of, small_batches, text_of

SAMPLE = 20_000
HIDDEN = 24
EPOCHS = 60
BATCH = 128
LEAST_STEPS = 1000
DECAY = 0.01
RATE = 0.003
_CLASSES = np.zeros(256, dtype=np.uint8)
for _byte in range(256):
    _c = chr(_byte)
    _CLASSES[_byte] = (
        7 if _byte >= 0x80 else
        1 if _c.islower() else
        2 if _c.isupper() else
        3 if _c.isdigit() else
        4 if _c in " \t\r\f\v" else
        5 if _c == "\n" else
        6 if _c in ".,;:'\"?-()" else
        0
    )
_LISTED = list(b"!#$%&*|<>{}[]=_/\\@")
_SENTENCE = re.compile(r"[.!?]+(?:\s|$)")
_LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint64)
_PIECE = 1 << 18
_ODD = 0x9E3779B97F4A7C15


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    step, inverse = np.full(n, _ODD, dtype=np.uint64), np.full(n, pow(_ODD, -1, 1 << 64), dtype=np.uint64)
    step[0] = inverse[0] = 1
    return np.multiply.accumulate(step), np.multiply.accumulate(inverse)


_POWER, _INVERSE = _powers(_PIECE + 1)


def _pieces(raw: np.ndarray) -> Iterator[np.ndarray]:
    """Stretches of at most _PIECE bytes, cut after white space where there is any."""
    at = 0
    while at < len(raw):
        end = min(len(raw), at + _PIECE)
        if end < len(raw):
            kinds = _CLASSES[raw[at:end]]
            space = np.flatnonzero((kinds == 4) | (kinds == 5))
            if len(space):
                end = at + int(space[-1]) + 1
        yield raw[at:end]
        at = end


def _words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per word: a hash of its lower-cased bytes, and (bytes, first, last, lower, upper, digit, beyond)."""
    kinds = _CLASSES[raw]
    inside = (kinds != 4) & (kinds != 5)
    edge = np.diff(np.r_[False, inside, False].astype(np.int8))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(begin):
        return np.empty(0, dtype=np.uint64), np.empty((0, 7), dtype=np.int64)
    total = np.r_[np.uint64(0), np.cumsum((_LOWER[raw] + np.uint64(1)) * _POWER[: len(raw)])]
    hashes = (total[end] - total[begin]) * _INVERSE[begin]
    counted = []
    for kind in (1, 2, 3, 7):
        run = np.r_[0, np.cumsum(kinds == kind)]
        counted.append(run[end] - run[begin])
    table = np.stack([end - begin, kinds[begin], kinds[end - 1], *counted], axis=1)
    # "!" ends a sentence, so it is no odd end of a word.
    table[raw[end - 1] == 0x21, 2] = 6
    return hashes, table.astype(np.int64)


def _distinct(hashes: np.ndarray) -> np.ndarray:
    """How often each different value occurs, most often first."""
    return np.sort(np.unique(hashes, return_counts=True)[1])[::-1]


def features(text: object) -> np.ndarray:
    """Statistics of the whole text; finite for every text, also an empty one."""
    text = text_of(text)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    counts = np.bincount(raw, minlength=256) if len(raw) else np.zeros(256)
    size = max(1, len(raw))
    kinds = np.bincount(_CLASSES, weights=counts, minlength=8) / size
    listed = counts[_LISTED] / size
    found = [_words(piece) for piece in _pieces(raw)] or [_words(raw)]
    hashes = np.concatenate([h for h, _ in found])
    length, first, last, low, up, digit, beyond = np.concatenate([t for _, t in found]).T
    n = max(1, len(hashes))
    often = _distinct(hashes)
    triples = hashes[:-2] * np.uint64(3) + hashes[1:-1] * np.uint64(5) + hashes[2:] * np.uint64(7)
    lengths = length.astype(np.float64) if len(length) else np.zeros(1)
    lines = [x for x in text.split("\n") if x.strip()]
    line_lengths = np.array([len(x) for x in lines], dtype=np.float64) if lines else np.zeros(1)
    sentences = len(_SENTENCE.findall(text))
    values = [
        np.log1p(len(text)), np.log1p(len(hashes)), np.log1p(len(lines)),
        *np.sqrt(kinds), *np.sqrt(listed),
        lengths.mean(), lengths.std(), np.log1p(lengths.max()),
        # Distinct words against what a text of this length has (a power of the length).
        len(often) / n**0.85, len(often) / n,
        often[:5].sum() / n, often[:1].sum() / n,
        (hashes[1:] == hashes[:-1]).sum() / n, len(_distinct(triples)) / max(1, len(triples)),
        ((up >= 2) & (low == 0)).sum() / n, (first == 2).sum() / n, (last == 0).sum() / n,
        (low + up + digit + beyond == 0).sum() / n, (digit > 0).sum() / n,
        sentences / n, np.log1p(n / max(1, sentences)),
        len(set(lines)) / max(1, len(lines)),
        np.log1p(line_lengths.mean()), np.log1p(line_lengths.std()),
        (length == 1).sum() / n, (length > 20).sum() / n,
    ]
    return np.array(values, dtype=np.float32)


WIDTH = len(features(""))


def _table(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Features and half (column `_half`) of the texts of a bounded sample, gathered on the driver."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in rows_of(frames):
            found = [features(t).tobytes() for t in frame["text"]]
            yield pd.DataFrame({"x": found, "half": frame["_half"]})

    rows = docs.select("text", "_half").mapInPandas(run, "x binary, half int").collect()
    # A fixed order, whatever order the tasks returned.
    rows.sort(key=lambda r: (r["x"], r["half"]))
    table = np.array([np.frombuffer(r["x"], dtype=np.float32) for r in rows]).reshape(-1, WIDTH)
    return table, np.array([r["half"] for r in rows], dtype=np.int64)


def _chosen(rows: DataFrame, most: int, *keys: str) -> Column:
    """Whether a row is one of about `most`, or of all if there are fewer: by its hashed keys."""
    n = rows.count()
    if n <= most:
        return F.lit(True)
    share = int(most / n * (1 << 30))
    return F.pmod(F.xxhash64(*keys, F.lit("sample")), F.lit(1 << 30)) < share


class Net(NamedTuple):
    """One hidden layer on standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(self.standard(x) @ self.w1 + self.b1) @ self.w2 + self.b2[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def _train(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, seed: int, epochs: int, least: int
) -> Net:
    """A network by the non-negative risk, or, without a prior, of positives against unlabelled."""
    random = np.random.default_rng(seed)
    both = np.concatenate([positive, unlabelled])
    net = Net(
        both.mean(axis=0),
        both.std(axis=0) + 1e-3,
        random.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, HIDDEN)),
        np.zeros(HIDDEN),
        random.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
        np.zeros(1),
    )
    p_all, u_all = net.standard(positive), net.standard(unlabelled)
    weights = list(net[2:])
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    steps = max(1, min(len(p_all), len(u_all)) // BATCH)
    t = 0
    for _ in range(max(epochs, -(-least // steps))):
        p_order, u_order = random.permutation(len(p_all)), random.permutation(len(u_all))
        for k in range(steps):
            t += 1
            x_p, x_u = p_all[p_order[k::steps]], u_all[u_order[k::steps]]
            x = np.concatenate([x_p, x_u])
            hidden = np.tanh(x @ weights[0] + weights[1])
            f = hidden @ weights[2] + weights[3][0]
            s = 1 / (1 + np.exp(-np.clip(f, -30, 30)))
            slope = s * (1 - s)
            n_p, n_u = len(x_p), len(x_u)
            if prior is None:
                d = np.concatenate([(s[:n_p] - 1) / n_p, s[n_p:] / n_u])
            else:
                # Sigmoid loss: l(f) = 1 - s on positives' side, l(-f) = s on the other.
                risk = s[n_p:].mean() - prior * s[:n_p].mean()
                rest = np.concatenate([-prior * slope[:n_p] / n_p, slope[n_p:] / n_u])
                good = np.concatenate([-prior * slope[:n_p] / n_p, np.zeros(n_u)])
                d = good + rest if risk >= 0 else -rest
            back = np.outer(d, weights[2]) * (1 - hidden**2)
            grads = [x.T @ back, back.sum(axis=0), hidden.T @ d, np.array([d.sum()])]
            for j, g in enumerate(grads):
                g = g + DECAY * weights[j]
                first[j] = 0.9 * first[j] + 0.1 * g
                second[j] = 0.999 * second[j] + 0.001 * g * g
                step = first[j] / (1 - 0.9**t) / (np.sqrt(second[j] / (1 - 0.999**t)) + 1e-8)
                weights[j] = weights[j] - RATE * step
    return net._replace(w1=weights[0], b1=weights[1], w2=weights[2], b2=weights[3])


def _counts_above(docs: DataFrame, net: Net, thresholds: np.ndarray) -> tuple[np.ndarray, int]:
    """How many of all texts the classifier puts at or above each threshold, and their number."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(len(thresholds) + 1, dtype=np.int64)
        for frame in rows_of(frames):
            values = net.raw(np.array([features(t) for t in frame["text"]]).reshape(-1, WIDTH))
            counts[:-1] += (values[:, None] >= thresholds).sum(axis=0)
            counts[-1] += len(frame)
        yield pd.DataFrame({"k": np.arange(len(counts)), "n": counts})

    sums = docs.select("text").mapInPandas(run, "k int, n long").groupBy("k").agg(F.sum("n").alias("n"))
    counts = np.zeros(len(thresholds) + 1, dtype=np.int64)
    for r in sums.collect():
        counts[r["k"]] = r["n"]
    return counts[:-1], int(counts[-1])


def class_prior(
    positive: np.ndarray, unlabelled: np.ndarray, others: DataFrame, seed: int = 3
) -> float:
    """Share of good texts among the unlabelled ones, within 0.05 and 0.98.

    A classifier of half the positives against `unlabelled` is fitted; `others` are all unlabelled
    texts that it has not seen.
    """
    half = len(positive) // 2
    net = _train(positive[:half], unlabelled, None, seed, 20, 150)
    p = net.raw(positive[half:])
    thresholds = np.quantile(p, np.linspace(0, 0.95, 96))
    above_p = np.array([(p >= t).mean() for t in thresholds])
    counts, n = _counts_above(others, net, thresholds)
    above_u = counts / max(1, n)
    error = np.sqrt(np.log(40) / 2 / max(1, n)) + np.sqrt(np.log(40) / 2 / len(p))
    best = int(((above_u + error) / above_p).argmin())
    return float(np.clip(above_u[best] / above_p[best], 0.05, 0.98))


class Model(NamedTuple):
    net: Net | None
    prior: float

    def scores(self, texts: list) -> np.ndarray:
        if self.net is None:
            return np.full(len(texts), 0.5)
        return self.net.score(np.array([features(t) for t in texts]).reshape(-1, WIDTH))


def fit(
    positives: DataFrame, unlabelled: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id"
) -> Model:
    """Learn from (doc_id, text) rows of good and of unknown texts.

    Both networks are fitted on about `sample` of each at most; the class prior is counted over all
    unknown texts. With fewer than four of either nothing can be learned, and all scores are 0.5.
    Repeated rows count as often as they occur; missing texts are empty.
    """
    small_batches(positives.sparkSession)
    half = F.pmod(F.xxhash64(id_col, "text", F.lit("half")), F.lit(2)).cast("int")
    positives, unlabelled = (rows.withColumn("_half", half) for rows in (positives, unlabelled))
    few = _chosen(unlabelled, sample, id_col, "text")
    good, _ = _table(positives.where(_chosen(positives, sample, id_col, "text")))
    unknown, halves = _table(unlabelled.where(few))
    if len(good) < 4 or len(unknown) < 4:
        return Model(None, 0.5)
    random = np.random.default_rng(11)
    random.shuffle(good)
    order = random.permutation(len(unknown))
    unknown, halves = unknown[order], halves[order]
    if 0 < halves.sum() < len(halves):
        prior = class_prior(good, unknown[halves == 0], unlabelled.where(~(few & (F.col("_half") == 0))))
    else:
        # All rows fell into one half, as repeats of one row do.
        prior = 0.5
    return Model(_train(good, unknown, prior, 5, EPOCHS, LEAST_STEPS), prior)


def training_rows(docs: DataFrame, labels: DataFrame, folds: int, held: int, sample: int):
    """(positives, unlabelled): rows of the training folds, the positives' ids checked in size."""
    spark = docs.sparkSession
    small_batches(spark)
    train = fold(F.col("doc_id"), folds) != held
    rows = pick(docs, doc_id="doc_id", text="text").where(train)
    good = pick(labels, doc_id="doc_id", quality="quality").where("quality = 1").where(train)
    # The sample of ids is bounded, so it may be broadcast to the documents.
    ids = good.select("doc_id").distinct()
    ids = ids.where(_chosen(ids, sample, "doc_id"))
    return rows.join(F.broadcast(ids), "doc_id", "left_semi"), rows


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` with `_quality` appended, from column `text`; row by row."""
    small_batches(docs.sparkSession)
    columns = docs.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in rows_of(frames):
            yield frame[columns].assign(_quality=model.scores(frame["text"].tolist()))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInPandas(run, f"{kinds}, _quality double")


def score(
    docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, sample: int = SAMPLE
) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row per input row, also for empty texts."""
    model = fit(*training_rows(docs, labels, folds, held, sample), sample)
    found = predict(pick(docs, doc_id="doc_id", text="text"), model)
    return found.select(
        "doc_id",
        (fold(F.col("doc_id"), folds) == held).alias("held_out"),
        F.col("_quality").alias("score"),
        (F.col("_quality") >= 0.5).cast("int").alias("predicted"),
    )
