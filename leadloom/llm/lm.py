"""Language-model scores of whole documents: corpus counts and a gated recurrent network.

Counts of all words of the training documents are made by Spark (summed per task first) and stay
distributed. A head of the vocabulary of bounded size is known to every task; rarer words are looked
up by joining their hashes (64 bits, so that two words share one by chance only) with the counts.

The network predicts the class of each word and, in classes of the most frequent words, the word
itself; in classes of rare words a word has its share of the class's counts. Rare classes are
stretches of the vocabulary sorted by its words read backwards, so a class stands for a kind of
ending and with it mostly for a language. An unknown word counts 0.1 in its class, as in the base
model, so both models give probabilities to the same events.

The network makes a fixed number of first steps over a small sample of the training documents and then
learns from all of them in a few rounds. In a round every task runs the same
truncated backpropagation over its own documents of that round, from the weights all share; the mean
of the tasks' weights, by their words, starts the next round.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm import gru
from leadloom.llm.shared import fold, pick, rows_of, small_batches, text_of
from leadloom.session import materialise

SEED = 42
HEAD = 1 << 18
FREQUENT = 4096
FREQUENT_CLASSES = 48
RARE_CLASSES = 48
TRAIN_TOKENS = 1_500_000
ROUNDS = 4
WARM_STEPS, WARM_STREAMS, WARM_WINDOW = 400, 64, 16
ADDED = 0.1
END = b" "
_HELD_WORDS = 1_500_000
_CHUNK_TOKENS = 3_000_000
_PIECE = 4096
_LN10 = float(np.log(10))


def words(text: object) -> list[bytes]:
    """Words between ASCII white space, ASCII letters lower-cased, and the end of the document."""
    return [*text_of(text).encode("utf-8", "surrogatepass").lower().split(), END]


def hashed(word: bytes) -> int:
    """The hash of a word as Spark's xxhash64 gives it."""
    value = xxhash.xxh64_intdigest(word, SEED)
    return value - (1 << 64) if value >> 63 else value


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): how often each word occurs; a task sums a bounded number of words at a time."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()

        def out() -> pd.DataFrame:
            return pd.DataFrame({"word": list(held.keys()), "n": list(held.values())})

        for frame in rows_of(frames):
            for text in frame["text"]:
                held.update(words(text))
            if len(held) > _HELD_WORDS:
                yield out()
                held = Counter()
        yield out()

    partial = docs.select("text").mapInPandas(run, "word binary, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary(NamedTuple):
    """What every task knows: the head of the vocabulary and the layout of the classes."""

    tokens: int
    distinct: int
    least: int
    number: dict[bytes, int]
    counts: np.ndarray
    inputs: np.ndarray
    layout: gru.Layout
    borders: list[bytes]

    @property
    def end(self) -> int:
        return int(self.inputs[self.number[END]])

    def rare_class(self, word: bytes) -> int:
        return bisect_right(self.borders, word[::-1])


def _threshold(counts: DataFrame, most: int) -> tuple[int, int, int]:
    """(tokens, distinct words, least count of the largest head of at most `most` words)."""
    # Counts of counts: few different values, the larger ones pooled by their leading digits.
    unit = F.floor(F.pow(F.lit(2.0), F.greatest(F.lit(0.0), F.floor(F.log2("n")) - 12)))
    pooled = F.floor(F.col("n") / unit) * unit
    rows = counts.groupBy(pooled.cast("long").alias("low")).agg(
        F.count("*").alias("words"), F.sum("n").alias("tokens")
    )
    held, least = 0, 0
    found = sorted(rows.collect(), key=lambda r: -r["low"])
    for r in found:
        if held + r["words"] > most:
            break
        held, least = held + r["words"], r["low"]
    if found and not held:
        least = found[0]["low"] + 1
    return sum(r["tokens"] for r in found), sum(r["words"] for r in found), max(1, least)


def vocabulary(counts: DataFrame, head: int = HEAD, frequent: int = FREQUENT) -> Vocabulary | None:
    """The head and the classes; None where there are no words at all."""
    tokens, distinct, least = _threshold(counts, head)
    if not tokens:
        return None
    top = counts.where((F.col("n") >= least) | (F.col("word") == F.lit(END))).toArrow()
    names, sizes = top.column("word").to_pylist(), top.column("n").to_pylist()
    order = sorted(range(len(names)), key=lambda k: (-sizes[k], names[k]))
    # Frequent words, each class a stretch of the sorted endings of about equally many tokens.
    chosen = sorted(order[:frequent], key=lambda k: names[k][::-1])
    mass = np.cumsum([sizes[k] for k in chosen])
    n_classes = min(FREQUENT_CLASSES, len(chosen))
    kind = np.minimum((mass - 1) * n_classes // mass[-1], n_classes - 1)
    # No class gets far more words than the others either.
    kind = np.unique(
        np.maximum(kind * 4096, 0) + np.arange(len(chosen)) // max(1, frequent // 24),
        return_inverse=True,
    )[1]
    begin = np.r_[np.flatnonzero(np.r_[True, kind[1:] != kind[:-1]]), len(chosen)]
    rest = sorted((names[k][::-1], sizes[k]) for k in order[frequent:])
    borders: list[bytes] = []
    if rest:
        running = np.cumsum([n for _, n in rest])
        cuts = np.searchsorted(running, running[-1] * np.arange(1, RARE_CLASSES) / RARE_CLASSES)
        borders = sorted({rest[c][0] for c in cuts})
    place = {k: i for i, k in enumerate(chosen)}
    inputs, number = np.empty(len(order), dtype=np.int32), {}
    for i, k in enumerate(order):
        number[names[k]] = i
        inputs[i] = place[k] if k in place else len(chosen) + bisect_right(borders, names[k][::-1])
    layout = gru.Layout(
        begin, np.array([sizes[k] for k in chosen], dtype=np.float64), np.zeros(len(borders) + 1)
    )
    found = Vocabulary(
        tokens, distinct, least, number, np.array([sizes[k] for k in order], dtype=np.float64),
        inputs, layout, borders,
    )
    return found._replace(layout=layout._replace(masses=_rare_masses(counts, found)))


def _rare_masses(counts: DataFrame, known: Vocabulary) -> np.ndarray:
    """Counts of all words outside the frequent ones per rare class, with what is added to each."""
    words_in = known.layout.words
    borders, least = known.borders, known.least

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(borders) + 1)
        for frame in frames:
            for word, n in zip(frame["word"], frame["n"], strict=True):
                total[bisect_right(borders, word[::-1])] += n + ADDED
        yield pd.DataFrame({"k": np.arange(len(total)), "mass": total})

    tail = counts.where((F.col("n") < least) & (F.col("word") != F.lit(END)))
    sums = tail.mapInPandas(run, "k int, mass double").groupBy("k").agg(F.sum("mass").alias("mass"))
    masses = np.full(len(borders) + 1, ADDED)
    for r in sums.collect():
        masses[r["k"]] += r["mass"]
    rare = known.inputs >= words_in
    np.add.at(masses, known.inputs[rare] - words_in, known.counts[rare] + ADDED)
    return masses


def encoded(text: object, known: Vocabulary) -> tuple[np.ndarray, list[bytes]]:
    """Codes of a text's words and the words outside the head, see `decoded`."""
    found = words(text)
    get = known.number.get
    codes = np.fromiter((get(w, -1) for w in found), dtype="<i4", count=len(found))
    outside = np.flatnonzero(codes < 0)
    tail = [found[k] for k in outside]
    if len(tail):
        codes[outside] = [-1 - known.rare_class(w) for w in tail]
    return codes, tail


def decoded(codes: bytes, known: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Input numbers of a text's words, and head numbers of those in the head.

    A code is the head number or, below 0, one less than the negative number of the rare class.
    """
    numbers = np.frombuffer(codes, dtype="<i4")
    inputs = known.inputs[np.maximum(numbers, 0)]
    inputs = np.where(numbers < 0, known.layout.words - 1 - numbers, inputs)
    return inputs.astype(np.int32), numbers[numbers >= 0]


def encode(docs: DataFrame, known: Vocabulary) -> DataFrame:
    """The rows with the codes of all their words and the hashes of those outside the head."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in rows_of(frames):
            found = [encoded(t, known) for t in frame["text"]]
            yield frame.drop(columns="text").assign(
                codes=[c.tobytes() for c, _ in found],
                tail=[[hashed(w) for w in tail] for _, tail in found],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("uid", "doc_id", "held_out", "turn", "text").mapInPandas(
        run,
        f"uid long, doc_id {id_type}, held_out boolean, turn long, codes binary, tail array<long>",
    )


def fit(train: DataFrame, known: Vocabulary, tokens: int = TRAIN_TOKENS) -> gru.Weights:
    """The network, from all documents of `train` (rows of `encode`).

    It starts warm: one task makes WARM_STEPS small steps over a sample of about as many words as
    they take, gone through again where there are fewer. Then every document is learned from in one
    of the rounds, where a task holds about `tokens` words at a time and goes on from its own weights
    until its documents are through. Both parts run alike at every size.
    """
    small_batches(train.sparkSession)
    weights = gru.start(known.layout)
    rows = train.select("turn", "codes")
    share = int(min(1.0, WARM_STEPS * WARM_STREAMS * WARM_WINDOW / known.tokens) * (1 << 30))
    few = rows.where(F.pmod(F.xxhash64("turn", F.lit("warm")), F.lit(1 << 30)) < share).coalesce(1)
    weights = _round(few, known, weights, tokens, (0.0, 0.0), warm=True)
    for r in range(ROUNDS):
        own = rows.where(F.pmod("turn", F.lit(ROUNDS)) == r).coalesce(-(-known.tokens // tokens))
        weights = _round(own, known, weights, tokens, (r / ROUNDS, (r + 1) / ROUNDS))
    return weights


def _round(
    rows: DataFrame,
    known: Vocabulary,
    weights: gru.Weights,
    tokens: int,
    done: tuple[float, float],
    warm: bool = False,
) -> gru.Weights:
    """One round over all rows: the mean of what the tasks learn, by their words.

    `done` is the share of the training before and after this round. The sample of a warm start is
    learned from as a whole.
    """

    end = known.end
    # The words themselves are not needed any more.
    known = known._replace(number={})

    def learn(held: list, now: gru.Weights) -> gru.Weights:
        # A fixed order, whatever order the rows were written in.
        held.sort()
        stream = np.concatenate([decoded(codes, known)[0] for _, codes in held])
        if warm:
            return gru.train(
                now, known.layout, stream, end, WARM_STREAMS, WARM_WINDOW, done=done, steps=WARM_STEPS
            )
        return gru.train(now, known.layout, stream, end, done=done)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held, size, total = weights, [], 0, 0
        for frame in frames:
            for turn, codes in zip(frame["turn"], frame["codes"], strict=True):
                held.append((turn, codes))
                size += len(codes) // 4
                if size >= tokens and not warm:
                    now, total = learn(held, now), total + size
                    held, size = [], 0
        if held:
            now, total = learn(held, now), total + size
        if total:
            flat = np.concatenate([w.ravel() for w in now]).astype("<f4")
            pieces = range(0, len(flat), _PIECE)
            yield pd.DataFrame(
                {
                    "k": np.arange(len(pieces), dtype=np.int32),
                    "n": np.full(len(pieces), total),
                    "w": [flat[p : p + _PIECE].tobytes() for p in pieces],
                }
            )

    def mean(frame: pd.DataFrame) -> pd.DataFrame:
        # By value, so that the sum does not depend on the order of arrival.
        frame = frame.sort_values(["n", "w"])
        held = sum(n * np.frombuffer(w, "<f4").astype(float) for n, w in zip(frame["n"], frame["w"], strict=True))
        value = (held / frame["n"].sum()).astype("<f4").tobytes()
        return pd.DataFrame({"k": frame["k"].iloc[:1], "w": [value]})

    learned = rows.mapInPandas(run, "k int, n long, w binary")
    found = learned.groupBy("k").applyInPandas(mean, "k int, w binary").collect()
    if not found:
        return weights
    flat = np.concatenate([np.frombuffer(r["w"], "<f4") for r in sorted(found, key=lambda r: r["k"])])
    ends = np.cumsum([w.size for w in weights])[:-1]
    return gru.Weights(
        *[part.reshape(w.shape) for part, w in zip(np.split(flat, ends), weights, strict=True)]
    )


_SCORED = "n_tokens long, head_known long, head_log double, model_log double"


def _head_scores(docs: DataFrame, known: Vocabulary, weights: gru.Weights) -> DataFrame:
    """Per row of `encode` all that the head decides.

    head_log: sum of log10(count + 0.1) over words of the head. model_log: log10 probability without
    the log10(count + 0.1) of words outside of the head.
    """
    log_counts = np.log10(known.counts + ADDED)
    # In a rare class a word has (count + 0.1) / mass; frequent words come from the network.
    rare = known.inputs >= known.layout.words
    log_rare = np.where(rare, log_counts, 0.0)
    log_mass = np.r_[np.zeros(known.layout.words), np.log10(known.layout.masses)]
    end = known.end
    # The words themselves are not needed any more.
    known = known._replace(number={})

    def scored(keys: list, held: list) -> pd.DataFrame:
        texts = [h[0] for h in held]
        values = gru.score(weights, known.layout, texts, end) / _LN10
        rows = []
        for key, value, (inputs, head) in zip(keys, values, held, strict=True):
            rows.append(
                (
                    *key,
                    len(inputs),
                    len(head),
                    float(log_counts[head].sum()),
                    float(value + log_rare[head].sum() - log_mass[inputs].sum()),
                )
            )
        names = ["uid", "doc_id", "held_out", "n_tokens", "head_known", "head_log", "model_log"]
        return pd.DataFrame(rows, columns=names)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, held, size = [], [], 0
        for frame in frames:
            for *key, codes in zip(
                frame["uid"], frame["doc_id"], frame["held_out"], frame["codes"], strict=True
            ):
                inputs, head = decoded(codes, known)
                keys.append(key)
                held.append((inputs, head))
                size += len(inputs)
                if size > _CHUNK_TOKENS:
                    yield scored(keys, held)
                    keys, held, size = [], [], 0
        if keys:
            yield scored(keys, held)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("uid", "doc_id", "held_out", "codes").mapInPandas(
        run, f"uid long, doc_id {id_type}, held_out boolean, {_SCORED}"
    )


def score(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 10,
    held: int = 0,
    head: int = HEAD,
    train_tokens: int = TRAIN_TOKENS,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score): one row per row.

    Learns from all documents outside of fold `held`, a task from about `train_tokens` words at a
    time. A missing text is empty and has one token, its
    end. Without any training document no word is known, the vocabulary is empty, and both scores
    are 0. Repeated rows are scored alike.
    """
    small_batches(docs.sparkSession)
    rows = pick(docs, doc_id=id_col, text=text_col)
    out = fold(F.col("doc_id"), folds) == held
    counts = materialise(word_counts(rows.where(~out)), "lm-counts")
    known = vocabulary(counts, head)
    zero = F.lit(0).cast("long")
    if known is None:
        blank = F.lit(0.0)
        inner = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
        return rows.select(
            "doc_id", out.alias("held_out"), (inner + 1).cast("long").alias("n_tokens"),
            zero.alias("n_known"), zero.alias("train_tokens"), blank.alias("base_score"),
            blank.alias("score"),
        )
    keyed = rows.select(
        F.monotonically_increasing_id().alias("uid"),
        "doc_id",
        out.alias("held_out"),
        F.xxhash64(F.coalesce("text", F.lit("")), F.lit("order")).alias("turn"),
        "text",
    )
    coded = materialise(encode(keyed, known), "lm-documents")
    weights = fit(coded.where(~F.col("held_out")), known, train_tokens)
    scored = _head_scores(coded, known, weights)
    tails = coded.where(F.size("tail") > 0).select("uid", F.explode("tail").alias("h"))
    rare = counts.where(F.col("n") < known.least).select(F.xxhash64("word").alias("h"), "n")
    sums = (
        tails.join(rare, "h", "left")
        .select("uid", F.log10(F.coalesce("n", zero) + ADDED).alias("log"), F.col("n").isNotNull().cast("long").alias("hit"))
        .groupBy("uid")
        .agg(F.sum("log").alias("log"), F.sum("hit").alias("hits"))
    )
    log_all = float(np.log10(known.tokens + ADDED * (known.distinct + 1)))
    tail_log = F.coalesce("log", F.lit(0.0))
    return scored.join(sums, "uid", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.coalesce("hits", zero)).alias("n_known"),
        F.lit(int(known.tokens)).cast("long").alias("train_tokens"),
        (F.col("head_log") + tail_log - F.col("n_tokens") * log_all).alias("base_score"),
        (F.col("model_log") + tail_log).alias("score"),
    )
