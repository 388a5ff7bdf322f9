"""Language identification by error-correcting output codes over binary n-gram classifiers.

Each language has a codeword of bits. For every bit a binary classifier compares the byte-trigram
frequencies of the languages that have the bit with those of the languages that have not (a log
ratio per trigram bin, averaged over a text). A text's margins are decoded by loss: the codeword
with the least weighted logistic loss wins, bits that separate their languages better weigh more,
and a text whose two best codewords are nearly equally good is flagged as ambiguous.

The counts cover all training texts; only one row of counts per language is gathered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import product
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm.shared import fold, pick, rows_of, small_batches, text_of

BINS = 1 << 14
SCALE = 4.0
AMBIGUOUS = 0.6
MOST_LANGUAGES = 2000
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
# Lower case is taken before; everything in ASCII that is no letter is a space.
_SPACED = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
_SMOOTH = 0.5


def trigrams(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Bins of all byte trigrams of the texts, one after another, and where each text begins.

    Every text stands between spaces, so that it has at least one trigram.
    """
    parts = [
        b"  " + text_of(t).lower().encode("utf-8", "surrogatepass").translate(_SPACED) + b" "
        for t in texts
    ]
    begins = np.cumsum([0, *[len(p) for p in parts]])[:-1]
    raw = np.frombuffer(b"".join(parts) + b"  ", dtype=np.uint8).astype(np.uint32)
    code = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    code *= np.uint32(2654435769)
    return (code >> np.uint32(32 - 14)).astype(np.int32), begins


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """A matrix of +1 and -1, one row per language, whose rows lie far apart.

    Up to seven languages get the exhaustive code; more get the best of some random codes, of a
    length that grows with the logarithm of their number.
    """
    if n < 2:
        return np.ones((n, 0), dtype=np.int8)
    if n <= 7:
        columns = [(1, *c) for c in product((1, -1), repeat=n - 1) if -1 in c]
        return np.array(columns, dtype=np.int8).T
    length = int(np.ceil(10 * np.log2(n)))
    random = np.random.default_rng(seed)
    best, most = None, -1
    for _ in range(20):
        code = random.choice(np.array([-1, 1], dtype=np.int8), size=(n, length))
        code = code[:, np.abs(code.astype(int).sum(axis=0)) < n]
        gram = code.astype(np.int32) @ code.T.astype(np.int32)
        least = int((code.shape[1] - gram[~np.eye(n, dtype=bool)].max()) // 2)
        if least > most:
            best, most = code, least
    return best


class Model(NamedTuple):
    languages: list[str]
    code: np.ndarray
    tables: np.ndarray
    weights: np.ndarray

    def margins(self, texts: list) -> np.ndarray:
        """Mean log ratio per text and bit."""
        bins, begins = trigrams(texts)
        sizes = np.diff(np.r_[begins, len(bins)])
        found = np.empty((len(texts), len(self.tables)))
        for j, table in enumerate(self.tables):
            found[:, j] = np.add.reduceat(table[bins].astype(np.float64), begins) / sizes
        return found

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language number, score, ambiguous): the score is the winner's share of the softmax."""
        n = len(margins)
        if not len(self.tables):
            return np.zeros(n, dtype=int), np.ones(n), np.zeros(n, dtype=bool)
        agreement = SCALE * margins[:, None, :] * self.code[None, :, :]
        loss = (np.logaddexp(0, -agreement) * self.weights).sum(axis=2)
        likely = np.exp(loss.min(axis=1, keepdims=True) - loss)
        likely /= likely.sum(axis=1, keepdims=True)
        best = likely.argmax(axis=1)
        score = likely[np.arange(n), best]
        return best, score, score < AMBIGUOUS


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """Learn from all rows with a language and a text."""
    small_batches(docs.sparkSession)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, np.ndarray] = {}
        for frame in rows_of(frames):
            for lang, part in frame.groupby("lang", sort=False):
                bins, _ = trigrams(part["text"].tolist())
                found = np.bincount(bins, minlength=BINS)
                held[lang] = held.get(lang, 0) + found
        for lang, counts in held.items():
            yield pd.DataFrame({"lang": [lang], "counts": [counts.astype(np.int64)]})

    rows = pick(docs, lang=lang_col, text=text_col).where("lang IS NOT NULL AND text IS NOT NULL")
    partial = rows.mapInPandas(count, "lang string, counts array<long>")
    by_bin = (
        partial.select("lang", F.posexplode("counts").alias("bin", "n"))
        .where("n > 0")
        .groupBy("lang", "bin")
        .agg(F.sum("n").alias("n"))
    )
    packed = by_bin.groupBy("lang").agg(F.collect_list(F.struct("bin", "n")).alias("counts"))
    found = sorted(packed.limit(MOST_LANGUAGES + 1).collect(), key=lambda r: r["lang"])
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"at most {MOST_LANGUAGES} languages can be learned")
    languages = [r["lang"] for r in found]
    counts = np.zeros((len(found), BINS))
    for k, r in enumerate(found):
        counts[k, [c["bin"] for c in r["counts"]]] = [c["n"] for c in r["counts"]]
    return _model(languages, counts)


def _model(languages: list[str], counts: np.ndarray) -> Model:
    code = codewords(len(languages))
    # Each language counts alike in a side of a bit, however much text it has.
    share = (counts + _SMOOTH) / (counts + _SMOOTH).sum(axis=1, keepdims=True)
    tables, weights = [], []
    for column in code.T:
        table = np.log(share[column > 0].mean(axis=0)) - np.log(share[column < 0].mean(axis=0))
        # How clearly the languages lie on their sides, at worst.
        weights.append(max(1e-3, float((column * (share @ table)).min())))
        tables.append(table.astype(np.float32))
    weight = np.array(weights)
    weight = weight / weight.mean() if len(weight) else weight
    return Model(languages, code, np.array(tables, dtype=np.float32), weight)


def has_letter(text: object) -> bool:
    return isinstance(text, str) and _LETTER.search(text) is not None


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of `docs` with `_lang`, `_score` and `_ambiguous` appended.

    A text that is missing or has no letter is `und` with score 0 (and so is every text where no
    language was learned). Rows are judged one by one.
    """
    small_batches(docs.sparkSession)
    columns = docs.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in rows_of(frames):
            texts = frame["text"].tolist()
            known = np.array([has_letter(t) for t in texts], dtype=bool) & bool(model.languages)
            lang = np.full(len(texts), UNKNOWN, dtype=object)
            score, unsure = np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
            if known.any():
                margins = model.margins([t for t, k in zip(texts, known, strict=True) if k])
                best, score[known], unsure[known] = model.decode(margins)
                lang[known] = np.array(model.languages, dtype=object)[best]
            yield frame[columns].assign(_lang=lang, _score=score, _ambiguous=unsure)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    source = docs if text_col == "text" else docs.withColumn("text", F.col(f"`{text_col}`"))
    return source.mapInPandas(run, f"{kinds}, _lang string, _score double, _ambiguous boolean")


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = 4,
    held: int = 2,
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous): fold `held` of `folds` is not learned from."""
    rows = pick(docs, doc_id=id_col, text=text_col, lang=lang_col)
    model = fit(rows.where(fold(F.col("doc_id"), folds) != held))
    found = predict(rows.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        (fold(F.col("doc_id"), folds) == held).alias("held_out"),
        F.col("_lang").alias("lang_pred"),
        F.col("_score").alias("score"),
        F.col("_ambiguous").alias("ambiguous"),
    )
