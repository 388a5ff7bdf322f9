"""Periodic runs of words in whole texts: stretches in which the words repeat with one period.

A run is a maximal stretch of consecutive words with smallest period q (words q apart are equal)
whose length is at least `least_length` and at least four periods. All runs of a text are found
exactly, at several scales:

* periods below `SHORT` come from direct scans, one per lag: the stretches of positions whose word
  equals the word that many places later;
* periods in [w, 2w) come from minimizers of scale w, for w = SHORT, 2 SHORT, 4 SHORT, ... Every
  position stands for the 2w words from there on (a number that names equal stretches). It is a
  minimizer if it has the least hash in some window of w positions. Inside a run of period q in
  [w, 2w) two positions have equal words exactly if they lie a multiple of q apart, because the 2w
  words are longer than the period; and as the run holds four periods, the minimum of its first
  window comes again, as a minimum, q places later. So two neighbouring positions of one minimizer
  stand at distance q. Such pairs are the seeds; a seed is extended word by word both ways.

The extension compares the words themselves, so a clash of hashes costs time and never a result. A
seed's 2w words reach past the next occurrence, so every seed lies in a stretch of two periods or
more, and each such stretch is extended once.

The texts of a batch are laid end to end, each behind a separator of its own that equals nothing,
longest text first: those long enough for a scale are a prefix. A batch holds a bounded number of
characters (one longer text makes its own); the work grows with the words times the number of scales.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.llm.shared import pick, rows_of, small_batches, text_of

SHORT = 8
PERIODS = 4
LEAST_LENGTH = 6
BATCH_CHARS = 4_000_000

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_RUN = "start long, length long, period long"
_SCHEMA = f"doc_id long, n_words long, runs array<struct<{_RUN}>>, collapsed string"
_EVEN, _ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def _mixed(values: np.ndarray) -> np.ndarray:
    """Numbers scattered over 64 bits."""
    values = (values ^ (values >> np.uint64(32))) * _EVEN
    return values ^ (values >> np.uint64(29))


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each stretch of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], same.view(np.int8), [0]))))
    return edges[::2], edges[1::2]


def _sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The best value of every window of `width`, by prefixes and suffixes of blocks of that width."""
    n = len(values)
    pad = -n % width
    blocks = np.concatenate((values, np.repeat(values[-1:], pad))).reshape(-1, width)
    ahead = best.accumulate(blocks, axis=1).ravel()
    behind = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[: n - width + 1], ahead[width - 1 : n])


def _seeds(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) of neighbouring equal minimizers at a distance in [width, 2 * width)."""
    if len(hashes) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = _sliding(hashes, width, np.minimum)
    # The greatest minimum of the windows that hold a position: those at the ends are fewer.
    edge = np.zeros(width - 1, np.uint64)
    greatest = _sliding(np.concatenate((edge, least, edge)), width, np.maximum)
    at = np.flatnonzero(hashes == greatest)
    order = at[np.argsort(hashes[at], kind="stable")]
    distance = np.diff(order)
    near = (hashes[order[1:]] == hashes[order[:-1]]) & (distance >= width) & (distance < 2 * width)
    return order[:-1][near], distance[near]


def _reach(words: np.ndarray, a: int, b: int, step: int) -> int:
    """How many words from a and b on (b > a), in direction `step`, are pairwise equal."""
    n, size = 0, 64
    while True:
        if step > 0:
            x, y = words[a + n : a + n + size], words[b + n : b + n + size]
            x = x[: len(y)]
        else:
            x = words[max(0, a - n - size + 1) : max(0, a - n + 1)][::-1]
            y = words[max(0, b - n - size + 1) : max(0, b - n + 1)][::-1][: len(x)]
        differ = np.flatnonzero(x != y)
        if len(differ):
            return n + int(differ[0])
        if len(x) < size:
            return n + len(x)
        n, size = n + size, 2 * size


def runs_in(words: np.ndarray, lengths: np.ndarray, least_length: int = LEAST_LENGTH) -> np.ndarray:
    """All runs of several texts as rows (begin, end, period), begin and end in `words`.

    `words` holds the texts one after the other in descending length, each followed by a number
    that occurs once; `lengths` has the number of words of each.
    """
    found: dict[tuple[int, int], int] = {}

    def keep(begin: int, end: int, period: int) -> None:
        if end - begin >= max(least_length, PERIODS * period):
            found[begin, end] = min(period, found.get((begin, end), period))

    ends = np.cumsum(lengths + 1)

    def long_enough(length: int) -> np.ndarray:
        texts = int(np.searchsorted(-lengths, -length, side="right"))
        return words[: ends[texts - 1]] if texts else words[:0]

    for lag in range(1, SHORT):
        least = max(least_length, PERIODS * lag)
        part = long_enough(least)
        if len(part) <= lag:
            break
        begins, stops = _stretches(part[lag:] == part[:-lag])
        whole = stops + lag - begins >= least
        for begin, end in zip(begins[whole].tolist(), (stops[whole] + lag).tolist(), strict=True):
            keep(begin, end, lag)

    width, grams = 1, _mixed(words.astype(np.uint64) * _ODD)
    while True:
        # Names of twice as many words from the names of two neighbours.
        part = long_enough(max(PERIODS * width, 1))
        if len(part) < 2 * width:
            break
        grams = grams[: len(part) - width + 1]
        grams = _mixed(grams[:-width] * _ODD + grams[width:])
        if width >= SHORT:
            positions, periods = _seeds(grams, width)
            last: dict[int, int] = {}
            for at, period in sorted(zip(positions.tolist(), periods.tolist(), strict=True)):
                if last.get(period, -1) > at:
                    continue
                begin = at - _reach(words, at - 1, at + period - 1, -1) if at else 0
                end = at + period + _reach(words, at, at + period, 1)
                last[period] = end - period
                keep(begin, end, period)
        width *= 2
    return np.array([(b, e, q) for (b, e), q in sorted(found.items())], np.int64).reshape(-1, 3)


def _of_batch(
    frame: pd.DataFrame, edit: Callable[[object, int], np.ndarray | None] | None, least: int
) -> pd.DataFrame:
    texts = [_WORD.findall(text_of(t)) for t in frame["text"]]
    if edit:
        for k, doc in enumerate(frame["doc_id"]):
            places = edit(None if pd.isna(doc) else int(doc), len(texts[k]))
            if places is not None:
                texts[k] = [texts[k][p] for p in places.tolist()]
    lengths = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-lengths, kind="stable")
    flat = np.array([w for k in order for w in texts[k]], dtype=object)
    codes = pd.factorize(flat)[0] if len(flat) else np.zeros(0, np.int64)
    starts = np.cumsum(lengths[order] + 1) - lengths[order] - 1
    words = np.arange(len(codes) + len(order), dtype=np.int64) + len(codes)
    inside = np.ones(len(words), bool)
    inside[starts + lengths[order]] = False
    words[inside] = codes
    runs = runs_in(words, lengths[order], least)
    owner = np.searchsorted(starts, runs[:, 0], side="right") - 1
    drop = np.zeros(len(words) + 1, np.int64)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 1], -1)
    dropped = np.cumsum(drop[:-1]) > 0
    by_text: dict[int, list[dict]] = {}
    for (begin, end, period), k in zip(runs.tolist(), owner.tolist(), strict=True):
        by_text.setdefault(k, []).append(
            {"start": begin - int(starts[k]), "length": end - begin, "period": period}
        )
    found: list[list[dict]] = [[] for _ in texts]
    collapsed = [""] * len(texts)
    for place, k in enumerate(order.tolist()):
        kept = texts[k]
        if place in by_text:
            found[k] = sorted(by_text[place], key=lambda r: (r["start"], r["period"]))
            own = dropped[starts[place] : starts[place] + lengths[k]].tolist()
            kept = [w for w, gone in zip(kept, own, strict=True) if not gone]
        collapsed[k] = " ".join(kept)
    ids = frame["doc_id"].array
    return pd.DataFrame({"doc_id": ids, "n_words": lengths, "runs": found, "collapsed": collapsed})


def find_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    edit: Callable[[object, int], np.ndarray | None] | None = None,
    least_length: int = LEAST_LENGTH,
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) per row of `docs`: all runs of its words, by start.

    `runs` holds (start, length, period) with the word number of the first word; `collapsed` is the
    text without the words that a run has after its first period, joined by one space. `edit` may
    name, by id and number of words, the places whose words the text consists of instead.

    Every row gives one row: null and empty texts have no words and no runs, repeated rows give
    equal results, an id may be null, a table without rows gives none; other columns are not read.
    """
    small_batches(docs.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in rows_of(frames, BATCH_CHARS):
            yield _of_batch(frame.reset_index(drop=True), edit, least_length)

    return pick(docs, doc_id=id_col, text=text_col).mapInPandas(run, _SCHEMA)


def repeated_tail(doc_id: object, n: int) -> np.ndarray | None:
    """The places of an edited text: of every tenth id (by its hash) the tail repeats a part.

    A null id and a text without words are not edited.
    """
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def _best(runs: Column) -> Column:
    """The run with the greatest length / period, compared as whole numbers; ties: start, period."""
    none = F.lit(None).cast(f"struct<{_RUN.replace(' long', ':bigint')}>")

    def better(best: Column, run: Column) -> Column:
        mine = run["length"].cast("decimal(19,0)") * best["period"].cast("decimal(19,0)")
        yours = best["length"].cast("decimal(19,0)") * run["period"].cast("decimal(19,0)")
        # Runs come by start, then period: an equal one comes too late.
        return F.when(best.isNull() | (mine > yours), run).otherwise(best)

    return F.aggregate(runs, none, better)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document of the edited texts: its best run and hashes of all runs and of what is kept."""
    found = find_runs(docs, id_col, text_col, repeated_tail)
    lines = F.transform(
        "runs",
        lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")),
    )
    best = found.withColumn("best", _best(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
