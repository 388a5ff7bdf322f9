"""Benchmark decontamination by suffix arrays over the documents.

Words are runs of ASCII letters (lower-cased), digits and all characters beyond ASCII. Each shard (a
batch of documents within one task) gets a suffix array: the starts of all words, sorted by the ten
words from there on. A word that no test item contains cannot be part of a match, so it ends every
suffix, and stretches shorter than the shortest window are left out of the array. Every test suffix
is looked up by binary search, which yields the range of all places with that window; places of one
item that continue each other are joined to the longest verbatim matches.

The test set is held in blocks of bounded size; a further block passes over the documents in the
same task, after the first, and adds its matches. Documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.llm.shared import pick, rows_of, small_batches, text_of

WINDOW = 10
BLOCK_CHARS = 4_000_000
_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_TABLE = bytes(
    0x20 if b in _SEPARATORS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)
)


def words(text: object) -> list[bytes]:
    """The words of a text, lower-cased in ASCII."""
    return text_of(text).encode("utf-8", "surrogatepass").translate(_TABLE).split()


class Tests:
    """The windows of one block of test items, as rows of word numbers."""

    def __init__(self, items: list[tuple[object, object]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        rows, lengths, owners, places = [], [], [], []
        self.names: list[str] = []
        for name, text in items:
            parts = words(text)
            if not parts:
                continue
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in parts]
            size = min(window, len(numbers))
            for place in range(len(numbers) - size + 1):
                rows.append(numbers[place : place + size] + [0] * (window - size))
                lengths.append(size)
                owners.append(len(self.names))
                places.append(place)
            self.names.append(str(name))
        self.rows = np.array(rows, dtype=">u4").reshape(-1, window)
        self.lengths = np.array(lengths, dtype=np.int64)
        self.owners = np.array(owners, dtype=np.int64)
        self.places = np.array(places, dtype=np.int64)
        self.shortest = int(self.lengths.min()) if len(rows) else window

    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """Smallest and largest suffix that begins with each window, as byte strings."""
        beyond = np.arange(self.window) >= self.lengths[:, None]
        high = np.where(beyond, 0xFFFFFFFF, self.rows).astype(">u4")
        kind = f"S{4 * self.window}"
        return (
            np.ascontiguousarray(self.rows).view(kind).ravel(),
            np.ascontiguousarray(high).view(kind).ravel(),
        )


def suffix_array(numbers: np.ndarray, window: int, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts sorted by the `window` numbers from there on, and these as sorted byte strings.

    A zero ends a suffix. Starts with fewer than `shortest` numbers before the next zero are left
    out: no window fits there.
    """
    n = len(numbers)
    index = np.arange(n)
    left = np.minimum.accumulate(np.where(numbers == 0, index, n)[::-1])[::-1] - index
    starts = np.flatnonzero(left >= max(1, shortest))
    columns = np.zeros((len(starts), window), dtype=">u4")
    for k in range(window):
        inside = left[starts] > k
        columns[inside, k] = numbers[starts[inside] + k]
    keys = columns.view(f"S{4 * window}").ravel()
    order = np.argsort(keys, kind="stable")
    return starts[order], keys[order]


def matches(numbers: np.ndarray, tests: Tests) -> tuple[np.ndarray, np.ndarray]:
    """(window, place): every place of every test window in the shard."""
    starts, keys = suffix_array(numbers, tests.window, tests.shortest)
    if not len(starts) or not len(tests.rows):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    low, high = tests.bounds()
    first = np.searchsorted(keys, low, side="left")
    last = np.searchsorted(keys, high, side="right")
    count = np.maximum(0, last - first)
    which = np.repeat(np.arange(len(count)), count)
    inside = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    return which, starts[first[which] + inside]


def _joined(item: np.ndarray, place: np.ndarray, size: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Matches joined along items: rows (item, item word, text word, words), maximal and sorted."""
    order = np.lexsort((at, at - place, item))
    item, place, size, at = item[order], place[order], size[order], at[order]
    new = np.r_[
        True,
        (item[1:] != item[:-1]) | ((at - place)[1:] != (at - place)[:-1]) | (at[1:] > at[:-1] + 1),
    ]
    group = np.cumsum(new) - 1
    end = np.zeros(group[-1] + 1, dtype=np.int64)
    np.maximum.at(end, group, at + size)
    first = np.flatnonzero(new)
    return np.c_[item[first], place[first], at[first], end - at[first]]


def _shard(texts: list, tests: Tests) -> tuple[np.ndarray, list[np.ndarray]]:
    """Number of words of each text, and its joined matches (places within the text)."""
    get = tests.vocabulary.get
    parts, sizes = [], np.zeros(len(texts), dtype=np.int64)
    for k, text in enumerate(texts):
        found = words(text)
        sizes[k] = len(found)
        parts.append(np.fromiter(map(get, found, repeat(0)), dtype=np.uint32, count=len(found)))
        parts.append(np.zeros(1, dtype=np.uint32))
    numbers = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint32)
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    which, at = matches(numbers, tests)
    owner = np.searchsorted(begins, at, side="right") - 1
    found = [None] * len(texts)
    if not len(owner):
        return sizes, found
    order = np.argsort(owner, kind="stable")
    which, at, owner = which[order], at[order], owner[order]
    edges = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    for begin, end in zip(edges, [*edges[1:], len(owner)], strict=True):
        text, w = owner[begin], which[begin:end]
        found[text] = _joined(
            tests.owners[w], tests.places[w], tests.lengths[w], at[begin:end] - begins[text]
        )
    return sizes, found


_MATCH = "struct<item:string,item_word:long,word:long,words:long>"


def _pass(docs: DataFrame, tests: Tests, columns: list[str]) -> DataFrame:
    """The documents with the matches of one block of tests appended to `_matches`."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in rows_of(frames):
            sizes, found = _shard(frame["text"].tolist(), tests)
            old = frame["_matches"] if "_matches" in frame else [()] * len(frame)
            new = []
            for before, table in zip(old, found, strict=True):
                rows = [] if before is None else list(before)
                for item, place, at, n in [] if table is None else table.tolist():
                    rows.append(
                        {"item": tests.names[item], "item_word": place, "word": at, "words": n}
                    )
                new.append(rows)
            out = frame[columns].copy()
            out["_n_words"] = sizes
            out["_matches"] = new
            yield out

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(columns).schema)
    return docs.mapInPandas(run, f"{kinds}, _n_words long, _matches array<{_MATCH}>")


def _blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple]]:
    """The test items in blocks of about `block_chars`, one block on the driver at a time."""
    size = F.coalesce(F.length("text"), F.lit(0))
    total = benchmark.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    n = max(1, -(-int(total) // block_chars))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        yield [tuple(r) for r in benchmark.where(part == k).select("item_id", "text").collect()]


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows of `docs` with `_n_words` and `_matches` (item, item_word, word, words).

    Each match is a longest verbatim stretch of an item in the text, of at least one window (ten
    words, or the whole item if it has fewer; an item without words has none). Missing texts have
    no words. Rows are handled one by one, so repeated rows and ids do no harm; an empty table on
    either side gives no matches.
    """
    small_batches(docs.sparkSession)
    columns = docs.columns
    items = pick(benchmark, item_id=item_col, text=item_text_col)
    found = docs.withColumn("text", F.col(f"`{text_col}`")) if text_col != "text" else docs
    for block in _blocks(items, block_chars):
        wanted = columns if text_col == "text" else [*columns, "text"]
        found = _pass(found, Tests(block, window), wanted)
    return found.select(*[F.col(f"`{c}`") for c in columns], "_n_words", "_matches")


def covered(found: str = "_matches") -> Column:
    """Number of different words that lie inside any match."""
    spans = F.array_sort(F.transform(found, lambda m: F.struct(m.word.alias("a"), (m.word + m.words).alias("b"))))
    zero = F.lit(0).cast("long")
    start = F.struct(zero.alias("n"), zero.alias("end"))
    step = lambda s, m: F.struct(
        (s.n + F.greatest(zero, m.b - F.greatest(m.a, s.end))).alias("n"),
        F.greatest(s.end, m.b).alias("end"),
    )
    return F.aggregate(spans, start, step, lambda s: s.n)


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest, matches)."""
    rows = scan(pick(docs, doc_id=id_col, text=text_col), benchmark, **options)
    names = F.array_sort(F.array_distinct(F.transform("_matches", lambda m: m["item"])))
    hit = covered()
    return rows.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"),
        (F.size("_matches") > 0).alias("contaminated"),
        F.coalesce(F.array_max(F.transform("_matches", lambda m: m.words)), F.lit(0)).alias("longest"),
        F.col("_matches").alias("matches"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents without those that hold a window of a test item; any other columns stay."""
    # Columns of the documents may have the names used here, so they travel under numbers.
    numbered = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    text = f"c{docs.columns.index(text_col)}"
    kept = scan(numbered, benchmark, text_col=text, **options).where(F.size("_matches") == 0)
    return kept.select(*numbered.columns).toDF(*docs.columns)
