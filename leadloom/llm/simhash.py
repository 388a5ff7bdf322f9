"""SimHash near-duplicates through an inverted index of byte positions with count filtering.

Two 64-bit fingerprints that differ in at most three bits differ in at most three of their eight
bytes: they share at least five *positional bytes*. A list per single positional byte would hold a
256th of all fingerprints, and tallying its pairs would be quadratic. The index therefore keys each
distinct fingerprint by every group of five of its eight positional bytes (56 keys): a pair that
reaches the guaranteed minimum of shared bytes meets under at least one key, and no pair below the
minimum is ever formed. Where a pair meets, its shared positional bytes are tallied; the pair is
kept under the first of its common keys only, and its bits are counted.

A key holds three free bytes, so its list is bounded (2**24 fingerprints) and is read as a sorted
stream. Up to `most_listed` fingerprints of a key are compared with each other. The members of a
longer list go another, exact way: every fingerprint writes itself under all values at a distance
of at most two bits; two members within three bits have a value within one bit of the one and two
bits of the other. All that meet under a value which has a member within one bit are linked to that
member, a star instead of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm.components import components
from leadloom.llm.shared import pick, small_batches, text_of
from leadloom.session import materialise

SEED = 42
BYTES = 8
MAX_BITS = 3
SHARED = BYTES - MAX_BITS
GROUPS = list(combinations(range(BYTES), SHARED))
_CHUNK = 1 << 15


def fingerprint(text: str | None, words: int = 3) -> int:
    """SimHash of the word shingles of a text (repeats count), as an unsigned 64-bit number.

    ASCII letters are lower-cased, words are separated by ASCII white space. A text of fewer words
    is one shingle; a text without words, or no text, has fingerprint 0.
    """
    parts = text_of(text).encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    n = max(1, len(parts) - words + 1)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, n, _CHUNK):
        stop = min(n, start + _CHUNK)
        hashes = np.array(
            [xxhash.xxh64_intdigest(b" ".join(parts[i : i + words]), SEED) for i in range(start, stop)],
            dtype="<u8",
        )
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): one row per document, fp the fingerprint's bits as a signed long."""
    small_batches(docs.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = np.array([fingerprint(t) for t in frame["text"]], dtype="<u8")
            yield pd.DataFrame({"doc_id": frame["doc_id"], "fp": values.view("<i8")})

    source = pick(docs, doc_id=id_col, text=text_col)
    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInPandas(run, f"doc_id {id_type}, fp long")


def _keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each fingerprint (rows) its key under each group of positions (columns), and the groups.

    The group's number stands in the upper bytes, the five shared bytes below it.
    """
    parts = fp.view(np.uint8).reshape(-1, BYTES).astype(np.int64)
    keys = np.empty((len(fp), len(GROUPS)), dtype=np.int64)
    for g, group in enumerate(GROUPS):
        key = np.full(len(fp), g, dtype=np.int64)
        for position in group:
            key = (key << 8) | parts[:, position]
        keys[:, g] = key
    return keys, np.arange(len(GROUPS))


def _postings(distinct: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False), dtype="<i8")
            for start in range(0, len(fp), 10_000):
                part = fp[start : start + 10_000]
                keys, _ = _keys(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), pa.array(np.repeat(part, len(GROUPS)))], ["key", "fp"]
                )

    return distinct.select("fp").mapInArrow(run, "key long, fp long")


def _first_group() -> np.ndarray:
    """For every set of shared positions (as bits) the number of the group it is kept under."""
    number = {group: g for g, group in enumerate(GROUPS)}
    first = np.full(1 << BYTES, -1, dtype=np.int64)
    for shared in range(1 << BYTES):
        positions = [p for p in range(BYTES) if shared >> p & 1]
        if len(positions) >= SHARED:
            first[shared] = number[tuple(positions[:SHARED])]
    return first


_FIRST = _first_group()
_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.int64)


def _verified(key: np.ndarray, a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Which pairs stand under the first of their common keys and differ in few enough bits."""
    differing = (a ^ b).view(np.uint8).reshape(-1, BYTES)
    shared = ((differing == 0).astype(np.int64) << np.arange(BYTES)).sum(axis=1)
    return (_FIRST[shared] == key >> (8 * SHARED)) & (_ONES[differing].sum(axis=1) <= max_bits)


def _meet(keys: np.ndarray, fps: np.ndarray, max_bits: int, most: int) -> Iterator[tuple]:
    """(a, b) links and (a, a) marks for members of long lists; keys are sorted and whole."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    size = np.repeat(sizes, sizes)
    crowded = np.unique(fps[size > most])
    if len(crowded):
        yield crowded, crowded
    keep = size <= most
    keys, fps = keys[keep], fps[keep]
    left = np.arange(len(keys) - 1) if len(keys) else np.empty(0, dtype=np.int64)
    step = 1
    while len(left):
        left = left[left + step < len(keys)]
        left = left[keys[left] == keys[left + step]]
        good = left[_verified(keys[left], fps[left], fps[left + step], max_bits)]
        if len(good):
            yield fps[good], fps[good + step]
        step += 1


def _candidates(distinct: DataFrame, max_bits: int, most: int) -> DataFrame:
    postings = _postings(distinct)
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = postings.repartition(parts, "key").sortWithinPartitions("key", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_k, rest_f = np.empty(0, dtype="<i8"), np.empty(0, dtype="<i8")
        marked = None

        def out(found: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
            for a, b in found:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            k = np.r_[rest_k, batch.column(0).to_numpy(zero_copy_only=False)].astype("<i8")
            f = np.r_[rest_f, batch.column(1).to_numpy(zero_copy_only=False)].astype("<i8")
            if marked is not None and k[0] == marked:
                # A list already known to be long goes on: its members are marked, none is kept.
                n = int(np.searchsorted(k, marked, side="right"))
                yield from out(iter([(f[:n], f[:n])]))
                k, f = k[n:], f[n:]
            cut = int(np.searchsorted(k, k[-1], side="left")) if len(k) else 0
            if cut:
                marked = None
                yield from out(_meet(k[:cut], f[:cut], max_bits, most))
            rest_k, rest_f = k[cut:], f[cut:]
            if len(rest_k) > most:
                marked = rest_k[0]
                yield from out(iter([(rest_f, rest_f)]))
                rest_k, rest_f = rest_k[:0], rest_f[:0]
        if len(rest_k):
            yield from out(_meet(rest_k, rest_f, max_bits, most))

    return dealt.mapInArrow(run, "a long, b long")


def _ball(max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Masks of up to ceil(max_bits / 2) flipped bits and how many each flips."""
    reach = (max_bits + 1) // 2
    masks, flips = [0], [0]
    for n in range(1, reach + 1):
        for bits in combinations(range(64), n):
            masks.append(sum(1 << b for b in bits))
            flips.append(n)
    return np.array(masks, dtype="<u8").view("<i8"), np.array(flips, dtype=np.int32)


def _crowded_links(crowded: DataFrame, max_bits: int) -> DataFrame:
    """Star links among the members of long lists, complete for every pair within `max_bits`."""
    near = max_bits // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks, flips = _ball(max_bits)
        for batch in batches:
            for fp in batch.column(0).to_numpy(zero_copy_only=False):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(masks ^ fp), pa.array(np.full(len(masks), fp)), pa.array(flips)],
                    ["value", "fp", "flips"],
                )

    spread = crowded.select("a").mapInArrow(run, "value long, fp long, flips int")
    hubs = (
        spread.where(F.col("flips") <= near)
        .groupBy("value")
        .agg(F.min("fp").alias("hub"))
        .select((F.col("value") + F.lit(0)).alias("value"), "hub")
    )
    return (
        spread.join(hubs, "value")
        .where("fp <> hub")
        .select(F.least("fp", "hub").alias("a"), F.greatest("fp", "hub").alias("b"))
        .distinct()
    )


def links(
    distinct: DataFrame, max_bits: int = MAX_BITS, most_listed: int = 256
) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints connected by pairs within `max_bits`.

    `distinct` has one row per fingerprint in column `fp`. Pairs from lists of up to `most_listed`
    are all returned; the members of longer lists are linked by stars (see the module's text).
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the index guarantees pairs of at most {MAX_BITS} differing bits")
    found = materialise(_candidates(distinct, max_bits, most_listed), "simhash-links")
    crowded = found.where("a = b").select("a").distinct()
    return found.where("a <> b").unionByName(_crowded_links(crowded, max_bits))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_bits: int = MAX_BITS,
    most_listed: int = 256,
) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per input row.

    `component_id` is the smallest id reachable over links of at most `max_bits` differing bits,
    the document's own included. Rows of equal text have one fingerprint and one component, also
    rows without text (fingerprint zero). A missing id takes part in no minimum; a component of
    such rows alone has none. An empty table gives an empty result.
    """
    prints = materialise(fingerprints(docs, id_col, text_col), "simhash-prints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    joined = components(links(classes, max_bits, most_listed))
    named = classes.join(joined.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_print = named.join(least, "component").select(
        (F.col("fp") + F.lit(0)).alias("fp"), "component_id"
    )
    return prints.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
