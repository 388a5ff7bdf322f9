"""Homomorphic multiset fingerprints of documents, with DataFrame functions only.

A document is the multiset of its paragraphs (lines). Each paragraph becomes a wide vector and the
fingerprint is the sum of these vectors, lane by lane, modulo a power of two. Order therefore does
not matter, and a paragraph is inserted or deleted by adding or subtracting its vector (`combine`).

The vector of a paragraph has two parts:

* eight lanes modulo 2**32, each from a hash of the whole paragraph: they decide equality;
* 128 lanes that count bits of the hashes of the paragraph's sentences, two lanes packed into one
  number modulo 2**60. They are a linear sketch of the multiset of sentences: with S a lane's count
  and n the number of sentences, the values 2S - n of two texts have a cosine that estimates how
  much the two multisets have in common (error about 1 / sqrt(128)).

A last lane counts the sentences modulo 2**60. Lanes of the sketch hold up to 2**30 - 1 sentences;
beyond that they run into each other, which leaves equality right and makes likeness less exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadloom.llm.shared import pick

WIDE = 8
FIELDS = 2
FIELD_BITS = 30
SKETCH = 128
PACKED = -(-SKETCH // FIELDS)
_WIDE_MOD = 1 << 32
_PACKED_MOD = 1 << (FIELDS * FIELD_BITS)
_LANES = [f"w{i}" for i in range(WIDE)] + [f"s{i}" for i in range(PACKED)] + ["n"]


def _digits(name: str) -> int:
    return 8 if name.startswith("w") else 15


def _modulus(name: str) -> int:
    return _WIDE_MOD if name.startswith("w") else _PACKED_MOD


def units(text: Column) -> Column:
    """The sentences of all paragraphs as (first, paragraph hash seed, sentence) structs.

    Every paragraph, also an empty one, has at least one sentence; `paragraph` is set on its first
    sentence only, where the paragraph's own lanes are added.
    """
    paragraphs = F.split(text, "\n", -1)
    return F.flatten(
        F.transform(
            paragraphs,
            lambda p: F.transform(
                F.split(p, r"(?<=[.!?]) ", -1),
                lambda s, i: F.struct(F.when(i == 0, p).alias("paragraph"), s.alias("sentence")),
            ),
        )
    )


def _lane_sums() -> list[Column]:
    """The sum of the vectors of a group's units (columns `paragraph` and `sentence`).

    A unit adds at most 2**30 + 1 to a packed lane, so the sums of 2**32 units fit 63 bits.
    """
    sums = []
    for half in range(WIDE // 2):
        # A single-column hash of a missing paragraph would be the seed: those add nothing.
        value = F.xxhash64(F.lit(half), F.col("paragraph"))
        low = F.when(F.col("paragraph").isNotNull(), value.bitwiseAND(F.lit(_WIDE_MOD - 1)))
        high = F.when(F.col("paragraph").isNotNull(), F.shiftrightunsigned(value, 32))
        sums += [F.sum(low).alias(f"w{2 * half}"), F.sum(high).alias(f"w{2 * half + 1}")]
    for k in range(PACKED):
        packed = None
        for j in range(FIELDS):
            lane = k * FIELDS + j
            if lane >= SKETCH:
                break
            bit = F.shiftrightunsigned(F.col(f"h{lane // 64}"), lane % 64).bitwiseAND(F.lit(1))
            field = F.shiftleft(bit, j * FIELD_BITS)
            packed = field if packed is None else packed + field
        sums.append(F.sum(packed).alias(f"s{k}"))
    return [*sums, F.count(F.lit(1)).alias("n")]


def _summed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The lanes per `keys` of rows with `paragraph` and `sentence`."""
    sums = _hashed(rows).groupBy(*keys).agg(*_lane_sums())
    return sums.withColumns({x: F.pmod(F.col(x), F.lit(_modulus(x))) for x in _LANES})


def _hashed(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {f"h{i}": F.xxhash64(F.lit(101 + i), F.col("sentence")) for i in range(SKETCH // 64)}
    )


def lanes_of(df: DataFrame, keys: list[str], text: Column) -> DataFrame:
    """One row per distinct `keys` with the fingerprint's lanes; `text` must not be null.

    The sums are partial sums per task before any shuffle, so a text of any length leaves one row.
    """
    rows = df.select(*keys, F.explode(units(text)).alias("unit")).select(*keys, "unit.*")
    return _summed(rows, keys)


def encode(lane: object = F.col) -> Column:
    """The lanes as one hex string; `lane` gives the column of a lane's name."""
    return F.concat(*[F.lower(F.lpad(F.hex(lane(x)), _digits(x), "0")) for x in _LANES])


def decode(fingerprint: Column) -> dict[str, Column]:
    """The lanes of a hex string."""
    lanes, at = {}, 1
    for name in _LANES:
        digits = F.substring(fingerprint, at, _digits(name))
        lanes[name] = F.conv(digits, 16, 10).cast("long")
        at += _digits(name)
    return lanes


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint of two multisets together, or of `a` without the paragraphs of `b`.

    The result for `sign=-1` is meaningful where `b` is contained in `a`.
    """
    x, y = decode(a), decode(b)
    sums = {n: F.pmod(x[n] + F.lit(sign) * y[n], F.lit(_modulus(n))) for n in _LANES}
    return encode(lambda name: sums[name])


def _field(lane: object, k: int, j: int) -> Column:
    return F.shiftrightunsigned(lane(f"s{k}"), j * FIELD_BITS).bitwiseAND(
        F.lit((1 << FIELD_BITS) - 1)
    )


def _signed(lane: object) -> Column:
    """The sketch as an array of doubles: twice the lane's count less the number of sentences."""
    values = []
    for i in range(SKETCH):
        values.append((2 * _field(lane, i // FIELDS, i % FIELDS) - lane("n")).cast("double"))
    return F.array(*values)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def likeness(a: str, b: str) -> Column:
    """Cosine of the sketches of two structs (fingerprint, sketch), within 0 and 1.

    Equal fingerprints have likeness 1; sketches without any direction have likeness 0 else.
    """
    x, y = F.col(f"{a}.sketch"), F.col(f"{b}.sketch")
    norm = F.sqrt(_dot(x, x) * _dot(y, y))
    cosine = F.when(norm > 0, _dot(x, y) / norm).otherwise(0.0)
    same = F.col(f"{a}.fingerprint") == F.col(f"{b}.fingerprint")
    return F.when(same, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))


def fingerprint_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint): one row per input row; a null text counts as empty."""
    source = pick(docs, doc_id=id_col, text=text_col).withColumn("uid", F.uuid())
    text = F.coalesce(F.col("text"), F.lit(""))
    return lanes_of(source, ["uid", "doc_id"], text).select("doc_id", encode().alias("fingerprint"))


def _bounds(ids: DataFrame, per_range: int) -> list[list[int]]:
    """Upper ends of ranges of ids with about `per_range` rows each, in two levels.

    Taken from a mergeable quantile sketch over all ids; what reaches the driver are the ends.
    """
    n = ids.count()
    ranges = max(1, -(-n // per_range))
    if ranges == 1:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    ends = ids.agg(F.percentile_approx("doc_id", shares, max(10_000, 4 * ranges))).first()[0] or []
    ends = sorted(set(ends))
    step = max(1, int(len(ends) ** 0.5))
    return [ends[i : i + step] for i in range(0, len(ends), step)]


def _range_of(bounds: list[list[int]]) -> Column:
    """Number of the range that an id lies in: two short searches in literal arrays."""
    if not bounds:
        return F.lit(0)
    smaller = lambda ends: F.size(F.filter(ends, lambda end: end < F.col("doc_id")))
    tops = F.array(*[F.lit(part[-1]) for part in bounds])
    blocks = F.array(*[F.array(*[F.lit(x) for x in part]) for part in [*bounds, []] if part])
    block = smaller(tops)
    inside = F.get(blocks, block)
    width = len(bounds[0])
    return F.when(F.col("doc_id").isNull(), 0).otherwise(
        block * width + F.when(inside.isNull(), 0).otherwise(smaller(inside))
    )


def edited_neighbours(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_range: int = 2000
) -> DataFrame:
    """Fingerprints of texts, of their edited versions, and how alike they and their followers are.

    The edited text has its last floor(n / 2) code points replaced by as many first ones of the
    next document in ascending id order (all of it if shorter; after the last comes the first).
    Rows of equal id follow each other by text; a missing id comes first. Null texts are empty.
    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The texts are shuffled once, by ranges of ids of about `per_range` rows; followers, lanes and
    likeness are computed inside a range. Only the first row of each range is fetched by the range
    before it. A range has a bounded number of rows, so no key can gather a share of the table.
    """
    source = pick(docs, doc_id=id_col, text=text_col).withColumn(
        "text", F.coalesce("text", F.lit(""))
    )
    placed = source.withColumn("range", _range_of(_bounds(source.select("doc_id"), per_range)))
    rows = placed.withColumn("guest", F.lit(False)).unionByName(_guests(placed))
    in_order = Window.partitionBy("range").orderBy("guest", "doc_id", "text")
    rows = rows.withColumn("row", F.row_number().over(in_order)).withColumn(
        "next_text", F.lead("text").over(in_order)
    )
    n_chars = F.length("text")
    half = (n_chars - n_chars % 2) / 2
    half = half.cast("int")
    edited = F.concat(
        F.expr("substring(text, 1, n_chars - half)"), F.expr("substring(next_text, 1, half)")
    )
    rows = rows.select(
        "range", "guest", "row", "doc_id", n_chars.alias("n_chars"), half.alias("half"),
        "text", "next_text",
    )
    rows = rows.withColumn("edited", F.when(~F.col("guest"), edited)).withColumn(
        "edited_sha256", F.sha2("edited", 256)
    )
    keys = ["range", "guest", "row", "doc_id", "n_chars", "edited_sha256"]
    versions = rows.select(
        *keys, F.posexplode(F.array_compact(F.array("text", "edited"))).alias("version", "text")
    )
    lanes = lanes_of(versions, [*keys, "version"], F.col("text"))
    sketched = lanes.select(
        *keys,
        "version",
        F.struct(encode().alias("fingerprint"), _signed(F.col).alias("sketch")).alias("own"),
    )
    # A document's rows: its text, then its edited text; the next document's text follows.
    along = Window.partitionBy("range").orderBy("guest", "row", "version")
    known = sketched.withColumns(
        {"other": F.lead("own", 1).over(along), "next": F.lead("own", 2).over(along)}
    ).where("version = 0 AND NOT guest")
    return known.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        F.col("own.fingerprint").alias("fingerprint"),
        F.col("other.fingerprint").alias("edited_fingerprint"),
        likeness("own", "other").alias("near_edited"),
        likeness("own", "next").alias("near_next"),
    )


def _guests(placed: DataFrame) -> DataFrame:
    """The first row of each range once more, as the last row of the range before it.

    After the last range comes the first. One narrow row per range is ordered in one task.
    """
    heads = placed.groupBy("range").agg(F.min(F.struct("doc_id")).alias("head"))
    along = Window.orderBy("range")
    circle = Window.orderBy("range").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    before = heads.select(
        F.col("head.doc_id").alias("head_id"),
        F.coalesce(F.lag("range").over(along), F.last("range").over(circle)).alias("host"),
    )
    texts = placed.join(before, F.col("doc_id").eqNullSafe(F.col("head_id")))
    return texts.groupBy("host", "doc_id").agg(F.min("text").alias("text")).select(
        "doc_id", "text", F.col("host").alias("range"), F.lit(True).alias("guest")
    )
