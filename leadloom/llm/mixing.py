"""Mixing sources to target weights along a low-discrepancy schedule.

The mix is a sequence of slots of `block` words. Slot i lies at the van der Corput point of i (its
bits mirrored behind the point), mapped through the cumulative target shares of the sources: any
stretch of the sequence holds each source nearly in its share. The k-th slot of a source takes the
k-th block of that source: its documents in a shuffled order, laid end to end and cut into blocks of
equally many words; where a source is repeated, the second pass has another order. Slots that a
source does not get from the points although its target is not reached follow at the end, slots
beyond its target are left out, and its last block is cut so that the target is met to the word.

Documents may be cut by block borders; what a document contributes is the sum over its pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadloom.llm.shared import pick
from leadloom.session import materialise

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK = 256
BITS = 48
MOST_SOURCES = 100_000
_WORD = r"[^\x20\x09-\x0D]+"
_LEVEL = 10


def words(text: Column) -> Column:
    """Number of words separated by ASCII white space; 0 for a missing text."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def fill(
    sizes: list[tuple[str | None, int]],
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> dict[str | None, float]:
    """Target words per source: shares of `share` times all words by weight, none above its limit.

    Sources come in code-point order, the missing one last; weights repeat along them. What a
    source cannot take (more than `most` times its size) is shared again by weight among the rest.
    """
    ordered = sorted(sizes, key=lambda s: (s[0] is None, (s[0] or "").encode("utf-32-be")))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(ordered)}
    limit = {s: most * n for s, n in ordered}
    left = share * sum(n for _, n in ordered)
    target: dict[str | None, float] = {}
    free = [s for s, _ in ordered]
    while free:
        total = sum(weight[s] for s in free)
        full = [s for s in free if left * weight[s] / total > limit[s]]
        if not full:
            return target | {s: left * weight[s] / total for s in free}
        for s in full:
            target[s] = float(limit[s])
        left -= sum(limit[s] for s in full)
        free = [s for s in free if s not in target]
    return target


def _placed(docs: DataFrame) -> DataFrame:
    """Each document's first word in its source's shuffled order, without a long window.

    The order is that of a hash; running totals are taken in three levels of its leading bits, so
    that a window never holds more than about a thousandth of a thousandth of a source's documents
    (or a thousand sums), however many documents the source has.
    """
    digit = lambda k: F.shiftrightunsigned("turn", 64 - _LEVEL * k).bitwiseAND(F.lit((1 << _LEVEL) - 1))  # noqa: E731, E501
    keyed = docs.withColumns({"d1": digit(1), "d2": digit(2)})
    before = lambda keys, order: (
        Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    base = ["part", "pass"]
    fine = keyed.groupBy(*base, "d1", "d2").agg(F.sum("size").alias("sum"))
    coarse = fine.groupBy(*base, "d1").agg(F.sum("sum").alias("sum"))
    coarse = coarse.withColumn("offset1", F.sum("sum").over(before(base, ["d1"]))).drop("sum")
    fine = fine.withColumn("offset2", F.sum("sum").over(before([*base, "d1"], ["d2"]))).drop("sum")
    within = before([*base, "d1", "d2"], ["turn", "doc_id", "size"])
    zero = F.lit(0).cast("long")
    return (
        keyed.withColumn("offset3", F.sum("size").over(within))
        .join(fine, [*base, "d1", "d2"])
        .join(coarse, [*base, "d1"])
        .withColumn(
            "start",
            F.coalesce("offset1", zero) + F.coalesce("offset2", zero) + F.coalesce("offset3", zero),
        )
        .drop("d1", "d2", "offset1", "offset2", "offset3")
    )


def sized(docs: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The picked columns with `size` in place of the text, and a key `part` for the source."""
    return (
        pick(docs, **columns)
        .withColumn("size", words(F.col("text")))
        .drop("text")
        .withColumn("part", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("-")))
    )


def targets(sized_docs: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """(part, source_size, target, low, high): one row per source; [low, high) is its interval.

    One row per source is gathered; the number of sources is that of a mixing recipe.
    """
    spark = sized_docs.sparkSession
    found = sized_docs.groupBy("part").agg(
        F.first("source").alias("source"), F.sum("size").alias("source_size")
    )
    rows = [
        (r["part"], r["source"], int(r["source_size"]))
        for r in found.limit(MOST_SOURCES + 1).collect()
    ]
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"a mix has at most {MOST_SOURCES} sources")
    target = fill([(s, n) for _, s, n in rows], weights, share, most)
    total = sum(target.values())
    out, low = [], 0.0
    for part, source, n in sorted(rows):
        high = low + (target[source] / total if total else 0.0)
        out.append((part, n, float(target[source]), low, high))
        low = high
    return spark.createDataFrame(
        out, "part string, source_size long, target double, low double, high double"
    )


def _point(i: Column) -> Column:
    """The van der Corput point of a slot number below 2**BITS: its bits mirrored."""
    mirrored = F.reverse(F.lpad(F.bin(i), BITS, "0"))
    return F.conv(mirrored, 2, 10).cast("double") / F.lit(float(1 << BITS))


def schedule(goal: DataFrame, block: int = BLOCK) -> DataFrame:
    """(part, rank, slot, take): the slots of each source in rank order, as many as it needs.

    `slot` orders the mix; ranks that the points do not give come after all others. `take` is the
    number of words of the block that is used.
    """
    spark = goal.sparkSession
    bounds = [tuple(r) for r in goal.select("part", "low", "high", "target").collect()]
    n = sum(-(-int(t) // block) for *_, t in bounds)
    parts = max(1, min(n // 50_000 + 1, 100_000))
    slots = spark.range(0, n, 1, parts).select(F.col("id").alias("slot"), _point(F.col("id")).alias("u"))
    # The sources are few and sorted: a search in an array of their upper ends.
    ends = F.array(*[F.lit(h) for _, _, h, _ in bounds[:-1]]).cast("array<double>")
    number = F.size(F.filter(ends, lambda end: end <= F.col("u")))
    names = F.array(*[F.lit(p) for p, *_ in bounds])
    # Used by three counts and the ranks: the points are computed once.
    slots = materialise(slots.select("slot", F.get(names, number).alias("part")), "mix-slots")
    # Rank: slots of the source in earlier stretches of the sequence, plus those in the same one.
    stretch = F.floor(F.col("slot") / 4096)
    counts = slots.groupBy("part", stretch.alias("stretch")).agg(F.count("*").alias("n"))
    wide = counts.groupBy("part", F.floor(F.col("stretch") / 4096).alias("wide")).agg(F.sum("n").alias("n"))
    earlier = lambda keys, order: (
        Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    wide = wide.select("part", "wide", F.sum("n").over(earlier(["part"], "wide")).alias("o1"))
    counts = counts.withColumn("wide", F.floor(F.col("stretch") / 4096)).select(
        "part", "stretch", "wide", F.sum("n").over(earlier(["part", "wide"], "stretch")).alias("o2")
    )
    ranked = (
        slots.withColumn("stretch", stretch)
        .withColumn("o3", F.row_number().over(Window.partitionBy("part", "stretch").orderBy("slot")))
        .join(counts, ["part", "stretch"])
        .join(wide, ["part", "wide"])
        .select(
            "part",
            (F.coalesce("o1", F.lit(0)) + F.coalesce("o2", F.lit(0)) + F.col("o3") - 1).alias("rank"),
            "slot",
        )
    )
    quota = goal.select("part", F.floor("target").alias("goal")).where("goal > 0")
    quota = F.broadcast(quota)  # one row per source, at most MOST_SOURCES
    given = ranked.join(quota, "part").where(F.col("rank") * block < F.col("goal"))
    reached = slots.groupBy("part").agg(F.count("*").alias("points"))
    wanted = F.ceil(F.col("goal") / block)
    # The points miss a source's number of blocks by a few at most (their discrepancy).
    rest = (
        quota.join(reached, "part", "left")
        .withColumn("points", F.coalesce("points", F.lit(0).cast("long")))
        .where(F.col("points") < wanted)
        .select("part", "goal", F.explode(F.sequence("points", wanted - 1)).alias("rank"))
        .withColumn("slot", F.lit(n) + F.col("rank"))
    )
    return given.unionByName(rest, allowMissingColumns=True).select(
        "part",
        "rank",
        "slot",
        F.least(F.lit(block).cast("long"), F.col("goal") - F.col("rank") * block).alias("take"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    block: int = BLOCK,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, goal, pieces) of the mix.

    documents: uid, doc_id, source, part, size, one row per input row. goal: one row per source.
    pieces: slot, part, rank, uid, pass, at, words - `words` words of document `uid` from its word
    `at` on stand in that slot (in pass order, `pass` counting repeats). No document gives more than
    `most` times its size. Missing texts have size 0, missing sources are one source. The order is
    that of hashes of the ids, so reruns agree. An empty table gives an empty mix.
    """
    named = {"doc_id": id_col, "text": text_col, "source": source_col}
    rows = sized(docs, named).withColumn("uid", F.monotonically_increasing_id())
    rows = materialise(rows, "mix-documents")
    goal = targets(rows, weights, share, most)
    passes = rows.where("size > 0").select(
        "uid", "doc_id", "part", "size", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("pass")
    )
    turned = passes.withColumn("turn", F.xxhash64("doc_id", "size", "pass"))
    quota = F.broadcast(goal.select("part", "source_size", F.floor("target").alias("goal")))
    spans = (
        _placed(turned)
        .join(quota, "part")
        .withColumn("start", F.col("start") + F.col("pass") * F.col("source_size"))
        .where("start < goal")
        .withColumn("end", F.least(F.col("start") + F.col("size"), F.col("goal")))
    )
    first, last = F.floor(F.col("start") / block), F.floor((F.col("end") - 1) / block)
    cut = spans.select("*", F.explode(F.sequence(first, last)).alias("rank"))
    begin = F.greatest("start", F.col("rank") * block)
    pieces = (
        cut.withColumn("begin", begin)
        .withColumn("words", F.least("end", (F.col("rank") + 1) * block) - F.col("begin"))
        .join(schedule(goal, block), ["part", "rank"])
        .where("begin - rank * %d < take" % block)
        .select(
            "slot",
            "part",
            "rank",
            "uid",
            "pass",
            (F.col("begin") - F.col("start")).alias("at"),
            F.least("words", F.col("take") - (F.col("begin") - F.col("rank") * block)).alias("words"),
        )
    )
    return rows, goal, pieces


def contributions(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken): one row per input row, from the mix's pieces."""
    rows, goal, pieces = mix(docs, **options)
    taken = pieces.groupBy("uid").agg(F.sum("words").alias("taken"))
    quota = F.broadcast(goal.select("part", "source_size", "target"))
    return (
        rows.join(taken, "uid", "left")
        .join(quota, "part")
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0).cast("long")).alias("taken"),
        )
    )
