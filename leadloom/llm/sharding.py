"""Sharding by balanced label propagation, with DataFrame functions only.

Documents that belong together (here: equal texts) should share a shard, and shards must hold equally
many documents, whatever the size of a group. Linked documents start in random shards. In every round
each one looks at where the members of its groups are and wishes to go where most of them are. What
wishes are granted is decided by quotas, so that no shard takes more than it may hold:

* two shards always exchange as much as both ways allow;
* beyond that a shard takes what it has room for, shared out over where the wishes come from;
* wishes with the greatest gain come first, equal ones by hash.

In every second round only shards with room that refused nobody may be wished for: members of a group
that is larger than a shard gather in the next one. It ends when two rounds in a row moved nothing. Documents without
links have no wishes; in the end they fill what the others leave free, so that the numbers of
documents of any two shards differ by one at most.

Copies of one text are handled in at most `SALTS` parts, each of which moves as one node of its
weight. So a text that a third of all rows share costs no more than others, small groups are moved
document by document, and no step puts a group into one task: votes are summed per task before the
shuffle, and the joins with the votes can be split by the skew rule. Per round one narrow table of
the linked nodes is written to the shared folder. The driver sees a histogram of wishes with a fixed
number of cells, never nodes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadloom.llm.shared import pick
from leadloom.session import materialise, tune

SHARDS = 8
SALTS = 256
ROUNDS = 16
LAW = "rows"
# Wishes are granted by cells: levels of gain (powers of two), and slices by hash within each.
LEVELS = 16
SLICES = 32
# Documents are numbered in buckets of about so many, and buckets in blocks of so many.
BUCKET = 1024


def quotas(n: int, shards: int = SHARDS) -> list[int]:
    """How many documents each shard holds in the end."""
    return [n // shards + (t < n % shards) for t in range(shards)]


def _voted(nodes: DataFrame, shards: int) -> DataFrame:
    """Each node with `score`: per shard, the weight of its groups' members there.

    The node itself counts once, in its own shard, however many groups it belongs to.
    """
    members = nodes.select("node", "weight", "shard", F.explode("groups").alias("group"))
    votes = members.groupBy("group").agg(
        *[F.sum(F.when(F.col("shard") == t, F.col("weight")).otherwise(0)).alias(f"v{t}") for t in range(shards)]
    )
    own = votes.select(F.col("group").alias("voted"), *[f"v{t}" for t in range(shards)])
    heard = members.join(own, F.col("group") == F.col("voted"))
    return heard.groupBy("node").agg(
        F.max("weight").alias("weight"),
        F.max("shard").alias("shard"),
        F.collect_set("group").alias("groups"),
        F.array(
            *[
                F.sum(F.col(f"v{t}"))
                - F.when(F.max("shard") == t, (F.count("group") - 1) * F.max("weight")).otherwise(0)
                for t in range(shards)
            ]
        ).alias("score"),
    )


def _level(weight: Column) -> Column:
    return F.least(F.lit(LEVELS - 1), F.floor(F.log2(weight + F.lit(1.0)))).cast("int")


def _slice(number: int) -> Column:
    return F.pmod(F.xxhash64(F.col("node"), F.lit(number)), F.lit(SLICES)).cast("int")


def _wishes(nodes: DataFrame, allowed: list[bool], number: int) -> DataFrame:
    """Each node with the shard it wishes for, and the rank of the wish: greater gains first."""
    shards = len(allowed)
    first = F.array_min("groups")
    options = F.array(
        *[
            F.when(
                F.lit(ok) | (F.col("shard") == t),
                F.struct(
                    F.get("score", F.lit(t)).alias("score"),
                    # Half of a group leaves a full shard rather than stay alone for ever.
                    F.lit(ok).alias("open"),
                    # Members of one group agree on what to prefer among equals.
                    F.xxhash64(first, F.lit(t)).alias("tie"),
                    F.lit(t).alias("shard"),
                ),
            )
            for t, ok in enumerate(allowed)
        ]
    )
    wish = F.array_max(options)
    gain = wish["score"] - F.get("score", F.col("shard"))
    rank = (F.lit(LEVELS - 1) - _level(gain)) * SLICES + _slice(number)
    voted = _voted(nodes, shards)
    return voted.select(
        "node", "weight", "shard", "groups", wish["shard"].alias("wish"), rank.alias("rank")
    )


def _granted(
    cells: dict[tuple[int, int], dict[int, int]], loads: list[int], room: list[int]
) -> dict[tuple[int, int], int]:
    """The weight that may move from one shard to another, per pair."""
    asked = {pair: sum(c.values()) for pair, c in cells.items()}
    even = {(s, t): min(w, asked.get((t, s), 0)) for (s, t), w in asked.items()}
    rest = {pair: w - even[pair] for pair, w in asked.items()}
    granted = dict(even)
    for t in range(len(loads)):
        into = {pair: w for pair, w in rest.items() if pair[1] == t and w}
        total = sum(into.values())
        for pair, w in into.items():
            granted[pair] += w if total <= room[t] else max(0, room[t]) * w // total
    return granted


def _cuts(
    cells: dict[tuple[int, int], dict[int, int]], granted: dict[tuple[int, int], int]
) -> tuple[dict[tuple[int, int], int], dict[tuple[int, int], int]]:
    """Per pair the first rank that may not move any more, and the weight that moves."""
    cuts, moved = {}, {}
    for pair, ranks in cells.items():
        used, cut = 0, 0
        for rank in sorted(ranks):
            if used + ranks[rank] > granted[pair]:
                break
            used, cut = used + ranks[rank], rank + 1
        cuts[pair], moved[pair] = cut, used
    return cuts, moved


def propagate(nodes: DataFrame, most: list[int], rounds: int = ROUNDS) -> tuple[DataFrame, list[int]]:
    """((node, shard), weight per shard) of linked nodes; `most` is what each shard may hold.

    `nodes` has node (unique), weight and groups, a not empty array of the names of the groups that
    the node belongs to. Nodes that a shard cannot hold have no shard in the result.
    """
    shards = len(most)
    start = F.pmod(F.xxhash64("node", F.lit(-1)), F.lit(shards)).cast("int")
    state = nodes.select("node", "weight", start.alias("shard"), "groups")
    loads = _loads(state, shards)
    still, full = 0, [False] * shards
    for number in range(rounds):
        room = [q - held for q, held in zip(most, loads, strict=True)]
        allowed = [number % 2 == 0 or (r > 0 and not f) for r, f in zip(room, full, strict=True)]
        asked = materialise(_wishes(state, allowed, number), "shard-wishes")
        cells: dict[tuple[int, int], dict[int, int]] = {}
        # shards * shards * LEVELS * SLICES rows at most.
        found = asked.where("wish <> shard").groupBy("shard", "wish", "rank")
        for r in found.agg(F.sum("weight").alias("weight")).collect():
            cells.setdefault((r["shard"], r["wish"]), {})[r["rank"]] = r["weight"]
        cuts, moved = _cuts(cells, _granted(cells, loads, room))
        for t in {pair[1] for pair in cells}:
            wished = sum(sum(c.values()) for pair, c in cells.items() if pair[1] == t)
            full[t] = wished > sum(w for pair, w in moved.items() if pair[1] == t)
        for (s, t), weight in moved.items():
            loads[s] -= weight
            loads[t] += weight
        flat = F.array(*[F.lit(cuts.get((s, t), 0)) for s in range(shards) for t in range(shards)])
        goes = F.col("rank") < F.get(flat, F.col("shard") * shards + F.col("wish"))
        state = asked.withColumn("shard", F.when(goes, F.col("wish")).otherwise(F.col("shard")))
        state = state.select("node", "weight", "shard", "groups")
        still = 0 if any(moved.values()) else still + 1
        if still == 2:
            break
    if any(held > q for q, held in zip(most, loads, strict=True)):
        state, loads = _released(state, most)
    return state.select("node", "shard"), loads


def _loads(state: DataFrame, shards: int) -> list[int]:
    found = {r[0]: r[1] for r in state.groupBy("shard").agg(F.sum("weight")).collect()}
    return [found.get(t, 0) for t in range(shards)]


def _released(state: DataFrame, most: list[int]) -> tuple[DataFrame, list[int]]:
    """The nodes without those that a shard cannot hold: the ones with the fewest neighbours go."""
    shards = len(most)
    near = F.get("score", F.col("shard"))
    ranked = _voted(state, shards).select(
        "node", "weight", "shard", "groups",
        ((F.lit(LEVELS - 1) - _level(near)) * SLICES + _slice(-2)).alias("rank"),
    )
    ranked = materialise(ranked, "shard-ranks")
    cells: dict[tuple[int, int], dict[int, int]] = {(t, t): {} for t in range(shards)}
    for r in ranked.groupBy("shard", "rank").agg(F.sum("weight").alias("weight")).collect():
        cells[r["shard"], r["shard"]][r["rank"]] = r["weight"]
    cuts, kept = _cuts(cells, {(t, t): q for t, q in enumerate(most)})
    ends = F.array(*[F.lit(cuts[t, t]) for t in range(shards)])
    state = ranked.where(F.col("rank") < F.get(ends, F.col("shard")))
    return state, [kept[t, t] for t in range(shards)]


def _numbered(rows: DataFrame, n: int, label: str, number: str) -> DataFrame:
    """Add `number`, gapless from 0 within `label`, in the order of hashed buckets.

    A bucket holds about `BUCKET` rows; the rows before it are added up on the table of counts.
    """
    buckets = max(1, n // BUCKET)
    placed = rows.withColumn("bucket", F.pmod(F.xxhash64("uid", "doc_id"), F.lit(buckets)))
    inside = Window.partitionBy(label, "bucket").orderBy("uid")
    placed = placed.withColumn("inside", F.row_number().over(inside) - 1)
    counts = rows.withColumn("bucket", F.pmod(F.xxhash64("uid", "doc_id"), F.lit(buckets)))
    counts = counts.groupBy(label, "bucket").agg(F.count(F.lit(1)).alias("held"))
    counts = counts.withColumn("block", F.floor(F.col("bucket") / BUCKET))
    earlier = Window.unboundedPreceding, -1
    none = F.lit(0).cast("long")
    blocks = counts.groupBy(label, "block").agg(F.sum("held").alias("held"))
    blocks = blocks.select(
        F.col(label).alias("of_label"),
        F.col("block").alias("of_block"),
        F.coalesce(
            F.sum("held").over(Window.partitionBy(label).orderBy("block").rowsBetween(*earlier)), none
        ).alias("before_block"),
    )
    along = Window.partitionBy(label, "block").orderBy("bucket").rowsBetween(*earlier)
    starts = counts.withColumn("before", F.coalesce(F.sum("held").over(along), none))
    starts = starts.join(
        blocks, (F.col(label) == F.col("of_label")) & (F.col("block") == F.col("of_block"))
    ).select(label, "bucket", (F.col("before") + F.col("before_block")).alias("start"))
    numbered = placed.join(starts, [label, "bucket"])
    return numbered.withColumn(number, F.col("start") + F.col("inside"))


def shards(
    docs: DataFrame, n_shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Shard and slot of every row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Equal texts are linked (by 128-bit hash). Shards hold equally many rows, give or take one; slots
    count the rows of a shard from 0 without gaps. Null texts count as empty, and like these are
    linked; repeated rows are copies like any others; an id may be null; a table without rows gives
    none, and with fewer rows than shards some stay empty. Other columns are not read. `size` is the
    number of UTF-8 bytes of the text plus one. `grown_shard` is null: this law says nothing of it.
    """
    spark = tune(docs.sparkSession)
    source = pick(docs, doc_id=id_col, text=text_col)
    text = F.coalesce("text", F.lit(""))
    uid = F.monotonically_increasing_id()
    rows = source.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.md5(text)).alias("group"),
        uid.alias("uid"),
    ).withColumn("salt", F.pmod(F.xxhash64("uid"), F.lit(SALTS)).cast("int"))
    rows = materialise(rows, "shard-rows")
    n = rows.count()
    parts = rows.groupBy("group", "salt").agg(
        F.min("uid").alias("node"), F.count(F.lit(1)).alias("weight")
    )
    copies = parts.groupBy("group").agg(F.sum("weight").alias("copies")).where("copies > 1")
    copies = copies.select(F.col("group").alias("linked"))
    parts = parts.join(copies, F.col("group") == F.col("linked"), "left_semi")
    parts = materialise(parts, "shard-nodes")
    most = quotas(n, n_shards)
    nodes = parts.select("node", "weight", F.array("group").alias("groups"))
    placed, loads = propagate(nodes, most)
    homes = parts.join(placed, "node").select("group", "salt", F.col("shard").alias("home"))
    free = n_shards
    labelled = rows.join(homes, ["group", "salt"], "left").select(
        "doc_id", "size", "text_crc32", "uid", F.coalesce("home", F.lit(free)).alias("label")
    )
    labelled = materialise(labelled, "shard-labels")
    # Rows without a home fill the gaps, shard by shard.
    ends, total = [], 0
    for q, held in zip(most, loads, strict=True):
        total += q - held
        ends.append(total)
    filled = F.size(F.filter(F.array(*[F.lit(e) for e in ends]), lambda e: e <= F.col("number")))
    numbered = _numbered(labelled, n, "label", "number")
    home = F.when(F.col("label") < free, F.col("label")).otherwise(filled)
    begins = F.array(*[F.lit(e - q + held) for e, q, held in zip(ends, most, loads, strict=True)])
    offset = F.get(F.array(*[F.lit(held) for held in loads]), home) - F.get(begins, home)
    slot = F.when(F.col("label") < free, F.col("number")).otherwise(F.col("number") + offset)
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        home.cast("int").alias("shard"),
        slot.cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
