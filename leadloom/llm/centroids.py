"""Exact centroid clustering of integer vectors by bounded, shrinking searches.

Every vector remembers its nearest and its second-nearest centroid with an upper bound of its
distance to the nearest and a lower bound of its distance to all others. After the centroids moved,
the bounds are widened by how far they moved, and a vector whose upper bound lies below the lower
one, or below half the distance from its centroid to the next centroid, stays without any distance
being computed. For all others:

* the distances to the two remembered centroids are computed, and the search starts at the closer
  of them, at distance p; the other one, at distance r, is the second-nearest so far;
* the centroids are tried in ascending distance from that start. One that is at most r from the
  vector is at most p + r from the start, so the search ends at the first centroid beyond that ball;
* whenever a nearer centroid is found, r and with it the ball shrink.

Bounds are floating-point numbers with a margin; they only decide what is not computed. Whatever is
compared is a squared distance in whole numbers, ties go to the smaller number. So the result is that
of comparing every vector with every centroid.

The vectors and what they remember lie in one table in the shared folder. A round reads it, writes
its successor, and adds up the vectors of each centroid per task, then over tasks in whole numbers.
Only the centroids (k rows) reach the driver and go to the tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm.shared import pick, small_batches
from leadloom.session import materialise

CLUSTERS = 40
ROUNDS = 5
DIMENSIONS = 64
SCALE = 256
SALT = 2
# A component beyond this could make a squared distance pass 63 bits.
_LARGEST = 1 << 28
_MARGIN = 1e-9
_STATE = (
    "vec_id long, point array<int>, near int, second int, upper double, lower double, distance long"
)


def whole_vectors(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    dimensions: int = DIMENSIONS, scale: int = SCALE,
) -> DataFrame:
    """(vec_id, point): vectors of the right size without null or non-finite parts, as floor(scale x).

    Other vectors go. A component of 2**28 or more after scaling is an error: the squared distances
    of such vectors do not fit the result.
    """
    source = pick(rows, vec_id=id_col, vector=vector_col)
    vector = F.transform("vector", lambda x: x.cast("double"))
    sound = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    kept = source.where((F.size("vector") == dimensions) & sound)
    scaled = F.transform(vector, lambda x: F.floor(x * F.lit(float(scale))))
    fits = F.forall(scaled, lambda v: F.abs(v) < _LARGEST)
    point = F.when(fits, F.transform(scaled, lambda v: v.cast("int"))).otherwise(
        F.raise_error(F.lit("a vector's component is too large")).cast("array<int>")
    )
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), point.alias("point"))


def first_centroids(points: DataFrame, k: int, salt: int) -> np.ndarray:
    """The k points with the smallest hash of salt and id (null: empty), ties by components."""
    name = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = points.select(F.sha2(name, 256).alias("hash"), "point").orderBy("hash", "point").limit(k)
    return np.array([r["point"] for r in rows.collect()], np.int64).reshape(-1, DIMENSIONS)


class Search:
    """The search of one round: centroids, their distances, and their neighbours in order."""

    def __init__(self, centroids: np.ndarray, before: np.ndarray | None = None):
        self.centroids = centroids
        k = len(centroids)
        apart = centroids[:, None, :] - centroids[None, :, :]
        self.apart = np.sqrt(np.einsum("ijk,ijk->ij", apart, apart).astype(float))
        self.order = np.argsort(self.apart, axis=1, kind="stable")
        others = self.apart + np.where(np.eye(k, dtype=bool), np.inf, 0)
        self.half = others.min(axis=1) / 2
        moved = np.zeros(k)
        if before is not None:
            moved = np.sqrt(((centroids - before) ** 2).sum(axis=1).astype(float))
        self.moved = moved * (1 + _MARGIN)
        # The farthest that any centroid but the given one moved.
        self.others_moved = np.array(
            [np.delete(self.moved, j).max() if k > 1 else 0.0 for j in range(k)]
        )

    def squared(self, points: np.ndarray, centroid: int | np.ndarray) -> np.ndarray:
        apart = points - self.centroids[centroid]
        return np.einsum("ij,ij->i", apart, apart)

    def run(
        self, points: np.ndarray, near: np.ndarray, second: np.ndarray,
        upper: np.ndarray, lower: np.ndarray,
    ) -> None:
        """Bring near, second, upper and lower up to date, in place."""
        upper += self.moved[near]
        lower -= self.others_moved[near]
        # Bounds at most this large are certain to hold; equal distances are always compared.
        certain = np.maximum(lower, self.half[near]) * (1 - _MARGIN)
        open_ = np.flatnonzero(upper * (1 + _MARGIN) >= certain)
        if not len(open_):
            return
        a, b = near[open_], second[open_]
        own = points[open_]
        da, db = self.squared(own, a), self.squared(own, b)
        swap = (db < da) | ((db == da) & (b < a))
        start = np.where(swap, b, a)
        best, rest = np.where(swap, db, da), np.where(swap, da, db)
        first, other = start.copy(), np.where(swap, a, b)
        # With one centroid both are the same, and there is nothing else to find.
        rest = np.where(a == b, np.iinfo(np.int64).max, rest)
        known = (a, b)
        base = np.sqrt(best.astype(float))
        for c in np.unique(start).tolist():
            mine = np.flatnonzero(start == c)
            for j in self.order[c].tolist():
                ball = (base[mine] + np.sqrt(rest[mine].astype(float))) * (1 + _MARGIN)
                mine = mine[self.apart[c, j] <= ball]
                if not len(mine):
                    break
                new = mine[(known[0][mine] != j) & (known[1][mine] != j)]
                if not len(new):
                    continue
                d = self.squared(own[new], j)
                nearer = (d < best[new]) | ((d == best[new]) & (j < first[new]))
                between = ~nearer & ((d < rest[new]) | ((d == rest[new]) & (j < other[new])))
                up, mid = new[nearer], new[between]
                rest[up], other[up] = best[up], first[up]
                best[up], first[up] = d[nearer], j
                rest[mid], other[mid] = d[between], j
        near[open_], second[open_] = first, other
        upper[open_] = np.sqrt(best.astype(float)) * (1 + _MARGIN)
        lower[open_] = np.sqrt(rest.astype(float)) * (1 - _MARGIN)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _assign(state: DataFrame, centroids: np.ndarray, before: np.ndarray | None, last: bool):
    """The next state: each vector with its nearest and second-nearest centroid and bounds.

    The last round computes the distance of every vector to its centroid.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids, before)
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _matrix(batch.column("point"))
            near, second, upper, lower = (
                batch.column(x).to_numpy(zero_copy_only=False).copy()
                for x in ("near", "second", "upper", "lower")
            )
            search.run(points, near, second, upper, lower)
            distance = search.squared(points, near) if last else np.zeros(len(near), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("point"), pa.array(near), pa.array(second),
                 pa.array(upper), pa.array(lower), pa.array(distance)],
                names=["vec_id", "point", "near", "second", "upper", "lower", "distance"],
            )

    return state.mapInArrow(run, _STATE)


def _means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The exact floor of the mean of each centroid's vectors; a centroid without any stays."""
    k, dimensions = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # 2**28 per component: 2**35 vectors of one task fit 63 bits.
        sums, counts = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            near = batch.column("near").to_numpy(zero_copy_only=False)
            points = _matrix(batch.column("point"))
            for j in np.unique(near).tolist():
                mine = near == j
                sums[j] += points[mine].sum(axis=0)
                counts[j] += int(mine.sum())
        some = np.flatnonzero(counts)
        for j in some.tolist():
            yield pa.RecordBatch.from_arrays(
                [pa.array([j] * dimensions, pa.int32()), pa.array(range(dimensions), pa.int32()),
                 pa.array(sums[j]), pa.array([counts[j]] * dimensions)],
                names=["near", "position", "total", "size"],
            )

    parts = state.select("near", "point").mapInArrow(
        run, "near int, position int, total long, size long"
    )
    whole = parts.groupBy("near", "position").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("size").alias("size")
    )
    means = centroids.copy()
    for r in whole.collect():
        means[r["near"], r["position"]] = int(r["total"]) // r["size"]
    return means


def cluster(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    k: int = CLUSTERS, rounds: int = ROUNDS, salt: int = SALT,
) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, point, near, distance), centroids) after `rounds` rounds and a last assignment.

    One row per kept vector: repeated rows and ids give a row each, a null id is kept; vectors that
    are null, of another size, or have a null or non-finite part go. Fewer than k vectors give as
    many centroids; a table without kept vectors gives no rows. Equal centroids are told apart by
    number: the smaller one gets the vectors, the other stays where it is. Other columns are not read.
    """
    small_batches(rows.sparkSession)
    points = materialise(whole_vectors(rows, id_col, vector_col), "centroid-points")
    centroids = first_centroids(points, k, salt)
    other = min(1, len(centroids) - 1)
    state = points.select(
        "vec_id", "point", F.lit(0).alias("near"), F.lit(other).alias("second"),
        F.lit(float("inf")).alias("upper"), F.lit(0.0).alias("lower"),
        F.lit(0).cast("long").alias("distance"),
    )
    if not len(centroids):
        return state.select("vec_id", "point", "near", "distance"), centroids
    before = None
    for number in range(rounds):
        state = materialise(_assign(state, centroids, before, False), f"centroid-round-{number}")
        before, centroids = centroids, _means(state, centroids)
    state = materialise(_assign(state, centroids, before, True), "centroid-last")
    return state.select("vec_id", "point", "near", "distance"), centroids


def report(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per kept vector: its cluster, squared distance, the inertia of the cluster and of all."""
    found, centroids = cluster(rows, id_col, vector_col)
    sums = found.groupBy("near").agg(F.sum("distance").alias("inertia"))
    # One row per centroid, k at most.
    inertia = {r["near"]: r["inertia"] for r in sums.collect()}
    hashes = [
        hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()
    ]
    known = [(j, inertia.get(j, 0), sum(inertia.values()), h) for j, h in enumerate(hashes)]
    clusters = rows.sparkSession.createDataFrame(
        known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return found.select("vec_id", F.col("near").alias("cluster"), "distance").join(
        F.broadcast(clusters), "cluster"
    ).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(k: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    """The same by comparing every vector with every centroid, as DuckDB SQL."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT vec_id, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE len(embedding) = {DIMENSIONS}
    AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(CAST(x AS DOUBLE))]) = {DIMENSIONS}
)""",
        f"""parts AS MATERIALIZED (
  SELECT vec_id, unnest(range({DIMENSIONS})) AS i, unnest(v) AS x FROM kept
)""",
        f"""c0 AS MATERIALIZED (
  SELECT n AS c, unnest(range({DIMENSIONS})) AS i, unnest(v) AS x
  FROM (SELECT v, row_number() OVER (ORDER BY sha256('{SALT}:' || vec_id), v) - 1 AS n FROM kept)
  WHERE n < {k}
)""",
    ]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, arg_min(c, (d, c)) AS c, min(d) AS d
  FROM (SELECT p.vec_id, q.c, sum((p.x - q.x) * (p.x - q.x)) AS d
        FROM parts p JOIN c{r} q ON p.i = q.i GROUP BY p.vec_id, q.c)
  GROUP BY vec_id
)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT o.c, o.i, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, o.x) AS x
  FROM c{r} o LEFT JOIN (
    SELECT a.c, p.i, sum(p.x) AS s, count(*) AS n
    FROM a{r} a JOIN parts p ON a.vec_id = p.vec_id GROUP BY a.c, p.i) m
  ON o.c = m.c AND o.i = m.i
)""")
    return f"""WITH {", ".join(steps)}
SELECT a.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
  CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.d) OVER () AS BIGINT) AS inertia, h.centroid_sha256
FROM a{rounds} a JOIN (
  SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256
  FROM c{rounds} GROUP BY c) h ON a.c = h.c"""
