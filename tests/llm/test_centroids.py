from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from leadloom.llm import centroids
from leadloom.llm.shared import table
from tests.conftest import SF

COLUMNS = "vec_id long, embedding array<double>, near int, point string, vector int"


def plain(rows, k=centroids.CLUSTERS, rounds=centroids.ROUNDS):
    """(id, point) rows of sound vectors -> (id, cluster, distance, ...), every pair compared."""
    kept = []
    for vec, values in rows:
        if values is None or len(values) != 64 or any(x is None or not math.isfinite(x) for x in values):
            continue
        kept.append((vec, [math.floor(256 * x) for x in values]))
    name = lambda r: hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest()
    means = [p for _, p in sorted(kept, key=lambda r: (name(r), r[1]))[:k]]
    if not kept:
        return []
    points = np.array([p for _, p in kept], np.int64)

    def nearest():
        apart = ((points[:, None, :] - np.array(means, np.int64)[None]) ** 2).sum(axis=2)
        return apart.argmin(axis=1), apart.min(axis=1)

    for _ in range(rounds):
        near, _ = nearest()
        for j in range(len(means)):
            if (near == j).any():
                total, n = points[near == j].sum(axis=0).tolist(), int((near == j).sum())
                means[j] = [t // n for t in total]
    near, apart = nearest()
    return sorted(
        (
            (vec, int(j), int(d), int(apart[near == j].sum()), int(apart.sum()),
             hashlib.sha256(",".join(map(str, means[j])).encode()).hexdigest())
            for (vec, _), j, d in zip(kept, near, apart, strict=True)
        ),
        key=repr,
    )


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], COLUMNS).repartition(3)


def vectors(n, seed, spread=1.0, groups=7):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(groups, 64))
    return [(i, (middles[i % groups] + spread * rng.normal(size=64)).tolist()) for i in range(n)]


def found(df):
    return sorted((tuple(r) for r in centroids.report(df).collect()), key=repr)


@pytest.mark.parametrize("spread", [0.01, 0.3])
def test_against_all_pairs(spark, spread):
    rows = vectors(300, 3, spread)
    assert found(frame(spark, rows)) == plain(rows)


def test_edges(spark):
    rows = vectors(60, 4)
    same = [(100 + i, rows[0][1]) for i in range(50)]
    odd = [
        (200, None), (201, []), (202, [1.0] * 63), (203, [1.0] * 65), (204, [1.0] * 63 + [None]),
        (205, [float("nan")] + [0.0] * 63), (206, [float("inf")] + [0.0] * 63),
        (207, [-0.0] * 64), (None, [0.5] * 64), (208, [-1 / 512] * 64), rows[5], rows[5],
    ]
    everything = rows + same + odd
    assert found(frame(spark, everything)) == plain(everything)
    few = rows[:3] + odd
    assert found(frame(spark, few)) == plain(few)
    assert found(frame(spark, rows[:1])) == plain(rows[:1])
    assert found(frame(spark, odd[:5])) == []
    assert centroids.report(spark.createDataFrame([], COLUMNS)).count() == 0


def test_search_skips_and_keeps_ties():
    """Whole-number points with many equal distances; the bounds spare most distances."""
    rng = np.random.default_rng(7)
    points = rng.integers(-2, 3, size=(4000, 6)) + 40 * rng.integers(0, 4, size=(4000, 1))
    means = points[rng.permutation(4000)[:30]].copy()
    near, second = np.zeros(4000, np.int32), np.ones(4000, np.int32)
    upper, lower, before = np.full(4000, np.inf), np.zeros(4000), None
    computed = []

    class Counted(centroids.Search):
        def squared(self, some, centroid):
            computed.append(len(some))
            return super().squared(some, centroid)

    for _ in range(6):
        Counted(means, before).run(points, near, second, upper, lower)
        apart = ((points[:, None, :] - means[None]) ** 2).sum(axis=2)
        assert (near == apart.argmin(axis=1)).all()
        before, means = means, means.copy()
        for j in range(30):
            if (near == j).any():
                means[j] = points[near == j].sum(axis=0) // int((near == j).sum())
    assert sum(computed) < 6 * 4000 * 30 / 2


def test_whole_table(spark):
    df = table(spark, SF, "embeddings")
    rows = [tuple(r) for r in df.select("vec_id", "embedding").collect()]
    assert found(df) == plain(rows)
