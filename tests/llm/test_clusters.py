"""Centroid clustering against plain integers written out."""

import collections
import hashlib
import math
import random

import numpy as np
import pytest

from trialmill.llm import centroids as C

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, v int, d int, total long, k string"


def brute(rows, clusters=8, rounds=10, dimensions=64, seed=3):
    kept = []
    for vec_id, x in rows:
        if x is None or len(x) != dimensions or any(y is None or not math.isfinite(y) for y in x):
            continue
        kept.append((vec_id, [math.floor(1024 * float(np.float32(y))) for y in x]))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    cents = [list(r[1]) for r in order[:clusters]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(cents))

    for _ in range(rounds):
        groups = collections.defaultdict(list)
        for _, v in kept:
            groups[near(v)[1]].append(v)
        for i, vs in groups.items():
            cents[i] = [sum(col) // len(vs) for col in zip(*vs, strict=True)]
    found = [(vec_id, *near(v)[::-1]) for vec_id, v in kept]
    by = collections.Counter()
    for _, c, d in found:
        by[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return collections.Counter((i, c, d, by[c], sum(by.values()), sha[c]) for i, c, d in found)


def got(df):
    return collections.Counter((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def table(spark, rows):
    return spark.createDataFrame([(i, x) + (None,) * 6 for i, x in rows], SCHEMA).repartition(3)


def odd_rows(n=60):
    rnd = random.Random(11)
    vec = lambda: [rnd.choice([0.0, -0.25, 0.5, 1e-9, -1e-9, rnd.uniform(-1, 1)]) for _ in range(64)]
    rows = [(i * 3, vec()) for i in range(n)]
    rows += [rows[4], rows[4], (rows[5][0], vec()), (None, vec()), (900, [0.0] * 64), (901, [0.0] * 64)]
    bad = [None, [], [0.5] * 63, [0.5] * 65, [None] + [0.5] * 63, [float("nan")] * 64, [float("inf")] + [0.5] * 63]
    return rows + [(1000 + i, x) for i, x in enumerate(bad)]


def test_report_equals_plain_integers(spark):
    rows = odd_rows()
    assert got(C.cluster_report(table(spark, rows))) == brute(rows)


def test_few_equal_and_no_vectors(spark):
    few = [(5, [0.5] * 64), (5, [0.5] * 64), (6, [0.5] * 64), (None, [-1.0] * 64)]
    assert got(C.cluster_report(table(spark, few))) == brute(few)
    assert C.cluster_report(table(spark, [])).collect() == []
    assert C.cluster_report(table(spark, [(1, [1.0])])).collect() == []


def test_partitioning_does_not_matter(spark):
    rows = odd_rows(30)
    df = table(spark, rows)
    assert got(C.cluster_report(df)) == got(C.cluster_report(df.repartition(7).union(df.limit(0))))


def test_components_too_large_raise(spark):
    with pytest.raises(Exception, match="would not fit a long"):
        C.cluster_report(table(spark, [(1, [1e30] + [0.0] * 63)])).collect()


@pytest.mark.parametrize("k, dimensions, spread", [(1, 3, 5), (8, 64, 3), (8, 2, 2), (40, 5, 50), (200, 3, 1000)])
def test_threshold_walk_finds_the_nearest(k, dimensions, spread):
    rnd = np.random.default_rng(k)
    cents, points = (rnd.integers(-spread, spread + 1, (n, dimensions)) for n in (k, 300))
    who, best = C.nearest(points, cents)
    all_ = np.square(points[:, None, :] - cents[None]).sum(axis=2)
    assert (who == all_.argmin(axis=1)).all() and (best == all_.min(axis=1)).all()


def test_threshold_walk_stops_early():
    """Few centroids are measured where they lie far apart."""
    cents = np.arange(1000)[:, None] * np.full((1, 4), 1000)
    measured = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            out = super().__getitem__(key)
            if isinstance(key, np.ndarray) and key.dtype != bool:
                measured.append(len(key))
            return out

    points = np.full((10, 4), 500_123)
    who, _ = C.nearest(points, cents.view(Counted))
    assert (who == 500).all() and sum(measured) <= 10 * 10  # of 10 * 1000
