"""Centroid clustering with exact integers: the threshold algorithm finds each vector's nearest centroid.

Every dimension has the list of centroids sorted by their value there. From a vector's own value the list is
walked outward in both directions at once; a centroid that comes up first in some dimension is measured exactly.
A centroid that has not come up lies, in every dimension, at least as far away as the walk has come (the
frontier), so the walk ends when the sum of the squared frontier distances strictly exceeds the best distance:
an equal one could still belong to a centroid with a smaller number.

Tasks work on Arrow batches of vectors and hand on one row of sums per cluster and dimension; the driver sees
``clusters * dimensions`` integers a round, whatever the number of vectors. Integers make the sums exact, so the
result depends neither on the order nor on the partitioning of the rows, and a lost executor costs a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialmill.llm.store import saved

DIMENSIONS, CLUSTERS, ROUNDS, SEED, SCALE = 64, 8, 10, 3, 1024.0
#: Integers beyond this have squared distances that a long may not hold; such a vector raises an error.
LARGEST = 1 << 27
#: Vectors that are walked at the same time.
SLICE = 1024


def nearest(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each point's nearest centroid; the smaller number wins a tie."""
    n, k, dimensions = len(points), len(centroids), centroids.shape[1]
    order = np.argsort(centroids, axis=0, kind="stable")
    values = np.take_along_axis(centroids, order, axis=0)
    dims = np.arange(dimensions)
    low = np.stack([np.searchsorted(values[:, d], points[:, d], side="right") - 1 for d in dims], axis=1)
    high = low + 1
    best, who = np.full(n, np.iinfo(np.int64).max), np.full(n, k)
    seen = np.zeros((n, k), bool)
    live = np.arange(n)
    while len(live):
        own = points[live]
        far = np.int64(4 * LARGEST)
        below = np.where(low >= 0, own - values[np.maximum(low, 0), dims], far)
        above = np.where(high < k, values[np.minimum(high, k - 1), dims] - own, far)
        down = below <= above
        step = np.where(down, below, above)
        came = order[np.where(down, np.maximum(low, 0), np.minimum(high, k - 1)), dims]
        fresh = np.zeros((len(live), k), bool)
        fresh[np.arange(len(live))[:, None], came] = True
        row, number = np.nonzero(fresh & ~seen[live])
        if len(row):
            distance = np.square(own[row] - centroids[number]).sum(axis=1)
            first = np.lexsort((number, distance, row))
            first = first[np.concatenate([[True], row[first][1:] != row[first][:-1]])]
            at, new, name = live[row[first]], distance[first], number[first]
            better = (new < best[at]) | ((new == best[at]) & (name < who[at]))
            best[at[better]], who[at[better]] = new[better], name[better]
            seen[live[row], number] = True
        on = (np.square(step).sum(axis=1) <= best[live]) & ~seen[live].all(axis=1)
        low, high, live = (low - down)[on], (high + ~down)[on], live[on]
    return who, best


def _quantised(dimensions: int, scale: float):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            whole = np.asarray(pc.fill_null(pc.equal(pc.list_value_length(lists), dimensions), False))
            ids, lists = ids.filter(pa.array(whole)), lists.filter(pa.array(whole))
            values = pc.list_flatten(lists).cast(pa.float64())
            x = np.asarray(pc.fill_null(values, float("nan"))).reshape(-1, dimensions)
            finite = np.isfinite(x).all(axis=1)
            with np.errstate(over="ignore"):
                x = np.floor(x[finite] * scale)
            if x.size and np.abs(x).max() > LARGEST:
                raise ValueError(f"a component times {scale:g} lies beyond +-{LARGEST}: squared distances would not fit a long")
            flat = pa.array(x.astype(np.int32).ravel())
            starts = pa.array(np.arange(len(x) + 1, dtype=np.int32) * dimensions)
            yield pa.RecordBatch.from_arrays([ids.filter(pa.array(finite)), pa.ListArray.from_arrays(starts, flat)], names=["vec_id", "v"])

    return read


def quantised(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: float = SCALE) -> DataFrame:
    """(vec_id, v) of the vectors with exactly ``dimensions`` components, none null or non-finite; v holds floor(scale * x)."""
    kept = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return kept.mapInArrow(_quantised(dimensions, scale), "vec_id long, v array<int>")


def first_centroids(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest sha256 of ``seed:vec_id``; of rows with one id the smaller vectors, null ids last."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(key.alias("k"), "v").orderBy(F.asc_nulls_last("k"), "v").limit(clusters).collect()
    return np.array([r.v for r in rows], np.int64)


def _points(batch: pa.RecordBatch, dimensions: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for lo in range(0, batch.num_rows, SLICE):
        part = batch.slice(lo, SLICE)
        yield part.column(0), np.asarray(pc.list_flatten(part.column(1))).astype(np.int64).reshape(-1, dimensions)


def _sums(centroids: np.ndarray):
    k, dimensions = centroids.shape

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dimensions + 1), np.int64)  # the last column counts
        for batch in batches:
            for _, points in _points(batch, dimensions):
                who, _ = nearest(points, centroids)
                order = np.argsort(who, kind="stable")
                found, start = np.unique(who[order], return_index=True)
                total[found, :dimensions] += np.add.reduceat(points[order], start, axis=0)
                total[found, dimensions] += np.diff(np.append(start, len(order)))
        used = np.flatnonzero(total[:, dimensions])
        cluster, d = (x.ravel() for x in np.meshgrid(used, np.arange(dimensions + 1), indexing="ij"))
        columns = {"cluster": pa.array(cluster, pa.int32()), "d": pa.array(d, pa.int32()), "total": pa.array(total[used].ravel())}
        yield pa.RecordBatch.from_pydict(columns)

    return read


def _assigned(centroids: np.ndarray):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, points in _points(batch, centroids.shape[1]):
                who, best = nearest(points, centroids)
                yield pa.RecordBatch.from_pydict({"vec_id": ids, "cluster": pa.array(who, pa.int32()), "distance": pa.array(best)})

    return read


def next_centroids(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor of each cluster's mean; a centroid without vectors stays."""
    sums = vectors.mapInArrow(_sums(centroids), "cluster int, d int, total long").groupBy("cluster", "d").agg(F.sum("total").alias("total"))
    dimensions = centroids.shape[1]
    total = {(r.cluster, r.d): r.total for r in sums.collect()}  # clusters * (dimensions + 1) numbers at most
    out = centroids.copy()
    for c in range(len(centroids)):
        if (count := total.get((c, dimensions))) is not None:
            out[c] = [total[c, d] // count for d in range(dimensions)]
    return out


def clustered(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, seed: int = SEED, scale: float = SCALE
) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) of every kept vector, final centroids).

    Vectors of another length, with a null or with a non-finite component are left out; null lists too. A row with
    a null vec_id is clustered, but starts a centroid only after all others; repeated rows count as often as they
    occur, so equal vectors may start as equal centroids, of which the smaller number gets all. Fewer vectors than
    ``clusters`` give fewer centroids, an empty table no rows. Other columns, of whatever name, are ignored.
    """
    kept = saved(quantised(vectors, dimensions, scale), "vectors")
    centroids = first_centroids(kept, clusters, seed)
    if not len(centroids):
        return kept.selectExpr("vec_id", "cast(null as int) as cluster", "cast(null as long) as distance"), centroids
    for _ in range(rounds):
        moved = next_centroids(kept, centroids)
        if (moved == centroids).all():
            break  # every further round gives the same
        centroids = moved
    return kept.mapInArrow(_assigned(centroids), "vec_id long, cluster int, distance long"), centroids


def cluster_report(vectors: DataFrame) -> DataFrame:
    """Per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256; see :func:`clustered`."""
    found, centroids = clustered(vectors)
    found = saved(found, "assigned")
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    inertia = {r.cluster: r.inertia for r in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}  # one row a cluster
    by_cluster = F.array(*(F.lit(inertia.get(c, 0)).cast("long") for c in range(len(centroids)))) if digests else F.array(F.lit(0).cast("long"))
    names = F.array(*map(F.lit, digests)) if digests else F.array(F.lit(""))
    return found.select(
        "vec_id", "cluster", "distance", by_cluster[F.col("cluster")].alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"), names[F.col("cluster")].alias("centroid_sha256"),
    )
