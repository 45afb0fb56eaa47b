"""Centroid clustering of whole-number vectors behind a pivot table.

The distances of each vector to a few fixed pivots are worked out once and stored with it.  In every round
the pivots' distances to the centroids follow, and the largest difference of the two is a lower bound of
the distance between a vector and a centroid.  A vector is first compared with the centroid of the smallest
bound; only centroids whose bound does not exceed that distance are compared too.  All comparisons are
exact whole-number distances, so the result is that of comparing everything.

Only sums leave the tasks of a round: one row for each centroid and task, added up exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from croploom.session import materialise, settled

CENTROIDS, ROUNDS, SIZE, PIVOTS = 40, 5, 64, 12
SEED = 2
BLOCK = 2048  # vectors handled together
LIMIT = 1 << 27  # components reach less than this, so that squared distances of 64 of them fit a long
SLACK = 1e-6  # relative room for the rounding of square roots in the bounds

_STORED = "vec_id long, v array<int>, p array<double>"


def whole_vectors(rows: DataFrame, size: int = SIZE) -> DataFrame:
    """(vec_id, v): floor(256 * x) of the components of all vectors that take part."""
    # NaN and infinity are above every limit
    usable = f"coalesce(size(embedding) = {size} and forall(embedding, x -> x is not null and abs(256 * cast(x as double)) < {LIMIT - 1}), false)"
    v = F.expr("transform(embedding, x -> cast(floor(256 * cast(x as double)) as int))")
    return rows.filter(usable).select("vec_id", v.alias("v"))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows with rows."""
    d = a.astype(np.int64) - b.astype(np.int64)
    return np.einsum("ij,ij->i", d, d)


def _vectors(batch: pa.RecordBatch, size: int) -> np.ndarray:
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, size).astype(np.int64)


def _lists(table: np.ndarray, kind: pa.DataType) -> pa.Array:
    off = np.arange(0, table.size + 1, table.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(table.ravel(), kind))


def with_pivots(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """The pivot table: each vector with its distances to the pivots."""
    size = pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(lo, BLOCK)
                v = _vectors(batch, size)
                p = np.stack([np.sqrt(squared(v, q[None, :]).astype(np.float64)) for q in pivots], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), _lists(v, pa.int32()), _lists(p, pa.float64())], names=["vec_id", "v", "p"]
                )

    return vectors.mapInArrow(run, _STORED)


def nearest(v: np.ndarray, p: np.ndarray, centroids: np.ndarray, to_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid and exact squared distance of each vector, and how many distances that took.

    ``p`` holds the vectors' distances to the pivots, ``to_pivots`` those of the centroids.
    """
    bound = np.zeros((len(v), len(centroids)))
    for k in range(p.shape[1]):
        np.maximum(bound, np.abs(p[:, k, None] - to_pivots[None, :, k]), out=bound)
    room = SLACK * (1 + p.max(axis=1) + to_pivots.max())
    best = bound.argmin(axis=1)
    dist = squared(v, centroids[best])
    near = bound <= (np.sqrt(dist.astype(np.float64)) + room)[:, None]
    near[np.arange(len(v)), best] = False
    taken = len(v)
    # ascending order of the bound would skip more, ascending numbers keep ties simple
    for c in range(len(centroids)):
        rows = np.flatnonzero(near[:, c] & (bound[:, c] <= np.sqrt(dist.astype(np.float64)) + room))
        if not len(rows):
            continue
        taken += len(rows)
        d = squared(v[rows], centroids[c][None, :])
        won = (d < dist[rows]) | ((d == dist[rows]) & (c < best[rows]))
        best[rows[won]], dist[rows[won]] = c, d[won]
    return best, dist, taken


def _assign(centroids: np.ndarray, pivots: np.ndarray):
    """For each block of the pivot table: ids, vectors, centroids and distances."""
    to_pivots = np.sqrt(np.stack([squared(centroids, q[None, :]) for q in pivots], axis=1).astype(np.float64))
    size = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]):
        for whole in batches:
            for lo in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(lo, BLOCK)
                v = _vectors(batch, size)
                p = batch.column("p").flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1)
                yield batch, v, *nearest(v, p, centroids, to_pivots)

    return run


def _sums(centroids: np.ndarray, pivots: np.ndarray):
    assign = _assign(centroids, pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, size = centroids.shape
        total, n = [[0] * size for _ in range(k)], [0] * k
        for _, v, best, _, _ in assign(batches):
            for c in np.unique(best):
                part = v[best == c]
                total[c] = [a + b for a, b in zip(total[c], part.sum(axis=0).tolist())]
                n[c] += len(part)
        some = [c for c in range(k) if n[c]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([c for c in some for _ in range(size)], pa.int32()),
                pa.array([i for _ in some for i in range(size)], pa.int32()),
                pa.array([str(x) for c in some for x in total[c]], pa.string()),
                pa.array([n[c] for c in some for _ in range(size)], pa.int64()),
            ],
            names=["cluster", "place", "total", "n"],
        )

    return run


def first_centroids(vectors: DataFrame, k: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """The k vectors with the smallest SHA-256 of ``seed:vec_id``; of equal ones the smaller vector."""
    named = vectors.filter("vec_id is not null").withColumn("_hash", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    rows = named.orderBy("_hash", "v").limit(k).select("v").collect()
    return np.array([list(r.v) for r in rows], np.int64)


def moved(stored: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Centroids after one round: floors of their vectors' means, unchanged where they have none."""
    parts = stored.mapInArrow(_sums(centroids, pivots), "cluster int, place int, total string, n long")
    rows = parts.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect()
    out = centroids.copy()
    for r in rows:
        out[r.cluster, r.place] = int(r.total) // r.n
    return out


def cluster(rows: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, size: int = SIZE, pivots: int = PIVOTS, seed: int = SEED) -> DataFrame:
    """Cluster ``rows`` (vec_id, embedding; other columns are ignored) around k centroids.

    Vectors take part that have exactly ``size`` components, none null or non-finite; a component x counts
    as floor(256 * x).  Those with such a number of 2^27 or more in size take no part either, as their
    distances would not fit a long.  The first centroids are the k vectors with the smallest SHA-256 of
    ``seed:vec_id``; vectors without id are no first centroids, but are assigned as all others.  Each round
    assigns every vector to its nearest centroid (ties: the smaller number) and moves centroids to the
    floor of the mean; an empty one stays.  Then vectors are assigned once more.

    Returns vec_id, cluster, distance (squared), cluster_inertia and inertia (sums of distance) and
    centroid_sha256 (of the final centroid's components, joined by commas).  Repeated rows each come out.
    With fewer vectors than k there are as many centroids as vectors with ids; with none, or an empty
    table, there are no rows.

    The work is done when this is called; the result is stored, its stages are removed.
    """
    return settled(rows.sparkSession, "centroids", lambda: _cluster(rows, k, rounds, size, pivots, seed))


def _cluster(rows: DataFrame, k: int, rounds: int, size: int, n_pivots: int, seed: int) -> DataFrame:
    spark = rows.sparkSession
    result = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    vectors = whole_vectors(rows, size)
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], result)
    # The pivots are first centroids too: spread over the data, and bounded in number.
    pivots = _spread(centroids, n_pivots)
    stored = materialise(with_pivots(vectors, pivots), "centroids-pivots")
    for _ in range(rounds):
        centroids = moved(stored, centroids, pivots)

    assign = _assign(centroids, pivots)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, best, dist, _ in assign(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(best.astype(np.int32)), pa.array(dist)], names=["vec_id", "cluster", "distance"]
            )

    final = materialise(stored.mapInArrow(last, "vec_id long, cluster int, distance long"), "centroids-final")
    per = {r.cluster: r.s for r in final.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    total = sum(per.values())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    known = spark.createDataFrame([(c, s, total, digests[c]) for c, s in per.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # one row for each centroid
    return final.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _spread(points: np.ndarray, n: int) -> np.ndarray:
    """n of the points, each as far as possible from those before it."""
    chosen = [0]
    far = squared(points, points[:1])
    while len(chosen) < min(n, len(points)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, squared(points, points[chosen[-1]][None, :]))
    return points[chosen]
