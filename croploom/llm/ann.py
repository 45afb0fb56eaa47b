"""Approximate nearest neighbours along several Hilbert curves.

Each curve orders the vectors by the Hilbert index of their projection on a few random directions, with
shifted cell borders of its own.  The orders are range-partitioned sorts, and a vector's place in each is
exact.  A query looks at the vectors within a window of places around its own on every curve; what is
found on all curves is merged and ranked by the exact distance of the original vectors.

How wide the window must be depends on the data.  It is learned: for a bounded sample of queries the true
neighbours are found by comparing with all rows, and the window is taken that would have caught
``RECALL`` of them.  Equal vectors are one entry of the index, which names the smallest ids that carry
it, so copies cost nothing however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from croploom.operators.numbering import number_rows
from croploom.session import materialise, settled

NEAREST = 10
CURVES, DIRECTIONS, BITS = 16, 6, 6
RECALL = 0.955  # share of the sample's true neighbours that the window must catch
FIT_ROWS = 4096  # expected number of vectors that cell borders are learned from
FIT_QUERIES = 100  # expected number of queries that the window is learned from
LEAST = 64  # smallest window
BLOCK = 1024  # places on a curve that are compared together


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of points with whole coordinates below 2**bits, one point per row."""
    x = x.astype(np.int64).T.copy()
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(len(x)):
            up = (x[i] & q) != 0
            t = np.where(up, q - 1, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= t
            x[i] ^= np.where(up, 0, t)
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for row in x:
            key = key << 1 | row >> b & 1
    return key


@dataclass
class Curves:
    """Directions of each curve and the borders of its cells along them."""

    directions: np.ndarray  # (curves, dimension, directions)
    borders: np.ndarray  # (curves, directions, cells - 1)

    @staticmethod
    def fit(sample: np.ndarray, curves: int, seed: int = 11) -> Curves:
        """Borders are quantiles of the sample, shifted by a random part of a cell on each axis."""
        rng = np.random.default_rng(seed)
        dim = sample.shape[1]
        m = min(DIRECTIONS, dim)
        dirs = np.stack([np.linalg.qr(rng.normal(size=(dim, m)))[0] for _ in range(curves)])
        cells = 1 << BITS
        shift = rng.random((curves, m, 1))
        at = (np.arange(cells - 1)[None, None, :] + shift) / cells
        seen = np.sort(np.einsum("nd,cdm->cmn", sample, dirs), axis=2)
        place = np.minimum((at * seen.shape[2]).astype(int), seen.shape[2] - 1)
        return Curves(dirs, np.take_along_axis(seen, place, axis=2))

    def keys(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(self.directions), len(x)), np.int64)
        for c, (d, b) in enumerate(zip(self.directions, self.borders)):
            y = x @ d
            out[c] = hilbert(np.stack([np.searchsorted(b[j], y[:, j], side="right") for j in range(y.shape[1])], axis=1), BITS)
        return out


def usable(vec: str) -> Column:
    """Vectors that take part: not null, not empty, not zero, all components finite numbers."""
    finite = f"forall({vec}, v -> v is not null and not isnan(v) and abs(v) < double('infinity'))"
    return F.expr(f"{vec} is not null and size({vec}) > 0 and {finite} and exists({vec}, v -> v <> 0)")


def matrix(col: pa.Array) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1)


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.sqrt(((q[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))


def _near(q: np.ndarray, x: np.ndarray, first: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query the k nearest rows, ties by their smallest id."""
    step = max(1, (1 << 22) // max(1, x.size))
    for lo in range(0, len(q), step):
        for i, d in enumerate(distances(q[lo : lo + step], x), lo):
            yield i, d, np.lexsort((first, d))[:k]


def _keyed(curves: Curves):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, n = curves.keys(matrix(batch.column("vec"))), len(curves.directions)
            ids = np.tile(batch.column("cid").to_numpy(), n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(n, dtype=np.int32), batch.num_rows)), pa.array(keys.ravel()), pa.array(ids)], names=["curve", "key", "cid"]
            )

    return run


def _all_rows(ids: np.ndarray, q: np.ndarray, k: int):
    """The k nearest entries of each sample query among the rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[float, int]]] = [[] for _ in ids]
        for batch in batches:
            first = batch.column("cid").to_numpy()
            x = matrix(batch.column("vec"))
            for lo in range(0, len(x), 2048):
                f = first[lo : lo + 2048]
                for i, d, top in _near(q, x[lo : lo + 2048], f, k + 1):
                    best[i] = sorted(best[i] + [(float(d[j]), int(f[j])) for j in top if f[j] != ids[i]])[:k]
        rows = [(int(ids[i]), c, d) for i, b in enumerate(best) for d, c in b]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.float64())],
            names=["qid", "cid", "score"],
        )

    return run


def _search(nearest: int):
    def run(key: tuple, asked: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(there):
            return pd.DataFrame({"qid": [], "vec_id": [], "score": []})
        q, x = (np.stack(f["vec"].to_numpy()).astype(np.float64) for f in (asked, there))
        place, ids = there["place"].to_numpy(), there["ids"].to_list()
        first = there["cid"].to_numpy()
        lo, hi, own = asked["lo"].to_numpy(), asked["hi"].to_numpy(), asked["qid"].to_numpy()
        rows = []
        step = max(1, (1 << 22) // x.size)
        for a in range(0, len(q), step):
            for i, d in enumerate(distances(q[a : a + step], x), a):
                d = np.where((place >= lo[i]) & (place <= hi[i]), d, np.inf)
                top = np.lexsort((first, d))[: nearest + 1]
                found = sorted((d[j], v) for j in top if d[j] < np.inf for v in ids[j])[: nearest + 1]
                rows += [(own[i], v, s) for s, v in found]
        return pd.DataFrame(rows, columns=["qid", "vec_id", "score"])

    return run


def window_of(entries: DataFrame, asked: DataFrame, places: DataFrame, nearest: int, recall: float = RECALL, queries: int = FIT_QUERIES) -> int:
    """The window that catches the wanted share of the true neighbours of some queries."""
    n = asked.count()
    some = asked.filter(F.pmod(F.xxhash64("cid"), F.lit(1 << 20)) < int(min(1.0, queries / max(n, 1)) * (1 << 20)) + 1)
    rows = some.select("cid", "vec").collect()
    if not rows:
        return LEAST
    ids, q = np.array([r.cid for r in rows]), np.array([r.vec for r in rows], np.float64)
    near = entries.select("cid", "vec").mapInArrow(_all_rows(ids, q, nearest), "qid long, cid long, score double")
    order = Window.partitionBy("qid").orderBy("score", "cid")
    true = materialise(near.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= nearest).select("qid", "cid"), "ann-true")
    # at most queries x nearest rows, whatever the table holds
    far = places.join(F.broadcast(true), "cid").select("qid", "cid", "curve", "place")
    own = places.join(F.broadcast(true.select(F.col("qid").alias("cid")).distinct()), "cid").select(F.col("cid").alias("qid"), "curve", F.col("place").alias("at"))
    gaps = far.join(own, ["qid", "curve"]).groupBy("qid", "cid").agg(F.min(F.abs(F.col("place") - F.col("at"))).alias("gap"))
    gap = gaps.agg(F.expr(f"percentile(gap, {recall})")).first()[0]
    return max(LEAST, int(np.ceil(gap or 0)))


def nearest_neighbours(
    vectors: DataFrame, query_filter: str = "vec_id % 100 = 0", nearest: int = NEAREST, curves: int = CURVES, vec: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest rows found of each row that ``query_filter`` selects.

    score is the Euclidean distance in double precision; equal ones rank by the smaller vec_id, and a
    query is not its own neighbour.  With fewer candidates than ``nearest`` all come out.

    Rows whose id is null, or whose vector is null, empty, zero or holds null or non-finite components,
    take no part, nor do vectors of another length than most have (of equally frequent lengths, the
    shorter).  Repeated rows count once; of several vectors under one id the nearest counts.  Other
    columns are ignored.  An empty table gives no rows.

    The work is done when this is called; the result is stored.
    """
    return settled(vectors.sparkSession, "neighbours", lambda: _neighbours(vectors, query_filter, nearest, curves, vec))


def _neighbours(vectors: DataFrame, query_filter: str, nearest: int, curves: int, vec: str) -> DataFrame:
    spark = vectors.sparkSession
    rows = vectors.filter("vec_id is not null").filter(usable(vec)).select("vec_id", F.col(vec).alias("vec"))
    sizes = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], schema)
    rows = rows.filter(F.size("vec") == sizes.n)
    # the rank filter is applied before the shuffle too, so a frequent vector is cut down where it is read
    copies = Window.partitionBy("vec").orderBy("vec_id")
    ranked = rows.withColumn("r", F.dense_rank().over(copies)).filter(F.col("r") <= nearest + 1).select("vec", "vec_id").distinct()
    entries = ranked.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    entries = materialise(entries.select(F.col("ids")[0].alias("cid"), "vec", "ids"), "ann-entries")
    n = entries.count()
    part = F.pmod(F.xxhash64("cid", "vec"), F.lit(1 << 20)) < int(min(1.0, FIT_ROWS / n) * (1 << 20)) + 1
    sample = np.array([r.vec for r in entries.filter(part).select("vec").collect()], np.float64)
    if not len(sample):
        sample = np.array([entries.first().vec], np.float64)
    fitted = Curves.fit(sample, curves)
    keyed = entries.select("cid", "vec").mapInArrow(_keyed(fitted), "curve int, key long, cid long")
    places = materialise(number_rows(keyed, "place", ["key", "cid"], by=["curve"], unique=True).select("curve", "cid", "place"), "ann-places")

    queries = materialise(
        rows.filter(query_filter).select(F.col("vec_id").alias("query_id"), "vec").distinct().join(entries.select("cid", "vec"), "vec"), "ann-queries"
    )
    asked = queries.select("cid", "vec").distinct()
    width = window_of(entries, asked, places, nearest)
    block = F.expr(f"cast(place div {BLOCK} as bigint)")
    blocks = F.expr(f"sequence(cast(greatest(place - {width}, 0) div {BLOCK} as bigint), cast((place + {width}) div {BLOCK} as bigint))")
    left = asked.join(places, "cid").select(
        F.col("cid").alias("qid"), "vec", F.col("curve").alias("curve"), (F.col("place") - width).alias("lo"), (F.col("place") + width).alias("hi"), F.explode(blocks).alias("block")
    )
    right = entries.join(places, "cid").select("cid", "vec", "ids", "curve", "place", block.alias("block"))
    found = left.groupBy("curve", "block").cogroup(right.groupBy("curve", "block")).applyInPandas(_search(nearest), "qid long, vec_id long, score double")
    found = found.groupBy("qid", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("qid").orderBy("score", "vec_id")
    found = found.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= nearest + 1)
    out = queries.select("query_id", F.col("cid").alias("qid")).join(found, "qid").filter("vec_id <> query_id")
    out = out.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    out = out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= nearest)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
