import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from croploom.llm import centroids as C

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, k=C.CENTROIDS, rounds=C.ROUNDS, size=C.SIZE):
    """The contract with whole numbers and loops over everything."""
    kept = [
        (i, [math.floor(256 * float(np.float32(x))) for x in e])
        for i, e in rows
        if e is not None and len(e) == size and all(x is not None and math.isfinite(x) for x in e)
    ]
    first = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    cs = [v for _, v in first]
    if not cs:
        return []

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cs)) for _, v in kept]

    for _ in range(rounds):
        own = assign()
        for n in range(len(cs)):
            mine = [v for (_, v), (_, c) in zip(kept, own) if c == n]
            if mine:
                cs[n] = [sum(col) // len(mine) for col in zip(*mine)]
    own = assign()
    per = {n: sum(d for d, c in own if c == n) for _, n in own}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return [(i, n, d, per[n], sum(per.values()), sha[n]) for (i, _), (d, n) in zip(kept, own)]


def check(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("v", "p", "cluster", "distance"):
        df = df.withColumn(c, F.lit(1))
    got = [tuple(r) for r in C.cluster(df, **kw).collect()]
    assert sorted(got, key=str) == sorted(plain(rows, **kw), key=str)
    return got


def vectors(n, size, seed=3, spread=1.0):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(7, size)) * 3
    return [(i, [float(x) for x in np.float32(middle[i % 7] + rng.normal(size=size) * spread)]) for i in range(n)]


def test_against_comparing_everything(spark):
    check(spark, vectors(300, 64))


def test_ties_repeated_rows_and_empty_clusters(spark):
    rows = [(i, [float(i % 3)] * 4) for i in range(60)] + [(7, [1.0] * 4)] * 30
    got = check(spark, rows, k=8, rounds=3, size=4)
    assert len({r[1] for r in got}) < 4


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(1, None), (2, []), (3, [1.0]), (4, [1.0, None, 2.0, 3.0]), (5, [float("nan")] * 4), (6, [float("inf"), 0.0, 0.0, 0.0])],
        [(None, [1.0, 2.0, 3.0, 4.0])],
        [(None, [1.0, 2.0, 3.0, 4.0]), (2, [1.5, 2.0, -3.0, 4.0]), (2, [0.0, 0.0, 0.0, -0.001]), (3, [0.0] * 4)],
    ],
    ids=["empty", "unusable", "no_id", "few"],
)
def test_special_tables(spark, rows):
    check(spark, rows, k=5, rounds=2, size=4)


def test_too_large_numbers_take_no_part(spark):
    rows = [(1, [1e30, 0.0]), (2, [-3e38, 0.0]), (3, [1000.0, 0.5]), (4, [-7.0, 2.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r.vec_id for r in C.cluster(df, k=2, rounds=2, size=2).collect()} == {3, 4}


def test_bounds_skip_comparisons_and_lose_nothing():
    v = np.array([[int(256 * x) for x in e] for _, e in vectors(2000, 64, spread=0.1)], np.int64)
    cs = v[:: len(v) // 40][:40]
    pivots = C._spread(cs, 12)
    p = np.sqrt(np.stack([C.squared(v, q[None, :]) for q in pivots], axis=1).astype(float))
    to = np.sqrt(np.stack([C.squared(cs, q[None, :]) for q in pivots], axis=1).astype(float))
    best, dist, taken = C.nearest(v, p, cs, to)
    every = ((v[:, None, :] - cs[None, :, :]) ** 2).sum(axis=2)
    assert (best == every.argmin(axis=1)).all() and (dist == every.min(axis=1)).all()
    assert taken < len(v) * len(cs) / 4


def test_large_sums_are_exact(spark):
    rows = [(i, [500_000.0 - i / 256, -500_000.0]) for i in range(50)]
    check(spark, rows, k=3, rounds=3, size=2)
