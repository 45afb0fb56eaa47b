"""Neighbours along Hilbert curves against comparing everything."""

import math

import numpy as np

from croploom.llm import ann as A


def brute(rows, every=100, k=10):
    ok = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, qv in ok:
        if q % every == 0:
            best = out.setdefault(q, {})
            for i, v in ok:
                if i != q:
                    d = float(np.sqrt(((np.float64(qv) - np.float64(v)) ** 2).sum()))
                    best[i] = min(best.get(i, d), d)
    return {q: sorted((d, i) for i, d in b.items())[:k] for q, b in out.items()}


def check(df, rows, least, every=100):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(got[r.query_id])
    want = brute(rows, every)
    assert got.keys() == {q for q in want if want[q]}
    hit = total = 0
    for q, w in want.items():
        g = got.get(q, [])
        assert g == sorted(g) and len(g) == len(w) and len({i for _, i in g}) == len(g)
        hit += len({i for _, i in g} & {i for _, i in w})
        total += len(w)
    assert hit >= least * total


def test_hilbert_neighbours_differ_in_one_step():
    for m, bits in ((2, 4), (3, 3), (4, 2)):
        pts = np.stack(np.meshgrid(*[np.arange(1 << bits)] * m), -1).reshape(-1, m)
        key = A.hilbert(pts, bits)
        assert sorted(key) == list(range(len(pts)))
        assert (np.abs(np.diff(pts[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def test_recall_on_the_table(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(A.nearest_neighbours(spark.read.parquet(f"{sf}/embeddings.parquet")), rows, 0.95)


def test_recall_with_a_window_narrower_than_the_table(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(rng.normal(size=(3000, 12)))]
    check(A.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "vec_id % 25 = 0"), rows, 0.9, 25)


def test_copies_ties_and_unusable_rows(spark):
    one, nan, inf = [1.0, 0.0, 2.0], float("nan"), float("inf")
    rows = [(i, one) for i in range(300)] + [(i, [1.0, float(i), 2.0]) for i in range(300, 330)]
    rows += [(1000, None), (1100, [0.0] * 3), (1200, [1.0, nan, 0.0]), (1300, [inf, 0.0, 0.0]), (1400, [1.0, None, 0.0]), (1500, []), (None, one), (200, one)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 rank", "'x' score", "vec_id place")
    check(A.nearest_neighbours(df), rows, 1.0)
    few = rows[:3] + rows[-2:]
    check(A.nearest_neighbours(spark.createDataFrame(few, "vec_id long, embedding array<float>")), few, 1.0)
    assert A.nearest_neighbours(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    alone = [(100, one)]
    assert A.nearest_neighbours(spark.createDataFrame(alone, "vec_id long, embedding array<float>")).count() == 0
