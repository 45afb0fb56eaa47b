"""Validity in cells against the test of whole geometries."""

import numpy as np
import pytest

from croploom.functions.validity import valid_batch
from croploom.operators import crossings as X
from croploom.operators import quality as Q
from croploom.schema import GEOM
from pyspark.sql.types import LongType, StructField, StructType

TABLE = StructType([StructField("id", LongType()), StructField("geom", GEOM)])


def star(rng, n, x=0.0, y=0.0, size=100.0):
    turn = np.sort(rng.random(n)) * 2 * np.pi
    r = size * (0.5 + 0.5 * rng.random(n))
    ring = [(float(x + a * np.cos(t)), float(y + a * np.sin(t))) for a, t in zip(r, turn)]
    return [*ring, ring[0]]


def square(a, b):
    return [(float(a), float(a)), (float(b), float(a)), (float(b), float(b)), (float(a), float(b)), (float(a), float(a))]


def comb(teeth, height=1000.0):
    ring = [(0.0, 0.0)]
    for k in range(teeth):
        ring += [(4.0 * k, height), (4.0 * k + 1, height), (4.0 * k + 2, 1.0), (4.0 * k + 3, 1.0)]
    ring += [(4.0 * teeth, 0.0), (0.0, 0.0)]
    return ring


def cases():
    rng = np.random.default_rng(6)
    out = [None, [], [[]], [[square(0, 1)[:3]]], [[[]]]]
    for n in (5, 40, 300):
        for kind in range(8):
            ring = star(rng, n)
            if kind == 1:  # two corners change places
                i, j = rng.integers(1, n - 1, 2)
                ring[i], ring[j] = ring[j], ring[i]
            if kind == 2:
                ring = ring[:-1]
            if kind == 3:  # a corner moved onto another edge
                i = int(rng.integers(1, n - 1))
                a, b = ring[(i + n // 2) % n], ring[(i + n // 2) % n + 1]
                ring[i] = ((a[0] + b[0]) / 2, (a[1] + b[1]) / 2)
            if kind == 4:  # repeated corners
                ring = [p for p in ring for _ in range(2)]
            if kind == 5:  # a spike
                i = int(rng.integers(1, n - 1))
                ring[i : i + 1] = [ring[i], (900.0, 900.0), ring[i]]
            if kind == 6:
                ring[2] = (float("nan"), 1.0)
            out.append([[ring]])
            hole = star(rng, max(4, n // 4), size=float(rng.choice([15.0, 45.0, 120.0])))
            out += [[[star(rng, n), hole]], [[star(rng, n)], [star(rng, n, x=float(rng.choice([150.0, 230.0])))]]]
    out += [[[comb(60)]], [[comb(60)[:-1]]], [[comb(60), [(1.0, 0.1), (200.0, 0.2), (200.0, 0.5), (1.0, 0.1)]]]]
    frame = [square(0, 10), square(1, 9)]
    out += [[frame, [square(2, 8)]], [frame, [square(3, 8), square(4, 7)], [square(5, 6)]], [[square(0, 10)], [square(2, 8)]]]
    out += [[[square(0, 10), square(20, 30)]], [[square(0, 10), square(1, 9), square(2, 8)]], [[square(0, 10), square(1, 3), square(4, 6)]]]
    out += [[[square(0, 10), square(0, 5)]], [[square(0, 10)], [square(10, 20)]], [[square(0, 10)], [square(0, 10)]]]
    out += [[[[(0.0, 0.0), (5.0, 5.0), (9.0, 9.0), (0.0, 0.0)]]], [[[(0.0, 0.0), (4.0, 4.0), (4.0, 0.0), (0.0, 4.0), (0.0, 0.0)]]]]
    return out


@pytest.mark.parametrize("cell_edges", [2, 64])
def test_cells_give_the_same_verdict(spark, cell_edges):
    geoms = cases()
    df = spark.createDataFrame(list(enumerate(geoms)), TABLE)
    got = dict(X.large_validity(df, cell_edges=cell_edges).select("id", "valid").collect())
    want = valid_batch([None if g is None else [[np.array(r, float).reshape(-1, 2) for r in p] for p in g] for g in geoms])
    assert [got[i] for i in range(len(geoms))] == want
    assert {True, False} <= set(want)


def test_large_and_small_geometries_side_by_side(spark):
    geoms = cases()
    df = spark.createDataFrame(list(enumerate(geoms)), TABLE)
    one, two = (dict(Q.with_validity(df, most_points=m).select("id", "valid").collect()) for m in (100, 10**6))
    assert one == two and len(one) == len(geoms)
    assert Q.with_validity(df.where("id < 0"), most_points=0).columns == ["id", "geom", "valid"]


def test_a_worker_holds_one_cell(spark):
    """Edges of a shape of many long upright ones are spread over cells that grow with its root."""
    ring = [[comb(2000)]]
    df = spark.createDataFrame([(1, ring)], TABLE)
    stored = X.materialise
    seen = {}
    X.materialise = lambda d, label="stage": seen.setdefault(label, stored(d, label))
    try:
        assert X.large_validity(df, cell_edges=256).first().valid
    finally:
        X.materialise = stored
    cells = X._in_cells(X._edges(seen["large-rings"])).groupBy("band", "cell").count()
    n, most, total = cells.selectExpr("count(*)", "max(count)", "sum(count)").first()
    assert n == 36 and most < 1500 and total < 7 * 8000
