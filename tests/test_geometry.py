import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from croploom.functions import crs
from croploom.functions import geometry as G
from croploom.functions import validity as V
from croploom.functions import wkb as W
from croploom.functions.nested import from_geometry_array
from croploom.functions.outline import draw
from croploom.operators import quality as Q
from croploom.schema import GEOM
from pyspark.sql.types import LongType, StructField, StructType


def ring(*pts):
    return [tuple(map(float, p)) for p in pts]


SQUARE = ring((0, 0), (10, 0), (10, 10), (0, 10), (0, 0))
HOLE = ring((2, 2), (2, 4), (4, 4), (4, 2), (2, 2))
CONCAVE = ring((0, 0), (30, 0), (30, 10), (20, 10), (20, 5), (10, 5), (10, 10), (0, 10), (0, 0))
BOW_TIE = ring((0, 0), (10, 10), (10, 0), (0, 10), (0, 0))
OPEN = SQUARE[:-1]
SPIKE = ring((0, 0), (10, 0), (10, 10), (15, 10), (10, 10), (0, 10), (0, 0))
TWICE = SQUARE[:-1] + SQUARE
FLAT = ring((0, 0), (10, 0), (5, 0), (0, 0))
REPEATED = ring((0, 0), (10, 0), (10, 0), (10, 10), (0, 10), (0, 0))
FIGURE_TOUCH = ring((0, 0), (4, 4), (8, 0), (8, 8), (4, 4), (0, 8), (0, 0))


def frame(spark, geoms):
    schema = StructType([StructField("id", LongType()), StructField("geom", GEOM)])
    return spark.createDataFrame([(i, g) for i, g in enumerate(geoms)], schema)


def values(df, col):
    return [r[0] for r in df.orderBy("id").select(col).collect()]


def test_area_and_centroid(spark):
    df = frame(spark, [[[SQUARE]], [[SQUARE, HOLE]], [[SQUARE, HOLE[::-1]]], [[CONCAVE]], [[SQUARE[::-1]]], [], None])
    assert values(df, G.area(F.col("geom"))) == [100, 96, 96, 250, 100, 0, None]
    c = values(df, G.centroid(F.col("geom")))
    assert (c[0].x, c[0].y) == (5, 5)
    assert c[1].x == pytest.approx((500 - 12) / 96) and c[2] == c[1]
    assert c[4] == c[0] and c[5] is None and c[6] is None
    b = values(df, G.bbox(F.col("geom")))
    assert tuple(b[3]) == (0, 0, 30, 10) and b[5] is None


def cell(*v):
    return [F.lit(float(x)) for x in v]


def test_clip_and_intersects(spark):
    df = frame(spark, [[[CONCAVE]], [[SQUARE, HOLE]]])
    g = F.col("geom")

    def one(i, *box):
        row = df.where(f"id = {i}").select(
            G.area(G.clip_cell(g, *cell(*box))), G.intersects_cell(g, *cell(*box))
        ).first()
        return row[0], row[1]

    assert one(0, 0, 0, 15, 10) == (125, True)
    # In the notch: inside the limits, but neither overlapping nor touching.
    assert one(0, 12, 6, 18, 9) == (0, False)
    # The notch's floor is touched.
    assert one(0, 12, 5, 18, 9) == (0, True)
    assert one(0, 30, 10, 40, 20) == (0, True)
    assert one(0, 30.001, 10, 40, 20) == (0, False)
    # Wholly within the hole, and wholly within the outline.
    assert one(1, 2.5, 2.5, 3.5, 3.5) == (0, False)
    assert one(1, 5, 5, 6, 6) == (1, True)
    assert one(1, -5, -5, 50, 50) == (96, True)


def test_clip_adds_up(spark):
    rng = np.random.default_rng(5)
    geoms = []
    for _ in range(40):
        angle = np.sort(rng.uniform(0, 2 * np.pi, 12))
        radius = rng.uniform(5, 45, 12)
        pts = np.column_stack([50 + radius * np.cos(angle), 50 + radius * np.sin(angle)])
        outer = ring(*pts, pts[0])
        geoms.append([[outer]])
    df = frame(spark, geoms)
    parts = (
        df.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(9))))
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(9))))
        .withColumns({"x": (F.col("i") * 10).cast("double"), "y": (F.col("j") * 10).cast("double")})
        .withColumn("a", G.area(G.clip_cell(F.col("geom"), F.col("x"), F.col("y"), F.col("x") + 10, F.col("y") + 10)))
        .groupBy("id")
        .agg(F.sum("a").alias("s"))
    )
    rows = df.withColumn("a", G.area(F.col("geom"))).join(parts, "id").select("a", "s").collect()
    assert all(r.s == pytest.approx(r.a, rel=1e-9) for r in rows)


def test_laea_check_point(spark):
    p = spark.range(1).select(crs.to_3035(F.lit(5.0), F.lit(50.0)).alias("p")).first().p
    assert p.x == pytest.approx(3962799.45, abs=0.01) and p.y == pytest.approx(2999718.85, abs=0.01)


def test_wkb_round_trip(spark):
    geoms = [[[SQUARE, HOLE], [CONCAVE]], [], None]
    df = frame(spark, geoms)
    back = values(df, W.from_wkb(W.to_wkb("geom")))
    assert [None if g is None else [[[tuple(p) for p in r] for r in poly] for poly in g] for g in back] == geoms


def _polygon(order, kind, dims, pts):
    body = struct.pack(order + "II", 1, len(pts)) + b"".join(struct.pack(order + f"{dims}d", *p) for p in pts)
    return struct.pack(order + "BI", 1 if order == "<" else 0, kind) + body


def test_wkb_variants():
    flat = _polygon("<", 3, 2, SQUARE)
    assert [len(r) for r in W.decode(flat)[0]] == [5]
    big = _polygon(">", 3, 2, SQUARE)
    assert np.array_equal(W.decode(big)[0][0], W.decode(flat)[0][0])
    raised = _polygon("<", 1003, 3, [(*p, 7.0) for p in SQUARE])
    assert np.array_equal(W.decode(raised)[0][0], W.decode(flat)[0][0])
    extended = _polygon("<", 0x80000003, 3, [(*p, 7.0) for p in SQUARE])
    assert np.array_equal(W.decode(extended)[0][0], W.decode(flat)[0][0])
    point = struct.pack("<BIdd", 1, 1, 1.0, 2.0)
    line = struct.pack("<BII4d", 1, 2, 2, 0, 0, 1, 1)
    collection = struct.pack("<BII", 1, 7, 3) + point + flat + line
    assert len(W.decode(collection)) == 1
    values = [flat, big, raised, None, collection, point, b"\x01\x03", W.encode([[SQUARE]]), W.encode([[SQUARE], [SQUARE]]), W.encode([])]
    for chosen in (values, values[:1] * 3, values[7:8] * 2, [None], [], values[3:8]):
        got = from_geometry_array(W.decode_column(pa.array([None, *chosen], pa.binary()).slice(1)))
        want = [W.decode(v) for v in chosen]
        assert [g is None for g in got] == [w is None for w in want]
        for g, w in zip(got, want):
            assert g is None or [[r.tolist() for r in p] for p in g] == [[r.tolist() for r in p] for p in w]
    assert W.decode(b"\x01\x03") is None and W.decode(None) is None and W.decode(point) == []


def test_validity(spark):
    far = ring((100, 100), (101, 100), (101, 101), (100, 101), (100, 100))
    cases = {
        "square": ([[SQUARE]], True),
        "concave": ([[CONCAVE]], True),
        "hole": ([[SQUARE, HOLE]], True),
        "repeated": ([[REPEATED]], True),
        "bow-tie": ([[BOW_TIE]], False),
        "open": ([[OPEN]], False),
        "spike": ([[SPIKE]], False),
        "twice": ([[TWICE]], False),
        "flat": ([[FLAT]], False),
        "touch": ([[FIGURE_TOUCH]], False),
        "hole outside": ([[SQUARE, far]], False),
        "hole across": ([[SQUARE, ring((5, 5), (15, 5), (15, 8), (5, 8), (5, 5))]], False),
        "parts apart": ([[SQUARE], [far]], True),
        "parts overlap": ([[SQUARE], [ring((5, 5), (15, 5), (15, 15), (5, 15), (5, 5))]], False),
        "part in part": ([[SQUARE], [HOLE]], False),
        "part in hole": ([[SQUARE, HOLE], [ring((2.5, 2.5), (3.5, 2.5), (3.5, 3.5), (2.5, 3.5), (2.5, 2.5))]], True),
        "parts sharing an edge": ([[SQUARE], [ring((10, 0), (20, 0), (20, 10), (10, 10), (10, 0))]], False),
        "parts sharing a corner": ([[SQUARE], [ring((10, 10), (20, 10), (20, 20), (10, 20), (10, 10))]], True),
        "empty": ([], True),
        "null": (None, None),
    }
    df = Q.with_validity(frame(spark, [g for g, _ in cases.values()]))
    assert dict(zip(cases, values(df, "valid"))) == {k: v for k, (_, v) in cases.items()}


def test_repair(spark):
    cross_hole = [[SQUARE, ring((5, 5), (15, 5), (15, 8), (5, 8), (5, 5))]]
    sliver = [[ring((0, 0), (50, 0), (50, 0.5), (0, 0.5), (0, 0)), ring((10, 0.2), (60, 0.2), (60, 0.4), (10, 0.4), (10, 0.2))]]
    cases = {
        "square": ([[SQUARE]], 0, 100),
        "hole": ([[SQUARE, HOLE]], 0, 96),
        "bow-tie": ([[BOW_TIE]], 1, 50),
        "open": ([[OPEN]], 1, 100),
        "spike": ([[SPIKE]], 1, 100),
        "twice": ([[TWICE]], 3, 100),
        "touch": ([[FIGURE_TOUCH]], 1, 32),
        "hole across": (cross_hole, 4, None),
        "flat": ([[FLAT]], 9, 0),
        "sliver": (sliver, 9, None),
        "null": (None, None, None),
    }
    fixed = Q.repair_layer(frame(spark, [g for g, _, _ in cases.values()]))
    out = Q.with_validity(fixed).withColumn("a", G.area(F.col("geom"))).orderBy("id").collect()
    for (name, (_, method, area)), row in zip(cases.items(), out):
        assert row.method == method, name
        if method is not None:
            assert row.valid == (method != 9), name
        if area is not None:
            assert row.a == pytest.approx(area), name
    across = out[list(cases).index("hole across")]
    # Alternate filling: 85 of the square and 15 of the other ring beyond it, corners rounded.
    assert across.a == pytest.approx(100, abs=8)


def test_report_and_remaining(spark):
    df = frame(spark, [[[FLAT]]] * 5 + [[[BOW_TIE]], [[SQUARE]]]).withColumns({"nuts": F.lit("a"), "year": F.lit(2020), "cropfield": F.col("id")})
    fixed = Q.repair_layer(df)
    assert tuple(Q.validity_report(fixed).first()[2:]) == (6, 5, 5, 5)
    parts = Q.remaining_ids(fixed, per_row=2).orderBy("part").collect()
    assert [r.ids for r in parts] == ["0 1", "2 3", "4"]


def test_simplify(spark):
    bumpy = ring((0, 0), (5, 0.4), (10, 0), (10, 10), (5, 13), (0, 10), (0, 0))
    df = frame(spark, [[[bumpy]], [[ring((0, 0), (0.1, 0), (0.1, 0.1), (0, 0))]], None])
    out = values(df, V.simplify(F.col("geom"), 1.0))
    assert len(out[0][0][0]) == 6 and out[1] == [] and out[2] is None


def test_outline_shapes():
    # Two pixels touching at a corner stay two polygons.
    diagonal = draw(np.array([[0, 0, 1], [1, 1, 2]]), 1.0)
    assert len(diagonal) == 2
    # A frame has an outline and a hole.
    frame_runs = np.array([[0, 0, 3], [1, 0, 1], [1, 2, 3], [2, 0, 3]])
    (poly,) = draw(frame_runs, 2.0)
    assert len(poly) == 2 and len(poly[0]) == 5
    # Runs cut in two draw as one.
    (joined,) = draw(np.array([[0, 0, 2], [0, 2, 5], [1, 0, 5]]), 1.0)
    assert len(joined) == 1 and len(joined[0]) == 5


def test_outline_random():
    rng = np.random.default_rng(3)
    for _ in range(60):
        grid = rng.random((9, 9)) < 0.55
        ys, xs = np.nonzero(grid)
        polys = draw(np.column_stack([ys, xs, xs + 1]), 1.0)
        rings = [[np.array(r, dtype=float) for r in p] for p in polys]
        assert V.valid_batch([rings]) == [True]
        total = sum(abs(V.signed_area(p[0])) - sum(abs(V.signed_area(h)) for h in p[1:]) for p in rings)
        assert total == grid.sum()


def test_batch_equals_one_by_one():
    rng = np.random.default_rng(11)
    geoms = []
    for _ in range(400):
        pts = rng.integers(0, 6, (rng.integers(3, 7), 2)).astype(float)
        geoms.append([[np.vstack([pts, pts[:1]])]])
    assert V.valid_batch(geoms) == [V.valid_batch([g])[0] for g in geoms]
    assert V.repair_batch(geoms)[1] == [V.repair_batch([g])[1][0] for g in geoms]


def even_odd(ring, x, y):
    a = np.asarray(ring, dtype=float)
    return sum(((p[1] > y) != (q[1] > y)) and x < p[0] + (y - p[1]) * (q[0] - p[0]) / (q[1] - p[1]) for p, q in zip(a[:-1], a[1:])) % 2


def test_first_repair_keeps_alternate_filling():
    """Random self-crossing rings: a repaired geometry covers what the ring's alternate filling does."""
    rng = np.random.default_rng(12)
    repaired = 0
    for _ in range(150):
        pts = rng.uniform(0, 100, (rng.integers(5, 10), 2))
        ring = np.vstack([pts, pts[:1]])
        (fixed,), (method,) = V.repair_batch([[[ring]]])
        if method != 1:
            continue
        repaired += 1
        for x, y in rng.uniform(0, 100, (40, 2)):
            inside = sum(even_odd(r, x, y) for poly in fixed for r in poly) % 2
            assert inside == even_odd(ring, x, y)
    assert repaired > 100


def test_last_repair_step_does_not_depend_on_its_bands(monkeypatch):
    from croploom.functions import validity as V

    geom = [[np.array([(0, 0), (60, 0), (60, 30), (30.3, 30), (30.3, 80), (30, 80), (30, 30), (0, 30), (0, 0)], float)]]
    whole = V.repair3(geom)
    monkeypatch.setattr(V, "BAND_CELLS", 1000)
    assert V.repair3(geom) == whole
    assert len(whole) == 1 and abs(abs(signed(whole[0][0])) - 1800) < 5  # the narrow tower goes


def test_last_repair_step_has_no_largest_size():
    from croploom.functions import validity as V

    wide = [[np.array([(0, 0), (2500, 0), (2500, 9000), (0, 9000), (0, 0)], float)]]
    assert abs(abs(signed(V.repair3(wide)[0][0])) - 2500 * 9000) < 5


def signed(ring):
    r = np.asarray(ring)
    return float((r[:-1, 0] * r[1:, 1] - r[1:, 0] * r[:-1, 1]).sum() / 2)


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), float("-inf")])
def test_rectangles_with_odd_coordinates_are_invalid(spark, bad):
    from croploom.operators import quality as Q
    from croploom.schema import GEOM

    ring = [(bad, 0.0), (5.0, 0.0), (5.0, 5.0), (bad, 5.0), (bad, 0.0)]
    df = spark.createDataFrame([(1, [[ring]])], f"id long, geom {GEOM.simpleString()}")
    assert [r.valid for r in Q.with_validity(df).collect()] == [False]
    assert [r.method for r in Q.repair_layer(df).collect()] == [9]


def test_convex_rings_are_settled_as_the_full_test_does(spark):
    from croploom.functions import validity as V
    from croploom.operators import quality as Q
    from croploom.schema import GEOM

    rng = np.random.default_rng(5)
    rings = []
    for n in range(3, 12):
        t = np.sort(rng.random(n)) * 2 * np.pi
        circle = [(float(np.round(3e6 + 90 * np.cos(a), 3)), float(np.round(2e6 + 50 * np.sin(a), 3))) for a in t]
        rings += [[*circle, circle[0]], circle[::-1] + [circle[-1]], circle, [circle[0], *circle, circle[0]], [*circle, circle[1], circle[0]]]
        star = [circle[(k * 2) % n] for k in range(n)]
        rings.append([*star, star[0]])
    rings += [[(0.0, 0.0), (1.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 0.0)], [(0.0, 0.0), (2.0, 0.0), (1.0, 0.0), (2.0, 2.0), (0.0, 0.0)]]
    rings += [[(0.0, 0.0), (1.0, 1.0), (0.0, 0.0)], [(0.0, 0.0), (1.0, 1.0), (2.0, 2.0), (0.0, 0.0)], [(0.0, 0.0)] * 5, [(0.0, 0.0), (1.0, 0.0)], []]
    df = spark.createDataFrame([(i, [[r]]) for i, r in enumerate(rings)], f"id long, geom {GEOM.simpleString()}")
    want = V.valid_batch([[[np.asarray(r, float).reshape(-1, 2)]] for r in rings])
    got = {r.id: r.valid for r in Q.with_validity(df).collect()}
    assert [got[i] for i in range(len(rings))] == want
    fixed = {r.id: r for r in Q.with_validity(Q.repair_layer(df)).withColumn("a", G.area(F.col("geom"))).collect()}
    full = dict(zip(range(len(rings)), zip(*V.repair_batch([[[np.asarray(r, float).reshape(-1, 2)]] for r in rings]))))
    for i, (geom, method) in full.items():
        assert fixed[i].method == method, rings[i]
        if method in (0, 1):
            assert fixed[i].valid and abs(abs(fixed[i].a) - abs(sum(signed(r) for p in geom for r in p))) < 0.1
    assert df.select(V.easy_ring(F.col("geom")).alias("e")).where("e is not null").count() > 30


def test_a_part_in_the_hole_of_another_is_valid():
    from croploom.functions.validity import valid_batch

    ring = lambda a, b: [(a, a), (b, a), (b, b), (a, b), (a, a)]
    frame = [ring(0, 10), ring(1, 9)[::-1]]
    for geom, want in (([frame, [ring(2, 8)]], True), ([[ring(2, 8)], frame], True), ([[ring(0, 10)], [ring(2, 8)]], False), ([[ring(2, 8)], [ring(0, 10)]], False)):
        assert valid_batch([geom]) == [want]


def test_plain_holes_and_parts_need_no_test_one_by_one(monkeypatch):
    slow = V._nested_rightly

    def box(x, y, w, h):
        return np.array([(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)], float)

    rng = np.random.default_rng(5)
    turn = np.array([[0.6, 0.8], [-0.8, 0.6]])
    geoms = []
    for k in range(3000):
        geom = [[box(*rng.integers(0, 8, 2), *rng.integers(1, 7, 2)) for _ in range(rng.integers(1, 4))] for _ in range(rng.integers(1, 4))]
        geoms.append([[r @ turn for r in poly] for poly in geom] if k % 3 == 0 else geom)
    # a hole that hangs on a notch of its outline, which is on no edge's inside
    notch = np.array([(0, 0), (4, 4), (8, 0), (8, 9), (0, 9), (0, 0)], float)
    geoms += [[[notch, np.array(h, float)]] for h in ([(4, 4), (6, 6), (2, 6), (4, 4)], [(4, 4), (5, 1), (3, 1), (4, 4)])]
    got = V.valid_batch(geoms)
    monkeypatch.setattr(V, "_clearly_nested", lambda geoms: np.zeros(len(geoms), bool))
    assert got == V.valid_batch(geoms)
    assert got[-2:] == [True, False]
    monkeypatch.undo()

    def refused(geom):
        raise AssertionError("tested one by one")

    monkeypatch.setattr(V, "_nested_rightly", refused)
    plain = [[[box(0, 0, 9, 9), box(2, 2, 3, 3)[::-1], box(6, 6, 2, 2)[::-1]]], [[box(0, 0, 2, 9)], [box(3, 0, 2, 9)]]]
    assert V.valid_batch(plain) == [True, True]
    monkeypatch.setattr(V, "_nested_rightly", slow)
    assert V.valid_batch([[[box(0, 0, 9, 9)], [box(1, 1, 2, 2)]]]) == [False]
