import numpy as np

from croploom.functions import validity as V


def ring(*points):
    return np.array([*points, points[0]], dtype=float)


def test_parts_too_narrow_are_not_rasterised(monkeypatch):
    """A geometry that shrinking takes away whole, however long, costs no raster."""
    fills = []
    plain = V._fill
    monkeypatch.setattr(V, "_fill", lambda *a: fills.append(a) or plain(*a))
    nan, inf = float("nan"), float("inf")
    gone = [
        [[ring((nan, 0), (500, 0), (500, 400), (nan, 400))]],
        [[ring((0, 0), (inf, 0), (inf, 400), (0, 400))]],
        [[ring((0, 0), (1.3, 0), (1.3, 500), (0, 500))]],
    ]
    assert [V.repair3(g) for g in gone] == [None] * 3 and not fills
    assert V.repair_batch(gone[:2])[1] == [9, 9] and not fills
    # at the limit the raster decides, and says what it says for a geometry moved by whole cells
    for width in (1.45, 1.6, 1.9, 2.0, 2.1, 3.0):
        at = [V.repair3([[ring((x, 0), (x + width, 0), (x + width, 40), (x, 40))]]) is None for x in (0.0, 40.0)]
        assert at[0] == at[1] == (width < 1.8)
    assert fills


def test_loops_alone_keep_their_points():
    loop = ring((0, 0), (4, 0), (4, 3))
    for winding in (True, False):
        for one in (loop, loop[::-1]):
            (poly,) = V._assemble([one], winding)
            assert np.array_equal(poly[0], loop) or np.array_equal(poly[0], loop[::-1])
            assert V.signed_area(poly[0]) > 0


def test_short_rings_are_measured_as_long_ones(monkeypatch):
    from croploom.functions import rings as R

    rng = np.random.default_rng(8)
    some = [ring(*rng.integers(0, 20, (n, 2)).tolist()) for n in (3, 4, 5, 7) for _ in range(40)]
    measures = lambda: [(R.signed_area(r), R.inner_point(r), R.holds(r, 9.5, 9.25)) for r in some]
    short = measures()
    monkeypatch.setattr(R, "SHORT", 0)
    assert measures() == short


def test_last_repair_step_holds_runs_and_draws_few_corners(monkeypatch):
    from croploom.functions import outline as O

    filled, drawn = [], []
    plain, steps = V._fill, O._border_steps
    monkeypatch.setattr(V, "_fill", lambda *a: filled.append(plain(*a)) or filled[-1])
    monkeypatch.setattr(O, "_border_steps", lambda runs: drawn.append(len(runs)) or steps(runs))
    parts = [[ring((0, 0), (400, 0), (400, 300), (0, 300))], [ring((200, 150), (600, 150), (600, 450), (200, 450))]]
    (poly,) = V.repair3(parts)
    assert sum(f.size for f in filled) < 10_000 and drawn[0] < 20
    assert abs(V.signed_area(np.array(poly[0])) - (2 * 400 * 300 - 200 * 150 - 2.88)) < 1e-6


def test_validity_of_a_repair_repairs_once(spark):
    from pyspark.sql import functions as F

    from croploom.operators import quality as Q
    from croploom.schema import GEOM

    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    bow = [(0.0, 0.0), (9.0, 9.0), (0.0, 9.0), (9.0, 0.0), (0.0, 0.0)]
    large = [(float(k), float(k * k % 7)) for k in range(30)]
    df = spark.createDataFrame([(i, [[bow if i < 6 else large + large[:1]]]) for i in range(8)], f"id long, geom {GEOM.simpleString()}")
    df = df.mapInArrow(counted, df.schema)
    out = Q.with_validity(Q.repair_layer(df), most_points=10).orderBy("id").withColumn("a", F.size("geom")).collect()
    assert [r.id for r in out] == list(range(8)) and [r.method for r in out[:6]] == [1] * 6 and all(r.valid for r in out)
    assert seen.value == 8
