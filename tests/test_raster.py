from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from croploom.functions import geometry as G
from croploom.operators import grid as GR
from croploom.operators import raster as R
from croploom.operators import stack as S
from croploom.operators import tracing as TR
from croploom.schema import GEOM

LAYER = StructType(
    [
        StructField("nuts", StringType()),
        StructField("year", IntegerType()),
        StructField("cropfield", LongType()),
        StructField("original_code", StringType()),
        StructField("geom", GEOM),
    ]
)


def star(rng, cx, cy, n, lo, hi):
    angle = np.sort(rng.uniform(0, 2 * np.pi, n))
    radius = rng.uniform(lo, hi, n)
    pts = [(float(cx + r * np.cos(a)), float(cy + r * np.sin(a))) for a, r in zip(angle, radius)]
    return [*pts, pts[0]]


def box(x0, y0, x1, y1):
    return [[[(float(x0), float(y0)), (float(x1), float(y0)), (float(x1), float(y1)), (float(x0), float(y1)), (float(x0), float(y0))]]]


def inside(poly, x, y):
    hits = np.zeros(x.shape, dtype=int)
    for ring in poly:
        for (ax, ay), (bx, by) in zip(ring[:-1], ring[1:]):
            if ay == by:
                continue
            rows = (np.minimum(ay, by) <= y) & (np.maximum(ay, by) > y)
            hits += rows & (ax + (y - ay) * (bx - ax) / (by - ay) <= x)
    return hits % 2 == 1


def test_rasterise_random_polygons(spark):
    rng = np.random.default_rng(9)
    layers, want = [], {}
    for k in range(1, 31):
        cx, cy = rng.uniform(0, 3000, 2)
        outer = star(rng, cx, cy, 14, 300, 1200)
        hole = star(rng, cx, cy, 9, 20, 60)
        layers.append(("a", 2020, k, "x", [[outer, hole]]))
        ks = np.arange(-200, 900)
        x, y = np.meshgrid((ks + 0.5) * 5, (ks + 0.5) * 5)
        yy, xx = np.nonzero(inside([outer, hole], x, y))
        want[k] = {(int(ks[b]), int(ks[a])) for a, b in zip(yy, xx)}
    runs = R.rasterise(spark.createDataFrame(layers, LAYER), 5)
    got = {}
    for r in R.pixels(runs).collect():
        got.setdefault(r.cf, set()).add((r.px, r.py))
    assert got == want
    assert runs.where("x1 - x0 > 512 or floor(x0 / 512) <> floor((x1 - 1) / 512)").count() == 0


def brute_stack(boxes, years, scale, min_pixels, inset):
    """The overlay on a plain pixel dictionary."""
    pixel = {}
    for year, cf, (x0, y0, x1, y1) in boxes:
        for px in range(int(np.ceil(x0 / scale - 0.5)), int(np.ceil(x1 / scale - 0.5))):
            for py in range(int(np.ceil(y0 / scale - 0.5)), int(np.ceil(y1 / scale - 0.5))):
                ids = pixel.setdefault((px, py), dict.fromkeys(years, 0))
                ids[year] = max(ids[year], cf)
    support = {}
    for ids in pixel.values():
        for y, v in ids.items():
            support[y, v] = support.get((y, v), 0) + 1
    label = {p: tuple(v if support[y, v] >= min_pixels else 0 for y, v in ids.items()) for p, ids in pixel.items()}
    label = {p: t for p, t in label.items() if any(t)}
    size = {}
    for t in label.values():
        size[t] = size.get(t, 0) + 1
    out = {}
    for (px, py), t in label.items():
        near = all(label.get((px + a, py + b)) == t for a in (-1, 0, 1) for b in (-1, 0, 1))
        if size[t] >= min_pixels and (near or not inset):
            out[t] = out.get(t, 0) + 1
    return out


@pytest.mark.parametrize("inset", [True, False])
def test_stack_against_brute_force(spark, inset):
    rng = np.random.default_rng(21)
    years = [2019, 2020, 2021]
    boxes = []
    for k in range(1, 70):
        x, y = rng.integers(0, 3000, 2)
        w, h = rng.integers(4, 400, 2)
        boxes.append((int(rng.choice(years)), k, (x, y, x + w, y + h)))
    pc = spark.createDataFrame([("a", y, k, "x", box(*b)) for y, k, b in boxes], LAYER)
    stack = S.rotation_stack(pc, years, 4, min_ha=0, inset=inset).collect()
    got = {tuple(r[f"cf{y}"] or 0 for y in years): r.n_pixels for r in stack}
    assert got == brute_stack(boxes, years, 4, 10, inset)
    assert sorted(r.cropfield for r in stack) == list(range(1, len(stack) + 1))


def brute_sequential(boxes, years, scale, min_pixels):
    """Labels built year after year on a plain pixel dictionary; borders are not taken in."""
    pixel = {}
    for year, cf, (x0, y0, x1, y1) in boxes:
        for px in range(int(np.ceil(x0 / scale - 0.5)), int(np.ceil(x1 / scale - 0.5))):
            for py in range(int(np.ceil(y0 / scale - 0.5)), int(np.ceil(y1 / scale - 0.5))):
                ids = pixel.setdefault((px, py), dict.fromkeys(years, 0))
                ids[year] = max(ids[year], cf)

    def strong(values):
        n = Counter(values.values())
        return {p: v if n[v] >= min_pixels else 0 for p, v in values.items()}

    label = strong({p: ids[years[0]] for p, ids in pixel.items()})
    for y in years[1:]:
        this = strong({p: ids[y] for p, ids in pixel.items()})
        pair = strong({p: (label[p], this[p]) for p in pixel})
        label = {p: 0 if pair[p] == 0 or (label[p] == 0 and this[p] == 0) else pair[p] for p in pixel}
    members = {}
    for p, v in label.items():
        if v != 0:
            members.setdefault(v, []).append(p)
    out = Counter()
    for ps in members.values():
        ids = tuple(int(np.rint(np.median([pixel[p][y] for p in ps]))) for y in years)
        out[ids] += len(ps)
    return dict(out)


def test_sequential_labels_against_brute_force(spark):
    rng = np.random.default_rng(33)
    years = [2018, 2019, 2020, 2021]
    boxes = []
    for k in range(1, 130):
        x, y = rng.integers(0, 800, 2)
        w, h = rng.integers(4, 150, 2)
        boxes.append((int(rng.choice(years)), k, (x, y, x + w, y + h)))
    pc = spark.createDataFrame([("a", y, k, "x", box(*b)) for y, k, b in boxes], LAYER)
    stack = S.rotation_stack(pc, years, 4, min_ha=0, inset=False, sequential=True).collect()
    got = {tuple(r[f"cf{y}"] or 0 for y in years): r.n_pixels for r in stack}
    want = brute_sequential(boxes, years, 4, 10)
    assert got == want
    plain = S.rotation_stack(pc, years, 4, min_ha=0, inset=False).collect()
    assert got != {tuple(r[f"cf{y}"] or 0 for y in years): r.n_pixels for r in plain}


def test_sequential_labels_over_tiles_regions_and_copies(spark, monkeypatch):
    """Several tiles and regions, parcels that come twice, ids that are null: labels fall back and start anew."""
    rng = np.random.default_rng(7)
    years = [2018, 2019, 2020]
    rows, want, moved = [], {}, []
    for nuts in ("a", "b", None):
        boxes = []
        for k in range(1, 90):
            x, y = rng.integers(0, 500, 2) + 1900
            w, h = rng.integers(3, 40, 2) * rng.choice([1, 1, 6])
            boxes.append((int(rng.choice(years)), k % 40 + 1, (x, y, x + w, y + h)))
        rows += [(nuts, y, k, "x", box(*b)) for y, k, b in boxes + boxes[:9]] + [(nuts, 2018, None, "x", box(1900, 1900, 1950, 1950))]
        if nuts:
            want |= {(nuts, *ids): n for ids, n in brute_sequential(boxes, years, 4, 10).items()}
    plain = S.median_by
    monkeypatch.setattr(S, "median_by", lambda df, by, *a, **b: moved.append(df) or plain(df, by, *a, **b))
    pc = spark.createDataFrame(rows, LAYER)
    stack = S.rotation_stack(pc, years, 4, min_ha=0, inset=False, sequential=True, numbered=False).collect()
    assert {(r.nuts, *[r[f"cf{y}"] or 0 for y in years]): r.n_pixels for r in stack} == want
    # in a year that a label has an id of there is no median to be found
    assert moved[0].where("case year " + " ".join(f"when {y} then _f{y}" for y in years) + " end != 0").isEmpty()


def test_stack_geometry_over_tiles(spark):
    pc = spark.createDataFrame([("a", 2020, 1, "x", box(0, 0, 3000, 2000)), ("a", 2020, 2, "y", box(4000, 0, 4100, 100))], LAYER)
    runs = S.stack_runs(pc, [2020], 2, inset=False)
    for tile in (100, 512, 100_000):
        rows = TR.stack_geometry(runs, ["nuts", "cf2020"], 2, tile=tile).collect()
        assert sorted(r.cf2020 for r in rows) == [1, 2]
        assert len({r.cf2020: r.geom for r in rows}[1][0][0]) == 5


@pytest.mark.parametrize("tile", [1, 3, 8, 64])
def test_outlines_do_not_depend_on_tiles(spark, tile):
    from croploom.functions import outline as O
    from croploom.functions.validity import valid_batch

    rng = np.random.default_rng(tile)
    rows, want = [], {}
    for label, share in (("a", 0.3), ("b", 0.6), (None, 0.75), ("c", 0.9), ("d", 1.0)):
        grid = rng.random((20, 23)) < share
        if label == "d":  # rings in rings
            y, x = np.indices(grid.shape)
            grid = np.minimum(np.minimum(x, 22 - x), np.minimum(y, 19 - y)) % 2 == 0
        own = [(int(y) - 7, int(x) - 5, int(x) - 4) for y, x in zip(*np.nonzero(grid))]
        rows += [(label, 1, *r) for r in own]
        want[label] = O.draw(np.array(own), 2.0), grid.sum()
    runs = spark.createDataFrame(rows, "nuts string, k int, py int, x0 int, x1 int")
    area = lambda polys: sum(O.signed_area(r) for p in polys for r in p)
    key = lambda polys: sorted((round(area([p]), 6), len(p), sorted(sorted(set(map(tuple, r))) for r in p)) for p in polys)
    got = TR.stack_geometry(runs, ["nuts", "k"], 2, tile=tile).collect()
    assert len(got) == len(want)
    for r in got:
        polys = [[[tuple(q) for q in ring] for ring in poly] for poly in r.geom]
        assert key(polys) == key(want[r.nuts][0]) and area(polys) == want[r.nuts][1] * 4
        assert valid_batch([polys]) == [True]
        assert all(O.signed_area(p[0]) > 0 and all(O.signed_area(h) < 0 for h in p[1:]) for p in polys)


def test_no_row_before_the_rings_holds_more_than_a_tile(spark):
    runs = spark.range(60).selectExpr("1 k", "cast(id as int) py", "0 x0", "cast(2 + id % 3 * 60 as int) x1")
    seen = []
    plain = TR.materialise
    TR.materialise = lambda df, label="stage": seen.append((label, plain(df, label))) or seen[-1][1]
    try:
        (row,) = TR.stack_geometry(runs, ["k"], 1, tile=16).collect()
    finally:
        TR.materialise = plain
    longest = {name: df.selectExpr("max(size(points))").first()[0] for name, df in seen if "points" in df.columns}
    assert set(longest) == {"tile-lines", "border-lines", "ring-parts"} and max(longest.values()) <= 4 * 16 < len(row.geom[0][0])


def test_no_runs_give_no_outlines(spark):
    assert TR.stack_geometry(spark.createDataFrame([], "k int, py int, x0 int, x1 int"), ["k"], 1).collect() == []


def test_rings_are_ordered_by_doubling(spark):
    from croploom.operators.listrank import cycles

    rng = np.random.default_rng(9)
    links, want, at = [], {}, 0
    for n in (1, 1, 2, 3, 64, 100, 257):
        ids = [int(x) for x in rng.permutation(n) + at]
        at += n
        start = ids.index(min(ids))
        for k, i in enumerate(ids):
            links.append((i, ids[(k + 1) % n]))
            want[i] = (min(ids), (k - start) % n)
    got = cycles(spark.createDataFrame(links, "id long, nxt long")).collect()
    assert {r.id: (r.ring, r.place) for r in got} == want
    assert cycles(spark.createDataFrame([], "id long, nxt long")).count() == 0


def test_coverage_gaps_stay_in_their_region(spark):
    points = spark.createDataFrame([("a", 10.0, 10.0), ("b", 10.0, 10.0)], "nuts string, cx double, cy double")
    assert [r.nuts for r in S.coverage_gaps(points, points.where("nuts = 'b'"), by=["nuts"]).collect()] == ["a"]


def test_many_copies_on_one_block(spark):
    """A pile of equal parcels on one spot, together a large part of all rows."""
    pile = spark.range(1, 20001).select(
        F.lit("a").alias("nuts"), F.lit(2020).alias("year"), F.col("id").alias("cropfield"), F.lit("x").alias("original_code"),
        F.lit(0.0).alias("xmin"), F.lit(0.0).alias("ymin"), F.lit(100.0).alias("xmax"), F.lit(100.0).alias("ymax"),
    )
    stack = S.rotation_stack(pile, [2020], 2, geom=None, inset=False).collect()
    assert [(r.cf2020, r.n_pixels) for r in stack] == [(20000, 2500)]


def test_grid_join_equals_nested_loop(spark):
    rng = np.random.default_rng(4)
    grid = GR.Grid(cell=100, x0=0, y0=0, cols=12, rows=9)
    rows = []
    for k in range(300):
        # Many limits fall on cell borders exactly; some parcels leave the grid.
        x0, y0 = (int(v) * 25 for v in rng.integers(-6, 50, 2))
        w, h = (int(v) * 25 for v in rng.integers(1, 14, 2))
        rows.append((k, float(x0), float(y0), float(x0 + w), float(y0 + h)))
    want = set()
    for k, x0, y0, x1, y1 in rows:
        for i in range(12):
            for j in range(9):
                cx, cy = i * 100, j * 100
                if x1 >= cx and x0 <= cx + 100 and y1 >= cy and y0 <= cy + 100:
                    m2 = max(min(x1, cx + 100) - max(x0, cx), 0) * max(min(y1, cy + 100) - max(y0, cy), 0)
                    want.add((k, i * 1000 + j, float(m2)))
    boxes = spark.createDataFrame(rows, "cropfield int, xmin double, ymin double, xmax double, ymax double")
    got = {tuple(r) for r in GR.grid_join(boxes, grid, geom=None).select("cropfield", "grd_id", "inter_m2").collect()}
    assert got == want
    shapes = boxes.select("cropfield", G.envelope(*[F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")]).alias("geom"))
    got = {tuple(r) for r in GR.grid_join(shapes, grid).select("cropfield", "grd_id", "inter_m2").collect()}
    assert got == want


def test_grid_area_is_parcel_area(spark):
    rng = np.random.default_rng(8)
    rows = [("a", 2020, k, "x", [[star(rng, *rng.uniform(2_660_000, 2_700_000, 1), 1_600_000, 12, 2000, 9000)]]) for k in range(20)]
    pc = spark.createDataFrame(rows, LAYER)
    cells = GR.grid_join(pc).groupBy("cropfield").agg(F.sum("inter_m2").alias("m2"))
    for r in pc.join(cells, "cropfield").select("m2", G.area(F.col("geom")).alias("a")).collect():
        assert r.m2 == pytest.approx(r.a, rel=1e-9)


def test_packed_runs_move_once_per_parcel_and_tile(spark):
    rng = np.random.default_rng(21)
    layers = []
    for k in range(1, 61):
        # stars over the borders of blocks (512 pixels) and bands (64 rows), some below zero, some without region or id
        cx, cy = rng.uniform(-600, 3200, 2)
        shape = [[star(rng, cx, cy, 12, 40, 700)]]
        layers.append((None if k % 9 == 0 else "ab"[k % 2], 2019 + k % 3, None if k == 7 else k, "x", shape))
    layers += [("a", 2020, 100 + k, "x", box(0, 0, 4 * k, 4)) for k in range(1, 4)]
    pc = spark.createDataFrame(layers, LAYER)
    plain = R.rasterise(pc, 3)
    tiled = R.rasterise(pc, 3, packed="tiles")
    tile = F.floor(F.col("py") / R.BAND).cast("int").alias("_band")
    parts = plain.select("nuts", "year", "cf", tile, "px").distinct().count()
    assert tiled.count() == parts < plain.count() / 8
    opened = tiled.withColumn("_r", F.explode(F.arrays_zip("_ys", "_x0s", "_x1s"))).select("nuts", "year", "cf", F.col("_r._ys").alias("py"), "px", F.col("_r._x0s").alias("x0"), F.col("_r._x1s").alias("x1"))
    rows = lambda df: Counter(tuple(r) for r in df.select(sorted(df.columns)).collect())
    assert rows(opened) == rows(plain)
    assert rows(R.burn(tiled)) == rows(R.burn(plain))
    assert rows(R.rare_values_of(tiled, 400)) == rows(R.rare_values(R.burn(plain), 400))
    years = [2019, 2020, 2021]
    for inset, form in ((False, "tiles"), (True, "halo")):
        got = R.overlay(R.rasterise(pc, 3, packed=form), years, inset=inset)
        assert rows(got) == rows(R.overlay(plain, years, inset=inset))
