"""Validity of geometries of any size: edges meet in cells, rings in bands.

A geometry's edges are cut into horizontal bands and, within each, into cells by where they run there, so
that two edges that meet share a cell.  Cells are keyed by row and place, and a worker holds one cell's
edges at a time, compared along their left ends.  Which ring lies in which follows from the parity of a
ring's edges to the right of a point of another one, for all rings of a band in one join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from croploom.functions.rings import Contacts, candidate_pairs
from croploom.session import materialise

CELL_EDGES = 256  # edges of a cell, were they spread evenly
HELD = 200_000  # edges handed on together, whole cells

_BOX = ["_x0", "_x1", "_y0", "_y1", "_k", "_m"]  # a geometry's extent, its cells each way, its bands of rings

# Rings without repeated points; NaN is equal to itself here, and caught by the test for finite numbers.
_CLEAN = "transform({g}, poly -> transform(poly, r -> filter(r, (p, i) -> i = 0 or p != r[i - 1])))"
_TWICE = "aggregate(sequence(1, size(r) - 1), 0D, (s, i) -> s + (r[i - 1].x - r[0].x) * (r[i].y - r[0].y) - (r[i].x - r[0].x) * (r[i - 1].y - r[0].y))"
_WELL_FORMED = f"""size({{g}}) > 0 and forall({{g}}, poly -> size(poly) > 0 and forall(poly, r -> coalesce(size(r) >= 4
    and forall(r, p -> p.x - p.x = 0 and p.y - p.y = 0) and r[0] = r[size(r) - 1] and {_TWICE} != 0, false)))"""


def _edges(big: DataFrame) -> DataFrame:
    """One row per edge: its ring (of n edges) and place there, ends from left to right, box and grid of its geometry."""
    rings = big.select("_row", *_BOX, F.posexplode("_clean").alias("poly", "_p")).select("_row", *_BOX, "poly", F.posexplode("_p").alias("ring", "_r"))
    placed = rings.select("_row", *_BOX, "poly", "ring", F.expr("size(_r) - 1").alias("n"), F.expr("posexplode(transform(sequence(1, size(_r) - 1), i -> named_struct('a', _r[i - 1], 'b', _r[i])))").alias("place", "e"))
    return placed.select("_row", *_BOX, "poly", "ring", "n", "place", F.col("e.a.x").alias("x0"), F.col("e.a.y").alias("y0"), F.col("e.b.x").alias("x1"), F.col("e.b.y").alias("y1"))


def _in_cells(edges: DataFrame) -> DataFrame:
    """Every edge once for each cell that it runs through, in a grid of k by k over its geometry."""
    high, wide = "greatest(_y1 - _y0, 1e-300)", "greatest(_x1 - _x0, 1e-300)"
    # a little wider than it is, for the rounding of what follows
    band = lambda y, up: f"cast(least(greatest(floor(({y} - _y0) / {high} * _k {up} 1e-6), 0), _k - 1) as int)"
    edges = edges.withColumn("band", F.expr(f"explode(sequence({band('least(y0, y1)', '-')}, {band('greatest(y0, y1)', '+')}))"))
    # where the edge enters and leaves the band, as shares of it
    at = lambda b: f"case when y1 = y0 then 0D else (_y0 + {b} * {high} / _k - y0) / (y1 - y0) end"
    low, upper = at("(band - 1e-6)"), at("(band + 1 + 1e-6)")
    edges = edges.withColumns({"_s": F.expr(f"case when y1 = y0 then 0D else least(greatest(least({low}, {upper}), 0D), 1D) end"), "_t": F.expr(f"case when y1 = y0 then 1D else least(greatest(greatest({low}, {upper}), 0D), 1D) end")})
    xs, xt = "(x0 + _s * (x1 - x0))", "(x0 + _t * (x1 - x0))"
    cell = lambda x, up: f"cast(least(greatest(floor(({x} - _x0) / {wide} * _k {up} 1e-6), 0), _k - 1) as int)"
    return edges.withColumn("cell", F.expr(f"explode(sequence({cell(f'least({xs}, {xt})', '-')}, {cell(f'greatest({xs}, {xt})', '+')}))")).drop("_s", "_t", *_BOX)


def _meet(table: pa.Table) -> np.ndarray:
    """Rows of which some edge of a cell meets another one as it must not."""
    cols = {c: table.column(c).to_numpy() for c in table.column_names}
    segs = np.column_stack([cols[c] for c in ("x0", "y0", "x1", "y1")])
    keys = np.stack([cols["_row"], cols["band"], cols["cell"]])
    group = np.concatenate([[0], np.cumsum((keys[:, 1:] != keys[:, :-1]).any(axis=0))])
    ring = np.stack([cols["poly"], cols["ring"]])
    bad = []
    for i, j in candidate_pairs(segs, group):
        c = Contacts(segs, i, j)
        same = (ring[:, i] == ring[:, j]).all(axis=0)
        gap = np.abs(cols["place"][i] - cols["place"][j])
        neighbours = same & ((gap == 1) | (gap == cols["n"][i] - 1))
        at_corner = (c.t == 0) | (c.t == 1) | (c.u == 0) | (c.u == 1)
        wrong = c.stretch | (same & ~neighbours & (c.crossing | c.along)) | (~same & c.crossing & ~at_corner)
        bad.append(cols["_row"][i[wrong]])
    return np.unique(np.concatenate(bad)) if bad else np.zeros(0, np.int64)


def _crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose edges meet wrongly; batches come ordered by cell, and only whole cells are looked at."""
    held: list[pa.RecordBatch] = []
    n = 0

    def out(table: pa.Table) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(_meet(table) if table.num_rows else [], pa.int64())], names=["_row"])

    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= HELD:
            table = pa.Table.from_batches(held).combine_chunks()
            keys = np.stack([table.column(c).to_numpy() for c in ("_row", "band", "cell")])
            last = int(np.flatnonzero((keys != keys[:, -1:]).any(axis=0)).max(initial=-1)) + 1
            yield out(table.slice(0, last))
            held = table.slice(last).to_batches()
            n = table.num_rows - last
    if held:
        yield out(pa.Table.from_batches(held).combine_chunks())


def crossing_rows(edges: DataFrame) -> DataFrame:
    """``_row`` of the geometries with a ring that meets itself or edges that cross."""
    fields = ["_row", "band", "cell", "poly", "ring", "n", "place", "x0", "y0", "x1", "y1"]
    cells = _in_cells(edges).select(*fields)
    return cells.repartition("_row", "band", "cell").sortWithinPartitions("_row", "band", "cell").mapInArrow(_crossed, "_row long").distinct()


def _probes(big: DataFrame) -> DataFrame:
    """For each ring a point inside it, just above its lowest corner, and its area."""
    ring = big.select("_row", *_BOX, F.posexplode("_clean").alias("poly", "_p")).select("_row", *_BOX, "poly", F.posexplode("_p").alias("ring", "r"))
    ring = ring.withColumn("area", F.abs(F.expr(_TWICE))).withColumn("low", F.expr("array_min(transform(r, p -> p.y))"))
    ring = ring.withColumn("py", F.expr("(low + array_min(transform(filter(r, p -> p.y > low), p -> p.y))) / 2"))
    at = "r[i - 1].x + (py - r[i - 1].y) * (r[i].x - r[i - 1].x) / (r[i].y - r[i - 1].y)"
    xs = f"array_sort(transform(filter(sequence(1, size(r) - 1), i -> (r[i - 1].y > py) != (r[i].y > py)), i -> {at}))"
    ring = ring.withColumn("_xs", F.expr(f"slice({xs}, 1, 2)"))
    return ring.select("_row", *_BOX, "poly", "ring", "area", "py", F.expr("(_xs[0] + _xs[1]) / 2").alias("px"))


def nesting_rows(big: DataFrame, edges: DataFrame) -> DataFrame:
    """``_row`` of the geometries with a hole outside of its outline or in another hole, or a part in a part.

    For geometries whose rings do not cross.
    """
    probes = materialise(_probes(big), "ring-probes")
    rings = probes.select("_row", "poly", "ring", "area")
    band = lambda y: f"cast(least(greatest(floor(({y} - _y0) / greatest(_y1 - _y0, 1e-300) * _m), 0), _m - 1) as int)"
    others = edges.withColumn("band", F.expr(f"explode(sequence({band('least(y0, y1)')}, {band('greatest(y0, y1)')}))"))
    own = probes.withColumn("band", F.expr(band("py"))).select(
        "_row", "band", "px", "py", F.col("poly").alias("p"), F.col("ring").alias("r"), F.col("area").alias("a")
    )
    met = others.join(own, ["_row", "band"]).where("(poly != p or ring != r) and (y0 > py) != (y1 > py) and x0 + (py - y0) * (x1 - x0) / (y1 - y0) > px")
    around = met.groupBy("_row", "p", "r", "a", "poly", "ring").agg((F.count(F.lit(1)) % 2).alias("odd")).where("odd = 1")
    around = around.join(rings, ["_row", "poly", "ring"]).where("area > a")
    inside = materialise(around.select("_row", "p", "r", "poly", "ring"), "ring-nesting")

    homes = inside.where("r > 0 and poly = p and ring = 0").select("_row", "p", "r")
    astray = rings.where("ring > 0").select("_row", F.col("poly").alias("p"), F.col("ring").alias("r")).join(homes, ["_row", "p", "r"], "left_anti")
    twice = inside.where("r > 0 and ring > 0 and poly = p")
    parts = inside.where("r = 0 and poly != p").groupBy("_row", "p", "poly").agg(F.min("ring").alias("outline"), F.max("ring").alias("hole"))
    return astray.select("_row").unionByName(twice.select("_row")).unionByName(parts.where("outline = 0 and hole = 0").select("_row")).distinct()


def large_validity(df: DataFrame, geom: str = "geom", cell_edges: int = CELL_EDGES) -> DataFrame:
    """``df`` with ``valid`` for geometries of any size; ``df`` is stored once, with a row key.

    The rules are those of ``validity.is_valid``: rings closed, of four points or more and of some area, not
    meeting themselves, and crossing no other; holes in their outline, parts not in parts.
    """
    low = lambda c, f: F.expr(f"{f}(transform(_points, p -> p.{c}))").alias(f"_{c}{0 if f == 'array_min' else 1}")
    stored = materialise(df.withColumn("_row", F.monotonically_increasing_id()), "large-geometries")
    formed = stored.select("_row", F.col(geom).alias("_g")).where(F.expr(_WELL_FORMED.format(g="_g")))
    big = formed.select("_row", F.expr(_CLEAN.format(g="_g")).alias("_clean"), F.flatten(F.flatten("_g")).alias("_points"))
    big = big.where("forall(_clean, poly -> forall(poly, r -> size(r) >= 4))")
    count = F.expr("aggregate(_clean, 0, (s, poly) -> s + size(poly))")
    box = [
        *(low(c, f) for c in "xy" for f in ("array_min", "array_max")),
        F.greatest(F.lit(1), F.ceil(F.sqrt(F.size("_points") / cell_edges))).cast("int").alias("_k"),
        F.least(F.ceil(F.size("_points") / cell_edges), 4 * count).cast("int").alias("_m"),
    ]
    big = materialise(big.select("_row", "_clean", *box), "large-rings")
    edges = _edges(big)
    crossed = materialise(crossing_rows(edges), "large-crossed")
    apart = materialise(big.join(crossed, "_row", "left_anti"), "large-uncrossed")
    several = apart.where("size(_clean) > 1 or size(_clean[0]) > 1")
    wrong = nesting_rows(several, _edges(several))
    good = apart.select("_row").join(wrong, "_row", "left_anti").withColumn("_good", F.lit(True))
    out = stored.join(good, "_row", "left").drop("_row")
    empty = F.size(geom) == 0
    return out.withColumn("valid", F.when(F.col(geom).isNotNull(), F.coalesce("_good", empty))).drop("_good")
