"""Outlines of labelled runs, traced across tiles.

Each tile follows its own border lines; most labels lie in one tile, and their rings are closed there.
Border pixels on the lines between tiles cancel where two tiles run against each other.  What is left
are lines whose ends meet at points: a join finds each one's successor, pointer doubling finds ring and
place.  Until the rings are put together for the result, a row holds a line of one tile at most.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from croploom.functions.outline import CLOSED, EDGE, OPEN, border_lines
from croploom.operators.listrank import cycles
from croploom.session import materialise


def tile_runs(runs: DataFrame, label: Iterable[str], tile: int) -> DataFrame:
    """``_runs`` of each (label, tile), cut at the tile's borders."""
    label = list(label)
    cut = runs.withColumn("_tx", F.explode(F.sequence(F.floor(F.col("x0") / tile), F.floor((F.col("x1") - 1) / tile)))).select(
        *label,
        F.floor(F.col("py") / tile).alias("_ty"),
        "_tx",
        F.col("py").cast("int").alias("py"),
        F.greatest(F.col("x0"), F.col("_tx") * tile).cast("int").alias("x0"),
        F.least(F.col("x1"), (F.col("_tx") + 1) * tile).cast("int").alias("x1"),
    )
    return cut.groupBy(*label, "_ty", "_tx").agg(F.collect_list(F.struct("py", "x0", "x1")).alias("_runs"))


def _heading(a: Column, b: Column) -> Column:
    return F.struct(F.signum(b.x - a.x).cast("int").alias("x"), F.signum(b.y - a.y).cast("int").alias("y"))


def _lines_left(lines: DataFrame) -> DataFrame:
    """Open lines and the border pixels that no neighbouring tile runs against, with an ``id``."""
    ends = [F.col("points")[0], F.col("points")[1]]
    edges = (
        lines.where(F.col("kind") == EDGE)
        .groupBy("label", F.least(*ends).alias("a"), F.greatest(*ends).alias("b"))
        .agg(F.count(F.lit(1)).alias("n"), F.first("points").alias("points"))
        .where("n = 1")
    )
    left = lines.where(F.col("kind") == OPEN).select("label", "points").unionByName(edges.select("label", "points"))
    return materialise(left.withColumn("id", F.monotonically_increasing_id()), "border-lines")


def _ring_places(lines: DataFrame) -> DataFrame:
    """``ring`` and ``place`` of every line.

    Where two rings may be joined or kept apart at a point, lines turn left, which keeps regions apart
    that touch at a corner only.  A ring that comes through the point twice then meets itself there: in
    those rings the two passages change their successors, which parts the ring at the point.
    """
    last, before = F.element_at("points", -1), F.element_at("points", -2)
    first, second = F.col("points")[0], F.col("points")[1]
    ends = lines.select("label", "id", last.alias("at"), _heading(before, last).alias("h"))
    starts = lines.select("label", F.col("id").alias("nxt"), first.alias("at"), _heading(first, second).alias("o"))
    turn = F.expr("h.x * o.y - h.y * o.x")
    ways = materialise(ends.join(starts, ["label", "at"]).select("label", "at", "id", "nxt", turn.alias("turn")), "border-ways")
    links = ways.groupBy("id").agg(F.max_by("nxt", "turn").alias("nxt"), F.min_by("nxt", "turn").alias("other"), F.count(F.lit(1)).alias("ways"))
    links = materialise(links, "border-links")
    placed = materialise(cycles(links), "ring-places")
    rings = ways.select("label", "at", "id").distinct().join(placed.select("id", "ring"), "id")
    twice = rings.groupBy("label", "at", "ring").agg(F.count(F.lit(1)).alias("n")).where("n = 2").select("label", "at", "ring")
    twice = materialise(twice, "rings-parted")
    if not twice.limit(1).count():
        return placed
    parted = placed.join(twice.select("ring").distinct(), "ring", "left_semi").select("id")
    swapped = rings.join(twice, ["label", "at", "ring"], "left_semi").select("id", F.lit(True).alias("swap"))
    again = links.join(parted, "id", "left_semi").join(swapped, "id", "left")
    again = cycles(again.select("id", F.when(F.col("swap") & (F.col("ways") == 2), F.col("other")).otherwise(F.col("nxt")).alias("nxt")))
    return materialise(placed.join(parted, "id", "left_anti").unionByName(again), "ring-places")


def _outlines_of_holes(parts: DataFrame, facts: DataFrame) -> DataFrame:
    """(ring, outer): the outline each hole lies in.

    Left of a hole's leftmost border is its own region, up to the next border in that pixel row.  That is
    the outline's, or that of another hole, whose outline then is the same.
    """
    holes = facts.where("area2 < 0").select("ring")
    upright = parts.select(
        "label", "ring", F.explode(F.expr("filter(transform(sequence(1, size(points) - 1), i -> named_struct('x', points[i].x, 'y', points[i - 1].y, 'y2', points[i].y, 'u', points[i - 1].x)), e -> e.x = e.u)")).alias("e")
    ).select("label", "ring", "e.x", F.least("e.y", "e.y2").alias("y"), F.greatest("e.y", "e.y2").alias("y2"))
    probes = upright.join(holes, "ring", "left_semi").groupBy("label", "ring").agg(F.min(F.struct("x", "y")).alias("p")).select("label", "ring", "p.x", "p.y")
    probes = materialise(probes, "hole-probes")
    rows = upright.select("label", "ring", "x", F.explode(F.sequence("y", F.col("y2") - 1)).alias("y"))
    rows = rows.join(probes.select("label", "y").distinct(), ["label", "y"], "left_semi")
    # one pixel row of one label, which its width bounds
    beside = rows.withColumn("up", F.lag("ring").over(Window.partitionBy("label", "y").orderBy("x")))
    up = materialise(beside.join(probes, ["label", "ring", "x", "y"]).select("ring", "up"), "hole-links")
    while True:
        above = up.select(F.col("ring").alias("up"), F.col("up").alias("_up"))
        more = materialise(up.join(above, "up", "left").select("ring", F.coalesce("_up", "up").alias("up"), F.col("_up").isNotNull().alias("moved")), "hole-links")
        up = more.select("ring", "up")
        if not more.where("moved").limit(1).count():
            return up.select("ring", F.col("up").alias("outer"))


def _bound(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of a value that is worked out once, however often ``fn`` refers to it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _ring(parts: Column, scale: float) -> Column:
    """The closed ring of ordered lines, without points on a straight line."""

    def corners(p: Column) -> Column:
        n = F.size(p)

        def corner(q: Column, i: Column) -> Column:
            a, b = F.get(p, (i + n - 1) % n), F.get(p, (i + 1) % n)
            return (q.x - a.x) * (b.y - q.y) != (q.y - a.y) * (b.x - q.x)

        return F.filter(p, corner)

    # every line but its last point, which the next one begins with
    points = F.flatten(F.transform(parts, lambda s: F.slice(s["points"], 1, F.size(s["points"]) - 1)))
    closed = _bound(_bound(points, corners), lambda p: F.concat(p, F.slice(p, 1, 1)))
    scaled = F.transform(closed, lambda q: F.struct((q.x * scale).alias("x"), (q.y * scale).alias("y")))
    return scaled


def stack_geometry(runs: DataFrame, label: Iterable[str], scale: float, tile: int = 512) -> DataFrame:
    """The outline of every label (columns of ``runs``) as one multipolygon.

    Regions are joined along pixel sides, not at corners.  Outlines run counter-clockwise, holes
    clockwise, and no ring visits a point twice.  Null labels are labels like any other.
    """
    label = list(label)
    tiles = tile_runs(runs, label, tile)
    found = tiles.select(F.struct(*label).alias("label"), F.explode(border_lines(F.col("_runs"), tile)).alias("_l"))
    lines = materialise(found.select("label", "_l.kind", "_l.points"), "tile-lines")
    whole = lines.where(F.col("kind") == CLOSED).select(
        "label", (-1 - F.monotonically_increasing_id()).alias("ring"), F.lit(0).cast("long").alias("place"), "points"
    )
    left = _lines_left(lines)
    joined = left.join(_ring_places(left), "id").select("label", "ring", "place", "points")
    parts = materialise(whole.unionByName(joined), "ring-parts")

    twice = F.expr("aggregate(sequence(1, size(points) - 1), 0L, (s, i) -> s + cast(points[i - 1].x as bigint) * points[i].y - cast(points[i].x as bigint) * points[i - 1].y)")
    facts = materialise(parts.groupBy("ring").agg(F.sum(twice).alias("area2")), "ring-areas")
    outer = _outlines_of_holes(parts, facts)
    rings = parts.groupBy("label", "ring").agg(_ring(F.sort_array(F.collect_list(F.struct("place", "points"))), float(scale)).alias("points"))
    rings = rings.join(outer, "ring", "left").withColumn("hole", F.col("outer").isNotNull()).withColumn("outer", F.coalesce("outer", "ring"))
    polys = rings.groupBy("label", "outer").agg(F.sort_array(F.collect_list(F.struct("hole", "points"))).alias("r"))
    polys = polys.select("label", F.transform("r", lambda r: r["points"]).alias("poly"))
    geoms = polys.groupBy("label").agg(F.sort_array(F.collect_list("poly")).alias("geom"))
    return geoms.select(*[F.col("label")[c].alias(c) for c in label], "geom")
