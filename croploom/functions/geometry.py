"""Geometry columns as native expressions.

A geometry is an array of polygons, a polygon an array of closed rings (outline first, holes after),
a ring an array of points.  Every function here stays inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from croploom.functions.scalars import let
from croploom.schema import GEOM


def point(x, y) -> Column:
    x = x if isinstance(x, Column) else F.lit(x)
    y = y if isinstance(y, Column) else F.lit(y)
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def box_ring(x0, y0, x1, y1) -> Column:
    """Closed rectangle ring, counter-clockwise."""
    return F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1), point(x0, y0))


def envelope(x0, y0, x1, y1) -> Column:
    """Rectangle geometry from its four limits."""
    return F.array(F.array(box_ring(x0, y0, x1, y1))).cast(GEOM)


def _pairs(ring: Column, fn) -> Column:
    """``fn`` over every two consecutive points of a ring."""
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.zip_with(F.slice(ring, F.lit(1), n), F.slice(ring, F.lit(2), n), fn)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def is_empty(geom: Column) -> Column:
    return F.size(geom) == 0


def _ring_area_signed(ring: Column) -> Column:
    # Coordinates relative to the first point keep the products small.
    def shoelace(r):
        o = r[0]
        return _total(
            _pairs(r, lambda a, b: (a.x - o.x) * (b.y - o.y) - (b.x - o.x) * (a.y - o.y))
        ) / 2

    return F.when(F.size(ring) < 4, F.lit(0.0)).otherwise(shoelace(ring))


def _polygon_area(poly: Column) -> Column:
    return _total(
        F.transform(
            poly,
            lambda ring, i: let(
                F.abs(_ring_area_signed(ring)), lambda a: F.when(i == 0, a).otherwise(-a)
            ),
        )
    )


def area(geom: Column) -> Column:
    """Area in square metres; holes are subtracted whatever way they run."""
    return _total(F.transform(geom, _polygon_area))


def _all_points(geom: Column) -> Column:
    return F.flatten(F.flatten(geom))


def bbox(geom: Column) -> Column:
    """``struct(xmin, ymin, xmax, ymax)``; null for an empty geometry."""
    return let(
        _all_points(geom),
        lambda pts: F.when(
            F.size(pts) > 0,
            F.struct(
                F.array_min(F.transform(pts, lambda p: p.x)).alias("xmin"),
                F.array_min(F.transform(pts, lambda p: p.y)).alias("ymin"),
                F.array_max(F.transform(pts, lambda p: p.x)).alias("xmax"),
                F.array_max(F.transform(pts, lambda p: p.y)).alias("ymax"),
            ),
        ),
    )


def centroid(geom: Column) -> Column:
    """Area-weighted centroid as ``struct(x, y)``; null where the area is zero."""

    def moments(ring, i, o):
        terms = _pairs(
            ring,
            lambda a, b: let(
                (a.x - o.x) * (b.y - o.y) - (b.x - o.x) * (a.y - o.y),
                lambda w: F.struct(
                    w.alias("a"),
                    (w * (a.x + b.x - 2 * o.x)).alias("mx"),
                    (w * (a.y + b.y - 2 * o.y)).alias("my"),
                ),
            ),
        )
        zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))
        summed = F.aggregate(
            terms,
            zero,
            lambda s, t: F.struct(
                (s.a + t.a).alias("a"), (s.mx + t.mx).alias("mx"), (s.my + t.my).alias("my")
            ),
        )
        # An outline counts positive and a hole negative, whatever way they run.
        return let(
            summed,
            lambda s: let(
                F.when((s.a >= 0) == (i == 0), F.lit(1.0)).otherwise(F.lit(-1.0)),
                lambda sign: F.struct(
                    (s.a * sign).alias("a"), (s.mx * sign).alias("mx"), (s.my * sign).alias("my")
                ),
            ),
        )

    def whole(g):
        return let(
            g[0][0][0],
            lambda o: let(
                F.flatten(
                    F.transform(
                        g, lambda poly: F.transform(poly, lambda ring, i: moments(ring, i, o))
                    )
                ),
                lambda ms: let(
                    F.struct(
                        _total(F.transform(ms, lambda m: m.a)).alias("a"),
                        _total(F.transform(ms, lambda m: m.mx)).alias("mx"),
                        _total(F.transform(ms, lambda m: m.my)).alias("my"),
                    ),
                    lambda t: F.when(
                        t.a > 0,
                        F.struct(
                            (o.x + t.mx / (3 * t.a)).alias("x"), (o.y + t.my / (3 * t.a)).alias("y")
                        ),
                    ),
                ),
            ),
        )

    return F.when(F.size(_all_points(geom)) > 0, whole(geom))


def _clip_half(ring: Column, axis: str, limit: Column, keep_above: bool) -> Column:
    """One half-plane cut of a closed ring; the border itself is kept."""

    def inside(p):
        return p[axis] >= limit if keep_above else p[axis] <= limit

    def crossing(a, b):
        t = (limit - a[axis]) / (b[axis] - a[axis])
        if axis == "x":
            return point(limit, a.y + t * (b.y - a.y))
        return point(a.x + t * (b.x - a.x), limit)

    def step(a, b):
        cut = F.when(inside(a) != inside(b), F.array(crossing(a, b))).otherwise(F.slice(F.array(b), 1, 0))
        kept = F.when(inside(b), F.array(point(b.x, b.y))).otherwise(F.slice(F.array(b), 1, 0))
        return F.concat(cut, kept)

    return let(
        F.flatten(_pairs(ring, step)),
        lambda pts: F.when(F.size(pts) > 0, F.concat(pts, F.slice(pts, 1, 1))).otherwise(pts),
    )


def _clip_ring(ring: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return let(
        _clip_half(ring, "x", x0, True),
        lambda r1: let(
            _clip_half(r1, "x", x1, False),
            lambda r2: let(
                _clip_half(r2, "y", y0, True), lambda r3: _clip_half(r3, "y", y1, False)
            ),
        ),
    )


def clip_cell(geom: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """The part of a geometry inside a rectangle.

    A concave ring may come back with zero-width bridges along the rectangle's border; they do not
    change the area.  Polygons whose outline falls away entirely are dropped.
    """
    cut = F.transform(geom, lambda poly: F.transform(poly, lambda r: _clip_ring(r, x0, y0, x1, y1)))
    return F.transform(
        F.filter(cut, lambda poly: F.size(F.get(poly, F.lit(0))) > 0),
        lambda poly: F.filter(poly, lambda ring: F.size(ring) > 0),
    )


def _edge_meets_box(a, b, x0, y0, x1, y1) -> Column:
    """A segment and a closed rectangle share a point (separating axes, no division)."""

    def side(px, py):
        return (b.x - a.x) * (py - a.y) - (b.y - a.y) * (px - a.x)

    corners = [side(x0, y0), side(x1, y0), side(x0, y1), side(x1, y1)]
    return (
        (F.greatest(a.x, b.x) >= x0)
        & (F.least(a.x, b.x) <= x1)
        & (F.greatest(a.y, b.y) >= y0)
        & (F.least(a.y, b.y) <= y1)
        & (F.least(*corners) <= 0)
        & (F.greatest(*corners) >= 0)
    )


def border_meets_cell(geom: Column, x0, y0, x1, y1) -> Column:
    """Some edge of the geometry shares a point with the closed rectangle."""
    return F.exists(
        geom,
        lambda poly: F.exists(
            poly,
            lambda ring: F.exists(
                _pairs(ring, lambda a, b: _edge_meets_box(a, b, x0, y0, x1, y1)), lambda hit: hit
            ),
        ),
    )


def intersects_cell(geom: Column, x0, y0, x1, y1, clipped_area: Column | None = None) -> Column:
    """The geometry and the closed rectangle share a point; touching counts.

    Without an edge in the rectangle, the rectangle lies wholly inside or wholly outside, and the
    clipped area tells which.
    """
    part = clipped_area if clipped_area is not None else area(clip_cell(geom, x0, y0, x1, y1))
    return border_meets_cell(geom, x0, y0, x1, y1) | (part > (x1 - x0) * (y1 - y0) / 2)


def to_multi(polygon: Column) -> Column:
    """A single polygon (array of rings) as a one-part multipolygon; null stays null."""
    return F.when(polygon.isNotNull(), F.array(polygon))


def edges(geom: Column) -> Column:
    """All ring edges as ``struct(ax, ay, bx, by)``."""
    return F.flatten(
        F.transform(
            F.flatten(geom),
            lambda ring: _pairs(
                ring,
                lambda a, b: F.struct(
                    a.x.alias("ax"), a.y.alias("ay"), b.x.alias("bx"), b.y.alias("by")
                ),
            ),
        )
    )


def geom_type(geom: Column) -> Column:
    """``Polygon``, ``MultiPolygon`` or ``Empty``; null for no geometry."""
    return (
        F.when(F.size(geom) == 0, "Empty")
        .when(F.size(geom) == 1, "Polygon")
        .when(F.size(geom) > 1, "MultiPolygon")
    )
