"""Validity and repair of suspect geometries, vectorised over Arrow batches.

Validity: rings closed, four points or more, non-zero area, no ring crossing or touching itself along
a stretch, rings of one layer entry not crossing each other, holes inside their outline.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from croploom.functions.nested import GEOM_TYPE, from_geometry_array, to_geometry_array
from croploom.functions.outline import draw
from croploom.functions.rings import Contacts, candidate_pairs, chain, holds, inner_point, loops, part_at_meetings, signed_area
from croploom.schema import GEOM

# Bounds the runs of the last repair step's raster that are held at a time, whatever the geometry's size.
BAND_CELLS = 4_000_000


def valid_batch(geoms: list) -> list:
    """Validity of many geometries in one vectorised pass; None for None, true for an empty one."""
    out: list = [None if g is None else len(g) == 0 for g in geoms]
    rings, owner = [], []
    for k, geom in enumerate(geoms):
        if geom and all(len(poly) > 0 and all(len(r) >= 4 for r in poly) for poly in geom):
            for poly in geom:
                for ring in poly:
                    rings.append(np.asarray(ring, dtype=float))
                    owner.append(k)
    if not rings:
        return out
    owner = np.array(owner)
    bad = np.zeros(len(geoms), dtype=bool)
    bad[owner[~_closed_with_area(rings)]] = True
    good = np.flatnonzero(~bad[owner])
    if len(good):
        rings, owner = [rings[g] for g in good], owner[good]
        bad[_owners_that_meet(rings, owner)] = True
    for k in np.unique(owner):
        out[k] = not bool(bad[k])
    several = [k for k in np.unique(owner[~bad[owner]]) if len(geoms[k]) + len(geoms[k][0]) > 2]
    for k, clear in zip(several, _clearly_nested([geoms[k] for k in several])):
        out[k] = bool(clear) or _nested_rightly(geoms[k])
    return out


def _closed_with_area(rings: list[np.ndarray]) -> np.ndarray:
    """For each ring: finite, closed and of non-zero area."""
    sizes = np.array([len(r) for r in rings])
    pts = np.concatenate(rings)
    first = np.cumsum(sizes) - sizes
    with np.errstate(invalid="ignore"):
        rel = pts - np.repeat(pts[first], sizes, axis=0)
        cross = rel[:-1, 0] * rel[1:, 1] - rel[1:, 0] * rel[:-1, 1]
        cross = np.append(cross, 0.0)
        cross[first + sizes - 1] = 0.0
        area = np.add.reduceat(cross, first)
        closed = np.all(pts[first] == pts[first + sizes - 1], axis=1)
        return closed & np.isfinite(area) & (area != 0)


def _owners_that_meet(rings: list[np.ndarray], owner: np.ndarray) -> np.ndarray:
    """Geometries with a ring that crosses, touches or retraces itself, or two rings that share more
    than corner points."""
    segs, ring_no, place, sizes = chain(rings)
    found = [owner[sizes < 3]]
    for i, j in candidate_pairs(segs, owner[ring_no]):
        c = Contacts(segs, i, j)
        same = ring_no[i] == ring_no[j]
        gap = np.abs(place[i] - place[j])
        neighbours = same & ((gap == 1) | (gap == sizes[ring_no[i]] - 1))
        at_corner = (c.t == 0) | (c.t == 1) | (c.u == 0) | (c.u == 1)
        wrong = c.stretch | (same & ~neighbours & (c.crossing | c.along)) | (~same & c.crossing & ~at_corner)
        found.append(owner[ring_no[i[wrong]]])
    return np.concatenate(found)


def _clearly_nested(geoms: list, most: int = 8) -> np.ndarray:
    """Geometries of few rings that do not cross, which limits and corners alone show to be nested rightly.

    Holes lie in their outline with all corners, and the limits of holes and of parts do not overlap.
    Those that this does not show are left to ``_nested_rightly``.
    """
    clear = np.array([sum(map(len, geom)) <= most and all(len(r) <= 64 for poly in geom for r in poly) for geom in geoms], dtype=bool)
    rings, owner, part, hole = [], [], [], []
    for k in np.flatnonzero(clear):
        for i, poly in enumerate(geoms[k]):
            for j, ring in enumerate(poly):
                rings.append(np.asarray(ring, dtype=float))
                owner.append(k)
                part.append(i)
                hole.append(j > 0)
    if not rings:
        return clear
    owner, part, hole, sizes = np.array(owner), np.array(part), np.array(hole), np.array([len(r) for r in rings])
    points, first = np.concatenate(rings), np.cumsum(sizes) - sizes
    low, high = np.minimum.reduceat(points, first), np.maximum.reduceat(points, first)
    n = np.bincount(owner, minlength=len(geoms))[owner]
    start = np.searchsorted(owner, owner)
    a = np.repeat(np.arange(len(rings)), n)
    b = np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + start[a]
    a, b = a[a < b], b[a < b]
    inside = (part[a] == part[b]) & ~hole[a]
    beside = (part[a] == part[b]) & hole[a] | (part[a] != part[b]) & ~hole[a] & ~hole[b]
    overlap = np.all((low[a] < high[b]) & (low[b] < high[a]), axis=1)
    clear[owner[a[beside & overlap]]] = False
    # each corner of a hole against each edge of its outline; one on the outline, or nearly, is not sure to be inside
    a, b = a[inside], b[inside]
    corner = np.repeat(np.arange(len(a)), sizes[b])
    at = first[b][corner] + np.arange(len(corner)) - np.repeat(np.cumsum(sizes[b]) - sizes[b], sizes[b])
    edges = sizes[a][corner] - 1
    q = np.repeat(np.arange(len(corner)), edges)
    e = first[a][corner][q] + np.arange(len(q)) - np.repeat(np.cumsum(edges) - edges, edges)
    (x, y), (ax, ay), (bx, by) = points[at[q]].T, points[e].T, points[e + 1].T
    up = (ay > y) != (by > y)
    with np.errstate(divide="ignore", invalid="ignore"):
        cross = ax + (y - ay) * (bx - ax) / (by - ay)
    within = np.bincount(q, weights=up & (cross > x), minlength=len(corner)) % 2 == 1
    near = 1e-9 * np.maximum(1, np.abs(x))
    level = (y == ay) & (y == by) & (x >= np.minimum(ax, bx)) & (x <= np.maximum(ax, bx))
    unsure = np.bincount(q, weights=up & (np.abs(cross - x) <= near) | level | (x == ax) & (y == ay), minlength=len(corner)) > 0
    clear[owner[a[corner[~within | unsure]]]] = False
    return clear


def _nested_rightly(geom: list) -> bool:
    """Holes lie in their outline and not in each other, parts not in parts (rings do not cross)."""
    for poly in geom:
        for k, hole in enumerate(poly[1:], 1):
            if not holds(poly[0], *inner_point(hole)):
                return False
            for other in poly[1:k]:
                if holds(other, *inner_point(hole)) or holds(hole, *inner_point(other)):
                    return False
    return not any(
        _within(one[0], two) or _within(two[0], one) for k, one in enumerate(geom) for two in geom[:k]
    )


def _within(outline: np.ndarray, poly: list) -> bool:
    """An outline lies in a polygon and not in one of its holes.

    Its inner point may lie in a hole that belongs to it, and there in a smaller part.
    """
    if abs(signed_area(outline)) >= abs(signed_area(poly[0])):
        return False
    at = inner_point(outline)
    return holds(poly[0], *at) and not any(holds(h, *at) for h in poly[1:])


def _closed(ring: np.ndarray) -> np.ndarray:
    """Without points that are not finite, ends joined."""
    ring = np.asarray(ring, dtype=float).reshape(-1, 2)
    ring = ring[np.all(np.isfinite(ring), axis=1)]
    if len(ring) and np.any(ring[0] != ring[-1]):
        ring = np.vstack([ring, ring[:1]])
    return ring


def _all_closed(rings: list[np.ndarray]) -> list[np.ndarray]:
    """``_closed`` for many rings; those that need nothing are found together."""
    if not rings:
        return []
    rings = [np.asarray(r, dtype=float).reshape(-1, 2) for r in rings]
    sizes = np.array([len(r) for r in rings])
    some = np.flatnonzero(sizes)
    fine = np.zeros(len(rings), dtype=bool)
    if len(some):
        pts, first = np.concatenate(rings), (np.cumsum(sizes) - sizes)[some]
        finite = np.logical_and.reduceat(np.isfinite(pts).all(axis=1), first)
        fine[some] = finite & (pts[first] == pts[first + sizes[some] - 1]).all(axis=1)
    return [r if ok else _closed(r) for r, ok in zip(rings, fine.tolist())]


def simple_loops(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Each ring cut at every point where it meets itself; spikes and flat loops fall away."""
    closed = _all_closed(rings)
    out: list[list[np.ndarray]] = [[] for _ in rings]
    usable = [k for k, r in enumerate(closed) if len(r) >= 4]
    if not usable:
        return out
    segs, ring_no, _, _ = chain([closed[k] for k in usable])
    if not len(segs):
        return out
    at_seg, at_point = [], []
    for i, j in candidate_pairs(segs, ring_no):
        c = Contacts(segs, i, j)
        # A crossing inside an edge becomes a point of that edge; where the other edge ends there,
        # exactly that end, so that both walks name the same point.
        end_i = np.where((c.t == 0)[:, None], c.p, c.p_end)
        end_j = np.where((c.u == 0)[:, None], c.q, c.q_end)
        on_end_i, on_end_j = (c.t == 0) | (c.t == 1), (c.u == 0) | (c.u == 1)
        with np.errstate(invalid="ignore"):
            point = c.p + c.t[:, None] * c.r
        point = np.where(on_end_j[:, None], end_j, point)
        point = np.where(on_end_i[:, None], end_i, point)
        for k, inner in ((i, c.crossing & ~on_end_i), (j, c.crossing & ~on_end_j)):
            at_seg.append(k[inner])
            at_point.append(point[inner])
        # Of two edges on one line, each takes the ends of the other that lie inside it.
        for share, end in ((c.e0, c.q), (c.e1, c.q_end)):
            inner = c.stretch & (share > 0) & (share < 1)
            at_seg.append(i[inner])
            at_point.append(end[inner])
        span = c.e1 - c.e0
        with np.errstate(divide="ignore", invalid="ignore"):
            for share, end in ((-c.e0 / span, c.p), ((1 - c.e0) / span, c.p_end)):
                inner = c.stretch & (share > 0) & (share < 1)
                at_seg.append(j[inner])
                at_point.append(end[inner])
    stops: dict[int, list] = {}
    for k, p in zip(np.concatenate(at_seg).tolist(), map(tuple, np.concatenate(at_point).tolist())):
        stops.setdefault(k, []).append(p)
    walks: list[list] = [[] for _ in usable]
    for k, (ring, (ax, ay, bx, by)) in enumerate(zip(ring_no.tolist(), segs.tolist())):
        walks[ring].append((ax, ay))
        if k in stops:
            between = set(stops[k]) - {(ax, ay), (bx, by)}
            walks[ring].extend(sorted(between, key=lambda p: (p[0] - ax) ** 2 + (p[1] - ay) ** 2))
    for k, walk in zip(usable, walks):
        parts = [walk] if len(set(walk)) == len(walk) else part_at_meetings(walk)
        for loop in (x for part in parts for x in loops([*part, *part[:1]])):
            if len(loop) >= 4:
                arr = np.asarray(loop)
                if signed_area(arr) != 0:
                    out[k].append(arr)
    return out


def _canonical(loop: np.ndarray) -> tuple:
    pts = [tuple(p) for p in loop[:-1]]
    i = pts.index(min(pts))
    return tuple(pts[i:] + pts[:i])


def _assemble(found: list[np.ndarray], winding: bool) -> list:
    """Polygons from loops that do not cross: by alternate nesting, or by winding number."""
    if len(found) == 1:
        return [[found[0] if signed_area(found[0]) > 0 else found[0][::-1]]]
    kinds: dict[tuple, int] = {}
    shape: dict[tuple, np.ndarray] = {}
    for loop in found:
        sign = 1 if signed_area(loop) > 0 else -1
        ccw = loop if sign > 0 else loop[::-1]
        key = _canonical(ccw)
        shape[key] = ccw
        kinds[key] = kinds.get(key, 0) + (sign if winding else 1)
    # Loops traced twice cancel under the alternate rule.
    weights = {k: (w if winding else w % 2) for k, w in kinds.items()}
    keys = [k for k in shape if weights[k] != 0]
    if len(keys) < 2:
        return [[shape[k]] for k in keys]
    inner = {k: inner_point(shape[k]) for k in keys}
    size = {k: signed_area(shape[k]) for k in keys}
    around = {k: [o for o in keys if o != k and size[o] > size[k] and holds(shape[o], *inner[k])] for k in keys}
    total = {k: weights[k] + sum(weights[o] for o in around[k]) for k in keys}

    def filled(value: int) -> bool:
        return value != 0 if winding else value % 2 == 1

    outside = {k: total[k] - weights[k] for k in keys}
    outlines = [k for k in keys if filled(total[k]) and not filled(outside[k])]
    polys = {k: [shape[k]] for k in outlines}
    for k in keys:
        if filled(outside[k]) and not filled(total[k]):
            owners = [o for o in around[k] if o in polys]
            if owners:
                polys[min(owners, key=size.get)].append(shape[k][::-1])
    return list(polys.values())


def repair1(geom: list, cut: list[list[list[np.ndarray]]]) -> list | None:
    """Rings closed, repeats, spikes and flat rings dropped, self-crossings split; holes stay holes.

    ``cut`` has the simple loops of every ring.
    """
    out = []
    for poly in cut:
        if not poly:
            continue
        outer = _assemble(poly[0], winding=False)
        holes = [p[0] for ring in poly[1:] for p in _assemble(ring, winding=False)]
        placed = 0
        for part in outer:
            mine = [h for h in holes if holds(part[0], *inner_point(h))]
            placed += len(mine)
            out.append([*part, *[h[::-1] for h in mine]])
        if placed < len(holes):
            # A hole that lies outside needs the rings to be rebuilt together.
            return None
    return out or None


def repair2(geom: list, cut: list[list[list[np.ndarray]]]) -> list | None:
    """All rings rebuilt together by winding number, as a zero-width buffer does."""
    found = []
    for poly in cut:
        for k, parts in enumerate(poly):
            # Orientation of the ring as a whole: outlines wind once forward, holes once back.
            sign = 1 if sum(signed_area(p) for p in parts) >= 0 else -1
            want = 1 if k == 0 else -1
            found.extend(p if sign == want else p[::-1] for p in parts)
    return _assemble(found, winding=True) or None


def repair3(geom: list, cut: object = None, cell: float = 0.4) -> list | None:
    """Shrink and grow by one metre on a fine raster, five cells to two metres: narrower parts go.

    Of the raster only the runs of its rows are held, in bands of rows that reach over their borders by
    what shrinking and growing look at.
    """
    pts = np.concatenate([r for poly in geom for r in poly if len(r)] or [np.empty((0, 2))])
    pts = pts[np.all(np.isfinite(pts), axis=1)]
    # Shrinking takes all that has no more than 2 * reach cell centres side by side, or one above another.
    if not len(pts) or np.ptp(pts, axis=0).min() / cell < 2 * int(1 / cell) - 0.5:
        return None
    low = np.floor(pts.min(axis=0) / cell).astype(int) - 4
    cols, rows = (np.ceil(pts.max(axis=0) / cell).astype(int) + 4 - low).tolist()
    reach = int(1 / cell)
    edges = [_edges(poly, low, cell) for poly in geom]
    # A row has no more crossings than there are edges; each is looked at for some ten rows.
    step = max(4 * reach, BAND_CELLS // (10 * max(1, sum(map(len, edges)))))
    runs = []
    for top in range(0, rows, step):
        last = min(rows, top + step)
        filled = [_fill(e, top - 2 * reach, last + 2 * reach, cols) for e in edges]
        y, a, b = _grown(_shrunk(_covered(np.concatenate(filled, axis=1), 1), reach), reach)
        own = (y >= top) & (y < last)
        runs.append(np.column_stack([y[own] + low[1], a[own] + low[0], b[own] + low[0]]))
    runs = np.concatenate(runs)
    return draw(runs, cell) if len(runs) else None


def _edges(poly: list, low, cell: float) -> np.ndarray:
    """Sloping and upright edges of a polygon in cells from ``low``, lower end first."""
    rings = [_closed(np.asarray(r, dtype=float)) / cell - low for r in poly if len(r)]
    e = np.concatenate([np.hstack([r[:-1], r[1:]]) for r in rings if len(r)] or [np.empty((0, 4))])
    e = np.where((e[:, 1] > e[:, 3])[:, None], e[:, [2, 3, 0, 1]], e)
    return e[e[:, 1] != e[:, 3]]


def _fill(edges: np.ndarray, first: int, last: int, cols: int) -> np.ndarray:
    """Runs ``row, start, end`` of the even-odd raster of the rows from first to last, by cell centres."""
    lo = np.maximum(np.ceil(edges[:, 1] - 0.5).astype(int), first)
    n = np.maximum(np.minimum(np.ceil(edges[:, 3] - 0.5).astype(int), last) - lo, 0)
    k = np.repeat(np.arange(len(edges)), n)
    row = lo[k] + np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)
    x0, y0, x1, y1 = edges[k].T
    x = x0 + (row + 0.5 - y0) * (x1 - x0) / (y1 - y0)
    at = np.clip(np.ceil(x - 0.5).astype(int), 0, cols)
    # Closed rings cross a row an even number of times.
    order = np.lexsort((at, row))
    return np.stack([row[order][::2], at[order][::2], at[order][1::2]])


def _covered(runs: np.ndarray, times: int) -> np.ndarray:
    """Runs of the cells that so many of the given runs cover, by row and place."""
    row, x = np.concatenate([runs[0], runs[0]]), np.concatenate([runs[1], runs[2]])
    ends = np.repeat([False, True], runs.shape[1])
    order = np.lexsort((ends, x, row))  # of equal places starts come first, so runs that touch are joined
    row, x = row[order], x[order]
    cover = np.cumsum(np.where(ends[order], -1, 1))
    enough = np.concatenate([[False], cover >= times])
    start, end = np.flatnonzero(enough[1:] & ~enough[:-1]), np.flatnonzero(enough[:-1] & ~enough[1:])
    some = x[start] < x[end]
    return np.stack([row[start], x[start], x[end]])[:, some]


def _halves(reach: int) -> list[tuple[int, int]]:
    """Rows of a disc, and how far it goes to either side there."""
    return [(dy, int(np.sqrt(reach * reach - dy * dy))) for dy in range(-reach, reach + 1)]


def _shrunk(runs: np.ndarray, reach: int) -> np.ndarray:
    """Cells with none but set ones within ``reach`` cells; runs must not touch."""
    y, a, b = runs
    parts = np.concatenate([np.stack([y + dy, a + half, b - half]) for dy, half in _halves(reach)], axis=1)
    return _covered(parts[:, parts[1] < parts[2]], 2 * reach + 1)


def _grown(runs: np.ndarray, reach: int) -> np.ndarray:
    """Every cell within ``reach`` cells of a set one."""
    y, a, b = runs
    return _covered(np.concatenate([np.stack([y + dy, a - half, b + half]) for dy, half in _halves(reach)], axis=1), 1)


@F.arrow_udf(T.BooleanType())
def _valid_udf(col: pa.Array) -> pa.Array:
    return pa.array(valid_batch(from_geometry_array(col)), pa.bool_())


def is_valid(geom: Column) -> Column:
    """The full validity test; null for a null geometry, true for an empty one."""
    return _valid_udf(geom)


def _bound(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of a value that is worked out once, however often ``fn`` refers to it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _up(e: Column) -> Column:
    return (e.y > 0) | ((e.y == 0) & (e.x > 0))


def _turns_once(ring: Column) -> Column:
    """A closed ring that turns one way only, and once around: convex, so it cannot meet itself."""

    def edge(i: Column) -> Column:
        a, b = F.get(ring, i - 1), F.get(ring, i)
        return F.struct((b.x - a.x).alias("x"), (b.y - a.y).alias("y"))

    def corners(e: Column) -> Column:
        def corner(i: Column) -> Column:
            one, two = F.get(e, i), F.get(e, (i + 1) % F.size(e))
            return F.struct(
                (one.x * two.y - one.y * two.x).alias("turn"),
                (one.x * two.x + one.y * two.y).alias("along"),
                (~_up(one) & _up(two)).cast("int").alias("round"),
            )

        return F.transform(F.sequence(F.lit(0), F.size(e) - 1), corner)

    def once(c: Column) -> Column:
        one_way = F.forall(c, lambda q: q.turn >= 0) | F.forall(c, lambda q: q.turn <= 0)
        forward = F.forall(c, lambda q: (q.turn != 0) | (q.along > 0))
        return one_way & forward & F.exists(c, lambda q: q.turn != 0) & (F.aggregate(c, F.lit(0), lambda n, q: n + q["round"]) == 1)

    return _bound(_bound(F.transform(F.sequence(F.lit(1), F.size(ring) - 1), edge), corners), once)


def easy_ring(geom: Column) -> Column:
    """The ring, closed and without repeated points, of a geometry of one ring that is convex then.

    Null for all others.  Such a geometry is valid if its ring was closed, and is made valid by
    closing it; neither needs the full test.
    """
    ring = F.get(F.get(geom, F.lit(0)), F.lit(0))
    # Equality holds for NaN and infinities too, a difference of 0 only for finite numbers.
    finite = F.forall(ring, lambda q: (q.x - q.x == 0) & (q.y - q.y == 0))

    def clean(r: Column) -> Column:
        return F.filter(r, lambda p, i: (i == 0) | (p != F.get(r, i - 1)))

    def close(r: Column) -> Column:
        return F.when(F.get(r, F.lit(0)) == F.element_at(r, -1), r).otherwise(F.concat(r, F.slice(r, 1, 1)))

    def convex(r: Column) -> Column:
        return F.when((F.size(r) >= 4) & _turns_once(r), r)

    single = (F.size(geom) == 1) & (F.size(F.get(geom, F.lit(0))) == 1) & (F.size(ring) >= 3)
    return F.when(single & finite, _bound(_bound(_bound(ring, clean), close), convex))


def is_closed(geom: Column) -> Column:
    """Whether the first ring ends where it begins."""
    return _bound(F.get(F.get(geom, F.lit(0)), F.lit(0)), lambda r: F.get(r, F.lit(0)) == F.element_at(r, -1))


_REPAIRED = T.StructType([T.StructField("geom", GEOM), T.StructField("method", T.IntegerType())])
_STEPS = ((1, repair1), (3, repair2), (4, repair3))


def repair_batch(geoms: list) -> tuple[list, list]:
    """Repaired geometries and the step that did it; only what is still invalid goes on a step."""
    fixed = list(geoms)
    methods = [None if ok is None else 0 if ok else 9 for ok in valid_batch(geoms)]
    left = [k for k, m in enumerate(methods) if m == 9]
    cut = _cut_all([geoms[k] for k in left])
    for number, step in _STEPS:
        tried = [_attempt(step, geoms[k], c) for k, c in zip(left, cut)]
        fine = [t is not None and ok is True for t, ok in zip(tried, valid_batch(tried))]
        for k, t, ok in zip(left, tried, fine):
            if ok:
                fixed[k], methods[k] = t, number
        cut = [c for c, ok in zip(cut, fine) if not ok]
        left = [k for k, ok in zip(left, fine) if not ok]
    return fixed, methods


def _attempt(step, geom: list, cut: list) -> list | None:
    # One geometry that no step can deal with must not stop the others.
    try:
        return step(geom, cut) or None
    except (ValueError, IndexError, ZeroDivisionError, FloatingPointError):
        return None


def _cut_all(geoms: list) -> list:
    """The simple loops of every ring, nested as the geometries are."""
    done = iter(simple_loops([r for geom in geoms for poly in geom for r in poly]))
    return [[[next(done) for _ in poly] for poly in geom] for geom in geoms]


@F.arrow_udf(_REPAIRED)
def _repair_udf(col: pa.Array) -> pa.Array:
    geoms, methods = repair_batch(from_geometry_array(col))
    changed = [k for k, m in enumerate(methods) if m not in (None, 0, 9)]
    if changed:
        at = np.arange(len(col))
        at[changed] = len(col) + np.arange(len(changed))
        col = pa.concat_arrays([col, to_geometry_array([geoms[k] for k in changed]).cast(col.type)]).take(pa.array(at))
    return pa.StructArray.from_arrays([col.cast(GEOM_TYPE), pa.array(methods, pa.int32())], names=["geom", "method"])


def repair(geom: Column) -> Column:
    """``struct(geom, method)``: 0 was valid, 1 made valid, 3 rebuilt by winding, 4 shrunk and grown,
    9 could not be repaired and is returned as it came."""
    return _repair_udf(geom)


@F.arrow_udf(GEOM)
def _simplify_udf(col: pa.Array, tol: pa.Array) -> pa.Array:
    tolerance = tol[0].as_py() if len(tol) else 0.0
    out = []
    for geom in from_geometry_array(col):
        if geom is None:
            out.append(None)
            continue
        polys = []
        for poly in geom:
            rings = [thin_line(r, tolerance) for r in poly]
            if rings and len(rings[0]) >= 4:
                polys.append([rings[0], *[r for r in rings[1:] if len(r) >= 4]])
        out.append(polys)
    return to_geometry_array(out)


def thin_line(line: np.ndarray, tolerance: float) -> np.ndarray:
    """Douglas-Peucker: keep the farthest point of every stretch that strays beyond the tolerance."""
    keep = np.zeros(len(line), dtype=bool)
    keep[[0, -1]] = True
    stack = [(0, len(line) - 1)]
    while stack:
        a, b = stack.pop()
        if b - a < 2:
            continue
        base, mid = line[b] - line[a], line[a + 1 : b] - line[a]
        length2 = float(base @ base)
        along = np.clip(mid @ base / length2, 0, 1) if length2 else np.zeros(len(mid))
        dist = np.linalg.norm(mid - along[:, None] * base, axis=1)
        k = int(np.argmax(dist))
        if dist[k] > tolerance:
            k += a + 1
            keep[k] = True
            stack += [(a, k), (k, b)]
    return line[keep]


def simplify(geom: Column, tolerance: float) -> Column:
    """Fewer points within the tolerance; rings that collapse are dropped."""
    return _simplify_udf(geom, F.lit(float(tolerance)))
