"""Outlines of raster runs as polygons with holes, and the border lines of single tiles.

Within a tile, border lines are followed up to the lines between tiles.  On those they are cut into
pixels, so that pieces of neighbouring tiles that run against each other can cancel out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from croploom.functions.rings import holds, loops, signed_area


def _border_steps(runs: np.ndarray) -> dict:
    """Directed pixel-border pieces, inside on the left: start vertex -> end vertices."""
    by_row: dict[int, list[tuple[int, int]]] = {}
    for y, a, b in runs[np.lexsort((runs[:, 1], runs[:, 0]))].tolist():
        row = by_row.setdefault(y, [])
        if row and row[-1][1] == a:
            row[-1] = (row[-1][0], b)
        else:
            row.append((a, b))
    steps: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for y in sorted({v for r in by_row for v in (r, r + 1)}):
        above, below = by_row.get(y, []), by_row.get(y - 1, [])
        # Along the line y, +1 where only the row above is filled and -1 where only the row below is.
        change: dict[int, int] = {}
        for spans, sign in ((above, 1), (below, -1)):
            for a, b in spans:
                change[a] = change.get(a, 0) + sign
                change[b] = change.get(b, 0) - sign
        # Every run end is a corner, even where the border goes straight on.
        xs = sorted({x for spans in (above, below) for ab in spans for x in ab})
        state = 0
        for left, right in zip(xs, xs[1:]):
            state += change.get(left, 0)
            if state > 0:
                steps.setdefault((left, y), []).append((right, y))
            elif state < 0:
                steps.setdefault((right, y), []).append((left, y))
        for a, b in above:
            steps.setdefault((b, y), []).append((b, y + 1))
            steps.setdefault((a, y + 1), []).append((a, y))
    return steps


def _rings(steps: dict) -> list[list[tuple[int, int]]]:
    """Closed loops; where two loops touch at a corner they are kept apart (turn left), and a loop
    that meets itself is cut there."""
    rings = []
    while steps:
        start = next(iter(steps))
        ring, at, heading = [start], start, None
        while True:
            to = _next(steps, at, heading)
            heading = (np.sign(to[0] - at[0]), np.sign(to[1] - at[1]))
            at = to
            ring.append(at)
            if at == start:
                break
        rings.extend(_without_straight(part) for part in loops(ring))
    return rings


def _without_straight(ring):
    pts = ring[:-1]
    n = len(pts)
    kept = [
        pts[i]
        for i in range(n)
        if (pts[i][0] - pts[i - 1][0]) * (pts[(i + 1) % n][1] - pts[i][1])
        != (pts[i][1] - pts[i - 1][1]) * (pts[(i + 1) % n][0] - pts[i][0])
    ]
    return [*kept, kept[0]]


def draw(runs: np.ndarray, scale: float) -> list[list[list[tuple[float, float]]]]:
    """Multipolygon of 4-connected regions from rows of ``(py, x0, x1)``."""
    if not len(runs):
        return []
    blocks, ys = _equal_rows(runs)
    return close(_border_steps(blocks), scale, ys)


def _equal_rows(runs: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Runs of one row for each stretch of rows that have the same ones, and the lower limits of these."""
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    y, first, n = np.unique(runs[:, 0], return_index=True, return_counts=True)
    row = np.repeat(np.arange(len(y)), n)
    before = np.maximum(np.arange(len(runs)) - n[row], 0)
    same = np.logical_and.reduceat((runs[:, 1:] == runs[before, 1:]).all(axis=1), first)
    same[1:] &= (n[1:] == n[:-1]) & (y[1:] == y[:-1] + 1)
    same[0] = False
    start = np.flatnonzero(~same)
    low, high = y[start], y[np.append(start[1:], len(y)) - 1] + 1
    ys = np.union1d(low, high)  # rows without runs between two stretches are one of their own
    kept = runs[~same[row]]
    return np.column_stack([np.searchsorted(ys, kept[:, 0]), kept[:, 1:]]), ys.tolist()


def close(steps: dict, scale: float, ys: list[int] | None = None) -> list[list[list[tuple[float, float]]]]:
    """Multipolygon from directed border pieces; with ``ys`` their rows are places in that list."""
    rings = _rings(steps)
    if ys is not None:
        rings = [[(x, ys[y]) for x, y in r] for r in rings]
    areas = [signed_area(r) for r in rings]
    polys = [[r] for r, a in zip(rings, areas) if a > 0]
    sizes = [a for a in areas if a > 0]
    for ring, a in zip(rings, areas):
        if a >= 0:
            continue
        # A hole runs clockwise; half a pixel right of its first upward step lies outside of it.
        (x, y), (x2, y2) = ring[0], ring[1]
        mx, my = (x + x2) / 2, (y + y2) / 2
        ux, uy = np.sign(x2 - x), np.sign(y2 - y)
        px, py = mx - uy * 0.25, my + ux * 0.25
        owners = [i for i, p in enumerate(polys) if holds(p[0], px, py)]
        polys[min(owners, key=lambda i: sizes[i])].append(ring)
    return [[[(x * scale, y * scale) for x, y in r] for r in p] for p in polys]


CLOSED, OPEN, EDGE = 0, 1, 2  # kinds of a tile's lines


def tile_lines(runs: np.ndarray, tile: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Border lines of the runs of one tile, as (kind, points), inside on the left.

    ``CLOSED`` rings lie within the tile and visit no point twice.  ``OPEN`` lines go from one tile line
    to another and are cut where two lines meet.  An ``EDGE`` is a pixel's border on a tile line.
    """
    out: list[tuple[int, list[tuple[int, int]]]] = []
    steps: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for (x, y), ends in _border_steps(runs).items():
        for x2, y2 in ends:
            if y % tile == 0 if y == y2 else x % tile == 0:
                dx, dy = int(np.sign(x2 - x)), int(np.sign(y2 - y))
                out += [(EDGE, [(x + k * dx, y + k * dy), (x + (k + 1) * dx, y + (k + 1) * dy)]) for k in range(abs(x2 - x) + abs(y2 - y))]
            else:
                steps.setdefault((x, y), []).append((x2, y2))
    meeting = {v for v, ends in steps.items() if len(ends) > 1}
    for start in [v for v in steps if v[0] % tile == 0 or v[1] % tile == 0]:
        while steps.get(start):
            line, at, heading = [start], start, None
            while True:
                to = _next(steps, at, heading)
                heading, at = (np.sign(to[0] - at[0]), np.sign(to[1] - at[1])), to
                line.append(at)
                on_line = at[0] % tile == 0 or at[1] % tile == 0
                if on_line or at in meeting:
                    out.append((OPEN, _without_inner_straight(line)))
                    line = [at]
                if on_line:
                    break
    return out + [(CLOSED, r) for r in _rings(steps)]


def _next(steps: dict, at: tuple, heading: tuple | None) -> tuple:
    """Where a line goes on: to the left where it may choose."""
    nexts = steps[at]
    pick = 0
    if len(nexts) > 1 and heading is not None:
        pick = int(np.argmax([heading[0] * np.sign(n[1] - at[1]) - heading[1] * np.sign(n[0] - at[0]) for n in nexts]))
    to = nexts.pop(pick)
    if not nexts:
        del steps[at]
    return to


def _without_inner_straight(line: list) -> list:
    inner = [b for a, b, c in zip(line, line[1:], line[2:]) if (b[0] - a[0]) * (c[1] - b[1]) != (b[1] - a[1]) * (c[0] - b[0])]
    return [line[0], *inner, line[-1]]


def _tables(col: pa.Array) -> list[np.ndarray]:
    """The rows of each list of structs as a table."""
    flat = col.flatten()
    table = np.column_stack([flat.field(i).to_numpy(zero_copy_only=False) for i in range(flat.type.num_fields)])
    ends = np.cumsum(col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    return [table[a:b] for a, b in zip(np.concatenate([[0], ends[:-1]]), ends)] if len(ends) else []


_POINTS = T.ArrayType(T.StructType([T.StructField("x", T.IntegerType()), T.StructField("y", T.IntegerType())]))
_LINES = T.ArrayType(T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("points", _POINTS)]))


@F.arrow_udf(_LINES)
def _tile_lines(runs: pa.Array, tile: pa.Array) -> pa.Array:
    size = tile[0].as_py() if len(tile) else 1
    found = [tile_lines(t, size) for t in _tables(runs)]
    lines = [line for f in found for line in f]
    xy = np.array([p for _, points in lines for p in points], np.int32).reshape(-1, 2)
    ends = [np.concatenate([[0], np.cumsum([len(x) for x in level])]).astype(np.int32) for level in ([p for _, p in lines], found)]
    points = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(xy[:, i])) for i in range(2)], names=["x", "y"])
    kinds = pa.array([k for k, _ in lines], pa.int32())
    return pa.ListArray.from_arrays(pa.array(ends[1]), pa.StructArray.from_arrays([kinds, pa.ListArray.from_arrays(pa.array(ends[0]), points)], names=["kind", "points"]))


def border_lines(runs: Column, tile: int) -> Column:
    """Border lines of the runs ``(py, x0, x1)`` of one tile, as structs of kind and points."""
    return _tile_lines(runs, F.lit(tile))
