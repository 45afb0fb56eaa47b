"""Raster runs in numpy: scan lines of many polygons, overlaps and borders of many tiles at once.

All functions are called on Arrow batches of one Spark task.  Rows of a tile come one after another; a
tile that a batch cuts through waits for the next one, and is burned first if it has very many runs,
which leaves no more than its pixels.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

# Crossings worked on at a time, rows gathered before tiles are worked on, and rows a tile may wait with.
CROSSINGS = 500_000
GATHERED = 100_000
WAITING = 500_000

_NONE = np.iinfo(np.int64).min  # no parcel
LEAST = _NONE + 1  # a parcel without id, below all others


def first_pixel(v: np.ndarray, scale: float) -> np.ndarray:
    return np.ceil((v - scale / 2) / scale).astype(np.int64)


def _repeat(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows that stand for ``n`` each: the row, and the place within it."""
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)


def edges(geom: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Edges ``ax, ay, bx, by`` that are not level, and the geometry of each, in order.

    Edges with an end that is not finite bound nothing and are left out.
    """
    polys = geom.flatten()
    rings = polys.flatten()
    points = rings.flatten()
    xy = np.column_stack([points.field(0).to_numpy(zero_copy_only=False), points.field(1).to_numpy(zero_copy_only=False)])

    def sizes(a: pa.ListArray) -> np.ndarray:
        return a.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)

    owner = np.repeat(np.repeat(np.repeat(np.arange(len(geom)), sizes(geom)), sizes(polys)), sizes(rings))
    ring = np.repeat(np.arange(len(rings)), sizes(rings))
    e = np.hstack([xy[:-1], xy[1:]]) if len(xy) else np.empty((0, 4))
    keep = (ring[:-1] == ring[1:]) & (e[:, 1] != e[:, 3]) & np.isfinite(e).all(axis=1)
    return e[keep], owner[:-1][keep]


def scan(e: np.ndarray, owner: np.ndarray, scale: float, block: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs ``owner, py, px, x0, x1`` of polygons given by their edges, by the even-odd rule on pixel
    centres, cut at block borders; a bounded number of crossings at a time."""
    low, high = np.minimum(e[:, 1], e[:, 3]), np.maximum(e[:, 1], e[:, 3])
    r0 = first_pixel(low, scale) - 1
    n = first_pixel(high, scale) + 1 - r0
    ends = np.cumsum(n)
    at = 0
    while at < len(e):
        # whole polygons, one at least
        to = max(int(np.searchsorted(ends, ends[at] - n[at] + CROSSINGS)), at + 1)
        to = int(np.searchsorted(owner, owner[to - 1], side="right"))
        k, i = _repeat(n[at:to])
        k += at
        py = r0[k] + i
        y = (py + 0.5) * scale
        hit = (low[k] <= y) & (high[k] > y)
        k, py, y = k[hit], py[hit], y[hit]
        ax, ay, bx, by = e[k].T
        x = ax + (y - ay) * (bx - ax) / (by - ay)
        who = owner[k]
        order = np.lexsort((x, py, who))
        x, py, who = x[order], py[order], who[order]
        new = np.ones(len(x), dtype=bool)
        new[1:] = (who[1:] != who[:-1]) | (py[1:] != py[:-1])
        start = np.flatnonzero(new)
        place = np.arange(len(x)) - start[np.cumsum(new) - 1] if len(x) else np.empty(0, int)
        a = np.flatnonzero((place[:-1] % 2 == 0) & ~new[1:])
        x0, x1 = first_pixel(x[a], scale), first_pixel(x[a + 1], scale)
        some = x0 < x1
        yield _cut(who[a][some], py[a][some], x0[some], x1[some], block)
        at = to


def _cut(who, py, x0, x1, block: int) -> tuple[np.ndarray, ...]:
    b0 = x0 // block
    k, i = _repeat((x1 - 1) // block - b0 + 1)
    px = b0[k] + i
    return who[k], py[k], px, np.maximum(x0[k], px * block), np.minimum(x1[k], (px + 1) * block)


def codes(t: pa.Table, names: list[str]) -> np.ndarray:
    """One number per distinct row of the named columns; nulls are equal."""
    code = np.zeros(t.num_rows, dtype=np.int64)
    for name in names:
        one = t[name].combine_chunks().dictionary_encode()
        one = one.combine_chunks() if isinstance(one, pa.ChunkedArray) else one
        own = one.indices.fill_null(len(one.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64)
        code = np.unique(code * (len(one.dictionary) + 1) + own, return_inverse=True)[1]
    return code


def _ids(t: pa.Table, name: str) -> np.ndarray:
    return t[name].combine_chunks().cast(pa.int64()).fill_null(LEAST).to_numpy(zero_copy_only=False)


def numbers(t: pa.Table, name: str) -> np.ndarray:
    return t[name].combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)


def merge_equal(t: pa.Table, keys: list[str]) -> pa.Table:
    """Of runs that are equal but for their id, the one with the highest."""
    if t.num_rows < 2:
        return t
    code, cf = codes(t, keys), _ids(t, "cf")
    py, x0, x1 = (numbers(t, c) for c in ("py", "x0", "x1"))
    order = np.lexsort((cf, x1, x0, py, code))
    same = np.ones(len(order) - 1, dtype=bool)
    for v in (code, py, x0, x1):
        same &= v[order][1:] == v[order][:-1]
    return t if not same.any() else t.take(pa.array(np.sort(order[np.append(~same, True)])))


def packed(t: pa.Table, who: str, band: int, block: int, halo: bool) -> pa.Table:
    """Runs of each owner and tile, ``band`` rows of a block, as one row with lists of rows, first pixels and ends.

    With ``halo`` a tile also has the pixels next to it, as runs of one pixel where they lie in the blocks beside it.
    """
    row = np.arange(t.num_rows)
    py, px, x0, x1 = (numbers(t, c) for c in ("py", "px", "x0", "x1"))
    at = py // band
    if halo:
        left, right = np.flatnonzero(x0 == px * block), np.flatnonzero(x1 == (px + 1) * block)
        row = np.concatenate([row, left, right])
        px = np.concatenate([px, px[left] - 1, px[right] + 1])
        x0, x1 = np.concatenate([x0, x0[left], x1[right] - 1]), np.concatenate([x1, x0[left] + 1, x1[right]])
        py = py[row]
        first = (py - 1) // band
        k, i = _repeat((py + 1) // band - first + 1)
        row, px, x0, x1, py, at = row[k], px[k], x0[k], x1[k], py[k], first[k] + i
    own = numbers(t, who)[row]
    order = np.lexsort((x0, py, px, at, own))
    own, at, px = own[order], at[order], px[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (own[1:] != own[:-1]) | (at[1:] != at[:-1]) | (px[1:] != px[:-1])
    start = np.flatnonzero(new)
    offsets = pa.array(np.append(start, len(order)).astype(np.int32))
    out = t.drop_columns([who, "py", "px", "x0", "x1"]).take(pa.array(row[order][start]))
    for name, v in (("_band", at[start]), ("px", px[start])):
        out = out.append_column(name, pa.array(v.astype(np.int32)))
    for name, v in (("_ys", py), ("_x0s", x0), ("_x1s", x1)):
        out = out.append_column(name, pa.ListArray.from_arrays(offsets, pa.array(v[order].astype(np.int32))))
    return out


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per run of what ``packed`` has made; other batches as they come."""
    for b in batches:
        if "_ys" not in b.schema.names:
            yield b
            continue
        t = pa.Table.from_batches([b])
        lists = [t[c].combine_chunks() for c in ("_ys", "_x0s", "_x1s")]
        row = np.repeat(np.arange(t.num_rows), lists[0].value_lengths().to_numpy(zero_copy_only=False))
        out = t.drop_columns(["_ys", "_x0s", "_x1s"]).take(pa.array(row))
        for name, v in zip(("py", "x0", "x1"), lists):
            out = out.append_column(name, v.flatten())
        yield from out.combine_chunks().to_batches()


def by_tile(batches: Iterator[pa.RecordBatch], tile: list[str], work: Callable[[pa.Table], pa.Table], burned: Callable[[pa.Table], pa.Table] | None) -> Iterator[pa.RecordBatch]:
    """``work`` on whole tiles, many at a time, of rows sorted by tile.

    With ``burned`` a tile that has very many rows is put through it before more are taken in.
    """
    held: list[pa.Table] = []
    rows, bound = 0, GATHERED
    for b in batches:
        if not b.num_rows:
            continue
        # burned rows are put beside them, so all fields may be null
        held.append(pa.Table.from_arrays(b.columns, schema=pa.schema([f.with_nullable(True) for f in b.schema])))
        rows += b.num_rows
        if rows < bound:
            continue
        t = pa.concat_tables(held).combine_chunks()
        code = codes(t, tile)
        other = np.flatnonzero(code != code[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield from work(t.slice(0, cut)).to_batches(max_chunksize=50_000)
        rest = t.slice(cut)
        if burned is not None and rest.num_rows >= WAITING:
            rest = burned(rest)
        held, rows = [rest], rest.num_rows
        bound = max(GATHERED, 2 * rows)
    if rows:
        yield from work(pa.concat_tables(held).combine_chunks()).to_batches(max_chunksize=50_000)


class Pieces:
    """Runs cut at each other's ends within their tile and pixel row, with the highest id by year.

    ``row`` is a row of the table that a piece's keys can be read from; ``cf[piece, year]`` the ids.
    """

    def __init__(self, t: pa.Table, keys: list[str], years: list[int] | None):
        self.tile = codes(t, keys)
        py, x0, x1, cf = numbers(t, "py"), numbers(t, "x0"), numbers(t, "x1"), _ids(t, "cf")
        year = _ids(t, "year")
        self.years, place = (np.unique(year, return_inverse=True)) if years is None else (np.array(years), None)
        if place is None:
            ordered = np.argsort(self.years)
            place = ordered[np.searchsorted(self.years, year, sorter=ordered)]
        line = np.unique((self.tile << 33) + (py + (1 << 32)), return_inverse=True)[1]
        at0, at1 = (line << 32) + (x0 + (1 << 31)), (line << 32) + (x1 + (1 << 31))
        ends = np.unique(np.concatenate([at0, at1]))
        # Where several overlap, the last one written is the highest.
        order = np.argsort(cf, kind="stable")
        p0 = np.searchsorted(ends, at0[order])
        k, i = _repeat(np.searchsorted(ends, at1[order]) - p0)
        piece = p0[k] + i
        source = order[k]
        self.row = np.zeros(len(ends), dtype=np.int64)
        self.row[piece] = source
        self.cf = np.full((len(ends), len(self.years)), _NONE)
        self.cf[piece, place[source]] = cf[source]
        if "weak" in t.column_names:
            weak = t["weak"].combine_chunks().fill_null(False).to_numpy(zero_copy_only=False)
            self.weak = np.zeros(self.cf.shape, dtype=bool)
            self.weak[piece, place[source]] = weak[source]
        else:
            self.weak = None
        some = np.flatnonzero((self.cf != _NONE).any(axis=1))
        self.row, self.cf = self.row[some], self.cf[some]
        self.weak = None if self.weak is None else self.weak[some]
        self.tile, self.py = self.tile[self.row], py[self.row]
        self.x0 = (ends[some] & 0xFFFFFFFF) - (1 << 31)
        self.x1 = (ends[some + 1] & 0xFFFFFFFF) - (1 << 31)


def burn_table(t: pa.Table, tile: list[str]) -> pa.Table:
    """The pieces of ``Pieces`` as runs again, one row per piece and year."""
    p = Pieces(t, tile, None)
    k, y = np.nonzero(p.cf != _NONE)
    cf = p.cf[k, y]
    new = {
        "year": pa.array(p.years[y], pa.int64(), mask=p.years[y] == LEAST), "py": p.py[k], "x0": p.x0[k], "x1": p.x1[k],
        "cf": pa.array(cf, pa.int64(), mask=cf == LEAST),
    }
    if p.weak is not None:
        new["weak"] = p.weak[k, y]
    return _table(t, p.row[k], new)


def _table(t: pa.Table, rows: np.ndarray, new: dict) -> pa.Table:
    """The rows of a table with new values for some columns."""
    taken = t.select([c for c in t.column_names if c not in new]).take(pa.array(rows))
    columns = {c: (pa.array(new[c]) if c in new else taken[c]) for c in t.column_names}
    return pa.table({c: v.cast(t.schema.field(c).type) for c, v in columns.items()})


def runs_of_labels(tile: np.ndarray, py: np.ndarray, x0: np.ndarray, x1: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pieces in order of tile, row and place, with neighbours of one label joined: the first piece and
    the end of each run."""
    new = np.ones(len(x0), dtype=bool)
    new[1:] = (tile[1:] != tile[:-1]) | (py[1:] != py[:-1]) | (x0[1:] != x1[:-1]) | (label[1:] != label[:-1])
    first = np.flatnonzero(new)
    return first, x1[np.append(first[1:], len(x0)) - 1] if len(first) else first


def label_numbers(code: np.ndarray, cf: np.ndarray) -> np.ndarray:
    """One number per distinct combination of ids (and ``code``)."""
    number = code
    for column in cf.T:
        own = np.unique(column, return_inverse=True)[1]
        number = np.unique(number * (len(own) + 1) + own, return_inverse=True)[1] if len(own) else number
    return number


def taken_in(py: np.ndarray, x0: np.ndarray, x1: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, ...]:
    """``run, py, x0, x1``: what is left of joined runs when only pixels with eight neighbours of their
    label stay.  ``run`` is one of the runs of that label; labels of different tiles must differ."""
    wide = np.flatnonzero(x1 - x0 > 2)
    k = np.repeat(wide, 6)
    row = py[k] + np.tile([-1, -1, 0, 0, 1, 1], len(wide))
    step = np.tile([1, -1], 3 * len(wide))
    x = np.where(step > 0, x0[k] + 1, x1[k] - 1)
    order = np.lexsort((x, row, label[k]))
    k, row, x = k[order], row[order], x[order]
    cover = np.cumsum(step[order])
    full = np.flatnonzero((cover[:-1] == 3) & (x[:-1] < x[1:]))
    return k[full], row[full], x[full], x[full + 1]
