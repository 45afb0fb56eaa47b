"""WKB in and out, as Arrow-vectorised columns used at ingest and export only."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from croploom.functions.nested import assemble, to_geometry_array
from croploom.schema import GEOM

# WKB type numbers.
POLYGON, MULTIPOLYGON, COLLECTION = 3, 6, 7


def _read(buf: bytes, pos: int, polys: list) -> int:
    """Append the polygons found at ``pos``; returns the position after the geometry.

    Polygons are taken out of collections, extra dimensions are dropped.
    """
    order = "<" if buf[pos] == 1 else ">"
    (kind,) = struct.unpack_from(order + "I", buf, pos + 1)
    pos += 5
    dims = 2
    if kind & 0x80000000:
        dims += 1
    if kind & 0x40000000:
        dims += 1
    if kind & 0x20000000:
        pos += 4
    kind &= 0x0FFFFFFF
    if kind >= 1000:
        dims += {1: 1, 2: 1, 3: 2}[kind // 1000]
        kind %= 1000

    def points(at: int) -> tuple[np.ndarray, int]:
        (n,) = struct.unpack_from(order + "I", buf, at)
        xy = np.frombuffer(buf, order + "f8", n * dims, at + 4).reshape(n, dims)[:, :2]
        return xy, at + 4 + n * dims * 8

    if kind == POLYGON:
        (rings,) = struct.unpack_from(order + "I", buf, pos)
        pos += 4
        poly = []
        for _ in range(rings):
            ring, pos = points(pos)
            poly.append(ring)
        if poly:
            polys.append(poly)
        return pos
    if kind in (MULTIPOLYGON, COLLECTION, 4, 5):
        (n,) = struct.unpack_from(order + "I", buf, pos)
        pos += 4
        for _ in range(n):
            pos = _read(buf, pos, polys)
        return pos
    if kind == 1:
        return pos + dims * 8
    if kind == 2:
        return points(pos)[1]
    raise ValueError(f"geometry type {kind} is not supported")


def decode(buf: bytes | None) -> list | None:
    """Multipolygon of one WKB value; null and unreadable values give None."""
    if buf is None:
        return None
    polys: list = []
    try:
        _read(buf, 0, polys)
    except (struct.error, ValueError, IndexError, KeyError):
        return None
    return polys


def encode(geom: list | None) -> bytes | None:
    """Little-endian 2-D multipolygon."""
    if geom is None:
        return None
    out = [struct.pack("<BII", 1, MULTIPOLYGON, len(geom))]
    for poly in geom:
        out.append(struct.pack("<BII", 1, POLYGON, len(poly)))
        for ring in poly:
            ring = np.ascontiguousarray(ring, dtype="<f8")
            out.append(struct.pack("<I", len(ring)))
            out.append(ring.tobytes())
    return b"".join(out)


def _plain_values(col: pa.Array, raw: np.ndarray, start: np.ndarray, size: np.ndarray):
    """Which values are one little-endian 2-D polygon of one ring, where its points start, how many.

    Most parcels are; their headers are read for the whole column at once.
    """

    def number(at: np.ndarray) -> np.ndarray:
        return raw[at[:, None] + np.arange(4)].astype(np.int64) @ (1, 1 << 8, 1 << 16, 1 << 24)

    plain = np.zeros(len(col), dtype=bool)
    body, points = np.zeros(len(col), np.int64), np.zeros(len(col), np.int64)
    present = col.is_valid().to_numpy(zero_copy_only=False)
    for kind, head in ((POLYGON, 13), (MULTIPOLYGON, 22)):
        k = np.flatnonzero(present & (size >= head))
        at = start[k]
        fits = (raw[at] == 1) & (number(at + 1) == kind) & (number(at + 5) == 1)
        if kind == MULTIPOLYGON:
            fits &= (raw[at + 9] == 1) & (number(at + 10) == POLYGON) & (number(at + 14) == 1)
        n = number(at + head - 4)
        fits &= size[k] == head + 16 * n
        k, n = k[fits], n[fits]
        plain[k], body[k], points[k] = True, start[k] + head, n
    return plain, body, points


def decode_column(col: pa.Array) -> pa.Array:
    if not len(col) or col.null_count == len(col):
        return to_geometry_array([None] * len(col))
    col = col.cast(pa.binary())
    _, ends, data = col.buffers()
    offsets = np.frombuffer(ends, np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)
    plain, body, points = _plain_values(col, raw, offsets[:-1], np.diff(offsets))
    rings = [
        np.frombuffer(data, "<f8", 2 * n, at).reshape(n, 2) if ok else None
        for ok, at, n in zip(plain.tolist(), body.tolist(), points.tolist())
    ]
    if plain.all():
        one_each = np.arange(len(col) + 1)
        return assemble(one_each, one_each, np.append(0, np.cumsum(points)), np.concatenate(rings))
    return to_geometry_array(
        [[[r]] if r is not None else decode(col[k].as_py()) for k, r in enumerate(rings)]
    )


@F.arrow_udf(GEOM)
def from_wkb(col: pa.Array) -> pa.Array:
    return decode_column(col)


def _scatter(out: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Write equally long byte rows at given places."""
    out[at[:, None] + np.arange(rows.shape[1])] = rows


def _headers(kind: int, counts: np.ndarray) -> np.ndarray:
    rows = np.zeros((len(counts), 9), np.uint8)
    rows[:, 0], rows[:, 1] = 1, kind
    rows[:, 5:] = counts.astype("<u4").view(np.uint8).reshape(-1, 4)
    return rows


def _starts(outer: np.ndarray, off: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Where inner parts start: after their outer part's header of nine bytes, one behind the other."""
    ends = np.concatenate([[0], np.cumsum(size)])
    return np.repeat(outer + 9 - ends[off[:-1]], np.diff(off)) + ends[:-1]


def encode_column(col: pa.Array) -> pa.Array:
    """Little-endian 2-D multipolygons of a whole geometry column, from its offsets; null stays null."""
    if not len(col) or col.null_count == len(col):
        return pa.nulls(len(col), pa.binary())
    null = col.is_null().to_numpy(zero_copy_only=False)
    polys = col.flatten()  # without what lies under nulls
    rings = polys.flatten()
    pts = rings.flatten()
    g, p, r = (np.concatenate([[0], np.cumsum(a.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64) for a in (col, polys, rings))
    ring_size = 4 + 16 * np.diff(r)
    poly_size = 9 + np.diff(np.concatenate([[0], np.cumsum(ring_size)])[p])
    geom_size = np.where(null, 0, 9 + np.diff(np.concatenate([[0], np.cumsum(poly_size)])[g]))
    ends = np.concatenate([[0], np.cumsum(geom_size)])
    out = np.zeros(int(ends[-1]), np.uint8)
    poly_at = _starts(ends[:-1], g, poly_size)
    ring_at = _starts(poly_at, p, ring_size)
    _scatter(out, ends[:-1][~null], _headers(MULTIPOLYGON, np.diff(g)[~null]))
    _scatter(out, poly_at, _headers(POLYGON, np.diff(p)))
    _scatter(out, ring_at, np.diff(r).astype("<u4").view(np.uint8).reshape(-1, 4))
    xy = np.column_stack([pts.field(i).to_numpy(zero_copy_only=False) for i in range(2)]).astype("<f8")
    inside = np.arange(len(xy)) - np.repeat(r[:-1], np.diff(r))
    _scatter(out, np.repeat(ring_at + 4, np.diff(r)) + 16 * inside, xy.view(np.uint8).reshape(-1, 16))
    plain = pa.Array.from_buffers(pa.binary(), len(col), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(out)])
    return pc.if_else(pa.array(null), pa.scalar(None, pa.binary()), plain) if null.any() else plain


@F.arrow_udf(T.BinaryType())
def to_wkb(col: pa.Array) -> pa.Array:
    return encode_column(col)
