"""Nested geometry values between Arrow and plain Python lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

POINT_TYPE = pa.struct([("x", pa.float64()), ("y", pa.float64())])
GEOM_TYPE = pa.list_(pa.list_(pa.list_(POINT_TYPE)))


def to_geometry_array(geoms: list) -> pa.Array:
    """Arrow geometry column from multipolygons given as lists of rings of ``(x, y)``; None = null."""
    g_off, p_off, r_off, coords, valid = [0], [0], [0], [], []
    points = 0
    for geom in geoms:
        valid.append(geom is not None)
        for poly in geom or ():
            for ring in poly:
                ring = np.asarray(ring, dtype=np.float64).reshape(-1, 2)
                coords.append(ring)
                points += len(ring)
                r_off.append(points)
            p_off.append(len(r_off) - 1)
        g_off.append(len(p_off) - 1)
    xy = np.concatenate(coords) if coords else np.empty((0, 2))
    return assemble(g_off, p_off, r_off, xy, None if all(valid) else [not v for v in valid])


def assemble(g_off, p_off, r_off, xy: np.ndarray, null: list | None = None) -> pa.Array:
    """Arrow geometry column from the offsets of its three list levels and all points."""
    pts = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], fields=list(POINT_TYPE))
    rings = pa.ListArray.from_arrays(pa.array(r_off, pa.int32()), pts)
    polys = pa.ListArray.from_arrays(pa.array(p_off, pa.int32()), rings)
    mask = None if null is None else pa.array(null, pa.bool_())
    return pa.ListArray.from_arrays(pa.array(g_off, pa.int32()), polys, mask=mask)


def from_geometry_array(col: pa.Array) -> list:
    """Multipolygons as lists of numpy rings; null stays None."""
    out: list = []
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    polys, rings = col.values, col.values.values
    pts = rings.values
    xy = np.column_stack([pts.field(0).to_numpy(zero_copy_only=False), pts.field(1).to_numpy(zero_copy_only=False)])
    g, p, r = (a.offsets.to_numpy() for a in (col, polys, rings))
    nulls = col.is_null().to_numpy(zero_copy_only=False)
    for i in range(len(col)):
        if nulls[i]:
            out.append(None)
            continue
        out.append([[xy[r[k] : r[k + 1]] for k in range(p[j], p[j + 1])] for j in range(g[i], g[i + 1])])
    return out
