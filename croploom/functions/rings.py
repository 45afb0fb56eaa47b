"""Ring helpers for the vectorised geometry functions: crossings, loops, nesting."""

from __future__ import annotations

from math import atan2

import numpy as np


SHORT = 8  # points of a ring for which plain numbers are faster than arrays; sums have the same order


def _points(ring) -> list:
    return ring.tolist() if isinstance(ring, np.ndarray) else ring


def signed_area(ring: np.ndarray) -> float:
    if 0 < len(ring) <= SHORT:
        (x0, y0), *others = _points(ring)
        total, ax, ay = 0.0, 0.0, 0.0
        for x, y in others:
            bx, by = x - x0, y - y0
            total += ax * by - bx * ay
            ax, ay = bx, by
        return total / 2
    a = np.asarray(ring, dtype=float)
    a = a - a[0]
    return float(np.sum(a[:-1, 0] * a[1:, 1] - a[1:, 0] * a[:-1, 1]) / 2)


def _crossings(pts: list, y: float) -> list[float]:
    """Where the edges of a short ring cross a row."""
    return [ax + (y - ay) * (bx - ax) / (by - ay) for (ax, ay), (bx, by) in zip(pts, pts[1:]) if (ay > y) != (by > y)]


def holds(ring: np.ndarray, x: float, y: float) -> bool:
    """Even-odd test of a point against a closed ring."""
    if 0 < len(ring) <= SHORT:
        pts = _points(ring)
        return sum(c > x for c in _crossings(pts, y)) % 2 == 1
    a = np.asarray(ring, dtype=float)
    up = (a[:-1, 1] > y) != (a[1:, 1] > y)
    lo, hi = a[:-1][up], a[1:][up]
    cross = lo[:, 0] + (y - lo[:, 1]) * (hi[:, 0] - lo[:, 0]) / (hi[:, 1] - lo[:, 1])
    return int(np.sum(cross > x)) % 2 == 1


def loops(points: list) -> list[list]:
    """A closed walk cut into loops that visit no point twice."""
    done: list[list] = []
    path: list = []
    place: dict = {}
    for p in points:
        if p in place:
            i = place[p]
            done.append([*path[i:], p])
            for q in path[i:]:
                del place[q]
            path = path[:i]
        place[p] = len(path)
        path.append(p)
    return done


def part_at_meetings(walk: list) -> list[list]:
    """A closed walk (end not repeated) rearranged into closed walks that do not cross.

    Where the walk comes through a point several times, its arrivals and departures are paired like
    brackets in their order around the point, so that no two passages cross there.
    """
    n = len(walk)
    visits: dict = {}
    for k, p in enumerate(walk):
        visits.setdefault(p, []).append(k)
    follow = list(range(n))  # arrival at k goes on as departure from follow[k]
    for p, ks in visits.items():
        if len(ks) == 1:
            continue
        spokes = []
        for k in ks:
            before, after = walk[k - 1], walk[(k + 1) % n]
            spokes.append((atan2(before[1] - p[1], before[0] - p[0]), 0, k))
            spokes.append((atan2(after[1] - p[1], after[0] - p[0]), 1, k))
        spokes.sort()
        waiting: list = []
        seen = set()
        for _, leaving, k in spokes + spokes:
            if (leaving, k) in seen:
                continue
            if not leaving:
                seen.add((0, k))
                waiting.append(k)
            elif waiting:
                seen.add((1, k))
                follow[waiting.pop()] = k
    out, used = [], [False] * n
    for start in range(n):
        if used[start]:
            continue
        part, k = [], start
        while not used[k]:
            used[k] = True
            part.append(walk[k])
            k = follow[(k + 1) % n]
        out.append(part)
    return out


def inner_point(ring: np.ndarray) -> tuple[float, float]:
    """Some point strictly inside a simple ring: middle of the widest span of a row that avoids corners."""
    if 0 < len(ring) <= SHORT:
        pts = _points(ring)
        best, where = -1.0, (float(pts[0][0]), float(pts[0][1]))
        ys = sorted({y for _, y in pts})
        for low, high in zip(ys, ys[1:]):
            y = (low + high) / 2
            xs = sorted(_crossings(pts, y))
            for x0, x1 in zip(xs[::2], xs[1::2]):
                if x1 - x0 > best:
                    best, where = x1 - x0, (float((x0 + x1) / 2), float(y))
        return where
    a = np.asarray(ring, dtype=float)
    ys = np.unique(a[:, 1])
    best, where = -1.0, (float(a[0, 0]), float(a[0, 1]))
    for y in ((ys[:-1] + ys[1:]) / 2)[:: max(1, (len(ys) - 1) // 16)]:
        up = (a[:-1, 1] > y) != (a[1:, 1] > y)
        lo, hi = a[:-1][up], a[1:][up]
        xs = np.sort(lo[:, 0] + (y - lo[:, 1]) * (hi[:, 0] - lo[:, 0]) / (hi[:, 1] - lo[:, 1]))
        for x0, x1 in zip(xs[::2], xs[1::2]):
            if x1 - x0 > best:
                best, where = x1 - x0, (float((x0 + x1) / 2), float(y))
    return where


def candidate_pairs(segs: np.ndarray, group: np.ndarray | None = None, chunk: int = 2_000_000):
    """Index pairs ``i < j`` of segments whose boxes meet, found along the sorted left ends.

    With ``group`` (ascending numbers) only segments of the same group are paired.
    """
    x0, x1 = np.minimum(segs[:, 0], segs[:, 2]), np.maximum(segs[:, 0], segs[:, 2])
    y0, y1 = np.minimum(segs[:, 1], segs[:, 3]), np.maximum(segs[:, 1], segs[:, 3])
    if group is None:
        group = np.zeros(len(segs), dtype=int)
    order = np.lexsort((x0, group))
    # One ascending key over all groups, with a little slack as it is rounded; the box test below
    # is exact.
    low = np.full(group[-1] + 1, np.inf)
    np.minimum.at(low, group, x0)
    width = np.zeros(group[-1] + 1)
    np.maximum.at(width, group, x1 - low[group])
    scale = 0.5 / np.where(width > 0, width, 1.0)
    key0 = group + (x0 - low[group]) * scale[group]
    key1 = group + (x1 - low[group]) * scale[group]
    reach = np.searchsorted(key0[order], key1[order] + 1e-9, side="right")
    count = reach - np.arange(len(order)) - 1
    start = 0
    while start < len(order):
        total = np.cumsum(count[start:])
        stop = start + max(1, int(np.searchsorted(total, chunk, side="right")))
        n = count[start:stop]
        left = np.repeat(np.arange(start, stop), n)
        right = left + 1 + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        i, j = order[left], order[right]
        near = (y0[i] <= y1[j]) & (y0[j] <= y1[i]) & (x0[j] <= x1[i]) & (x0[i] <= x1[j])
        yield np.minimum(i, j)[near], np.maximum(i, j)[near]
        start = stop


class Contacts:
    """How segments ``i`` and ``j`` of each pair meet.

    ``crossing``: not parallel and sharing one point, at share ``t`` of i and ``u`` of j.
    ``along``: on one line and sharing a point or, with ``stretch``, more than that; ``e0, e1`` are
    the ends of j as shares of i.
    """

    def __init__(self, segs: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
        self.p, self.p_end = segs[i, :2], segs[i, 2:]
        self.q, self.q_end = segs[j, :2], segs[j, 2:]
        self.r = r = self.p_end - self.p
        s, w = self.q_end - self.q, self.q - self.p
        d = r[:, 0] * s[:, 1] - r[:, 1] * s[:, 0]
        wr = w[:, 0] * r[:, 1] - w[:, 1] * r[:, 0]
        with np.errstate(divide="ignore", invalid="ignore"):
            t = (w[:, 0] * s[:, 1] - w[:, 1] * s[:, 0]) / d
            u = wr / d
        # A common end is exact, however nearly parallel the two are; leaving it in opposite
        # directions they share nothing else.
        apart = np.zeros(len(i), dtype=bool)
        for a, one in ((0.0, self.p), (1.0, self.p_end)):
            for b, two in ((0.0, self.q), (1.0, self.q_end)):
                common = (one[:, 0] == two[:, 0]) & (one[:, 1] == two[:, 1])
                t[common], u[common] = a, b
                apart |= common & (np.sum(r * s, axis=1) * (1 - 2 * a) * (1 - 2 * b) < 0)
        self.t, self.u = t, u
        self.crossing = (d != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
        rr = np.sum(r * r, axis=1)
        self.e0 = np.sum(w * r, axis=1) / rr
        self.e1 = self.e0 + np.sum(s * r, axis=1) / rr
        self.lo = np.maximum(0, np.minimum(self.e0, self.e1))
        self.hi = np.minimum(1, np.maximum(self.e0, self.e1))
        self.along = (d == 0) & (wr == 0) & (self.lo <= self.hi)
        self.stretch = self.along & (self.lo < self.hi) & ~apart


def chain(rings: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Edges of many closed rings: ends, ring number, place in the ring, edges per ring.

    Edges of no length (repeated points) are left out.
    """
    sizes = np.array([len(r) - 1 for r in rings])
    segs = np.concatenate([np.hstack([r[:-1], r[1:]]) for r in rings])
    ring_no = np.repeat(np.arange(len(rings)), sizes)
    real = (segs[:, 0] != segs[:, 2]) | (segs[:, 1] != segs[:, 3])
    segs, ring_no = segs[real], ring_no[real]
    sizes = np.bincount(ring_no, minlength=len(rings))
    place = np.arange(len(segs)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return segs, ring_no, place, sizes
