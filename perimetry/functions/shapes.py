"""Polygon functions over Arrow batches: the centroid, and validity in place.

The centroid is a question about one row, asked in one vectorized sweep over a whole batch; higher-order
functions interpret every vertex (about 50 times slower). Validity in place is the cheaper of the two
ways to clean records (``Settings.validity``): it shuffles nothing, but misses interiors that a cycle of
touching rings cuts. The full rule, and what polygons have in common, are joins (``operators.polygons``).

All functions take geometries as nested arrays or as WKB.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perimetry.functions.wkb import decode_array
from perimetry.schema import POINT_TYPE

_CHUNK = 1 << 20  # candidate pairs looked at together


class _Shapes:
    """The points, rings and segments of one Arrow batch of geometries as flat arrays."""

    def __init__(self, geoms: pa.Array) -> None:
        if pa.types.is_binary(geoms.type) or pa.types.is_large_binary(geoms.type):
            geoms = decode_array(geoms)

        def counts(lists: pa.Array) -> np.ndarray:
            return lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)

        per_row, parts = counts(geoms), geoms.flatten()
        per_part, rings = counts(parts), parts.flatten()
        self.ring_len, points = counts(rings), rings.flatten()
        self.x, self.y = (
            np.array(c.to_numpy(zero_copy_only=False), dtype=float) for c in points.flatten()
        )
        self.rows = len(geoms)
        self.ring_part = np.repeat(np.arange(len(per_part)), per_part)
        self.ring_row = np.repeat(np.arange(self.rows), per_row)[self.ring_part]
        first_of_part = np.searchsorted(self.ring_part, self.ring_part)
        self.is_shell = first_of_part == np.arange(len(self.ring_part))
        self.ring_start = np.cumsum(self.ring_len) - self.ring_len
        self.point_ring = np.repeat(np.arange(len(self.ring_len)), self.ring_len)
        self.finite = np.isfinite(self.x) & np.isfinite(self.y)
        self.x[self.x == 0] = 0.0  # no negative zero
        self.y[self.y == 0] = 0.0

        at = np.flatnonzero(self.point_ring[:-1] == self.point_ring[1:])
        moves = (self.x[at] != self.x[at + 1]) | (self.y[at] != self.y[at + 1])
        at = at[moves & self.finite[at] & self.finite[at + 1]]
        self.seg = np.stack([self.x[at], self.y[at], self.x[at + 1], self.y[at + 1]], axis=1)
        self.seg_ring = self.point_ring[at]
        self.seg_row = self.ring_row[self.seg_ring]
        self.seg_count = np.bincount(self.seg_ring, minlength=len(self.ring_len))
        self.seg_no = np.arange(len(at)) - np.searchsorted(self.seg_ring, self.seg_ring)

    def any_row(self, rows: np.ndarray) -> np.ndarray:
        flags = np.zeros(self.rows, bool)
        flags[rows] = True
        return flags


def _runs(counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(owner, offset) of all units of ``counts``, in chunks of about ``_CHUNK``."""
    total = np.cumsum(counts)
    begin = 0
    while begin < len(counts):
        done = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, done + _CHUNK, side="right")))
        part = counts[begin:end]
        owner = np.repeat(np.arange(begin, end), part)
        offset = np.arange(part.sum()) - np.repeat(np.cumsum(part) - part, part)
        if len(owner):
            yield owner, offset
        begin = end


def _meeting(seg: np.ndarray, row: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of segments of one row whose boxes meet: a sweep along x, then a test on y."""
    if not len(seg):
        return
    low, high = np.minimum(seg[:, :2], seg[:, 2:]), np.maximum(seg[:, :2], seg[:, 2:])
    order = np.lexsort((low[:, 0], row))
    values = np.unique(low[:, 0])
    base = row[order] * (len(values) + 1)
    starts = base + np.searchsorted(values, low[order, 0], side="left")
    reach = base + np.searchsorted(values, high[order, 0], side="right") - 1
    counts = np.searchsorted(starts, reach, side="right") - np.arange(len(order)) - 1
    for owner, offset in _runs(counts):
        i, j = order[owner], order[owner + 1 + offset]
        meets = (low[i, 1] <= high[j, 1]) & (low[j, 1] <= high[i, 1])
        yield i[meets], j[meets]


def _turn(ax, ay, bx, by, cx, cy) -> np.ndarray:
    """Sign of the turn a-b-c; doubtful signs are settled in exact arithmetic."""
    left, right = (bx - ax) * (cy - ay), (by - ay) * (cx - ax)
    det = left - right
    sign = np.sign(det)
    at_end = ((cx == ax) & (cy == ay)) | ((cx == bx) & (cy == by))
    sign[at_end] = 0
    # forward error bound of a 2x2 determinant in double precision
    doubtful = (np.abs(det) <= 3.3306690738754716e-16 * (np.abs(left) + np.abs(right))) & ~at_end
    for k in np.flatnonzero(doubtful & ((left != 0) | (right != 0))):
        a, b, c, d, e, f = (Fraction(float(v[k])) for v in (ax, ay, bx, by, cx, cy))
        exact = (c - a) * (f - b) - (d - b) * (e - a)
        sign[k] = (exact > 0) - (exact < 0)
    return sign


def _relation(p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(share a point, cross properly, share a stretch, turns) of segment pairs with meeting boxes."""
    turns = np.stack([
        _turn(*p.T, q[:, 0], q[:, 1]), _turn(*p.T, q[:, 2], q[:, 3]),
        _turn(*q.T, p[:, 0], p[:, 1]), _turn(*q.T, p[:, 2], p[:, 3]),
    ])
    share = (turns[0] * turns[1] <= 0) & (turns[2] * turns[3] <= 0)
    cross = (turns[0] * turns[1] < 0) & (turns[2] * turns[3] < 0)
    low = np.maximum(np.minimum(p[:, :2], p[:, 2:]), np.minimum(q[:, :2], q[:, 2:]))
    high = np.minimum(np.maximum(p[:, :2], p[:, 2:]), np.maximum(q[:, :2], q[:, 2:]))
    stretch = (turns == 0).all(axis=0) & (low < high).any(axis=1)
    return share, cross, stretch, turns


def _locate(x, y, row, shapes: _Shapes, counts_for=None) -> tuple[np.ndarray, np.ndarray]:
    """(inside by even-odd, on a segment) of points against the segments of the same row.

    ``counts_for(point, segment)`` may limit which segments count for which point.
    """
    crossings, on = np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    begin = np.searchsorted(shapes.seg_row, row, side="left")
    number = np.searchsorted(shapes.seg_row, row, side="right") - begin
    for k, offset in _runs(number):
        s = begin[k] + offset
        level = (np.minimum(shapes.seg[s, 1], shapes.seg[s, 3]) <= y[k]) & (
            y[k] <= np.maximum(shapes.seg[s, 1], shapes.seg[s, 3])
        )
        if counts_for is not None:
            level &= counts_for(k, s)
        k, s = k[level], s[level]
        x1, y1, x2, y2 = shapes.seg[s].T
        turn = _turn(x1, y1, x2, y2, x[k], y[k])
        spans = (y1 > y[k]) != (y2 > y[k])
        np.add.at(crossings, k, spans & (turn * np.sign(y2 - y1) > 0))
        within = (np.minimum(x1, x2) <= x[k]) & (x[k] <= np.maximum(x1, x2))
        on[k[(turn == 0) & within]] = True
    return crossings % 2 == 1, on


def valid_rows(shapes: _Shapes) -> np.ndarray:
    """Rings closed, finite and simple; rings of one polygon meet in at most one point, in pairs;
    holes inside their shell and outside each other; polygons of one geometry apart."""
    filled = shapes.ring_len > 0
    last = shapes.ring_start + shapes.ring_len - 1
    broken = filled & ((shapes.ring_len < 4) | (shapes.seg_count < 3))
    ends = np.flatnonzero(filled)
    a, b = shapes.ring_start[ends], last[ends]
    broken[ends] |= (shapes.x[a] != shapes.x[b]) | (shapes.y[a] != shapes.y[b])
    broken[shapes.point_ring[~shapes.finite]] = True
    bad = shapes.any_row(shapes.ring_row[broken])

    touches = []
    keep = np.flatnonzero(~bad[shapes.seg_row])
    seg, ring, no = shapes.seg[keep], shapes.seg_ring[keep], shapes.seg_no[keep]
    for i, j in _meeting(seg, shapes.seg_row[keep]):
        share, cross, stretch, turns = _relation(seg[i], seg[j])
        same = ring[i] == ring[j]
        step = np.abs(no[i] - no[j])
        follows = (step == 1) | (step == shapes.seg_count[ring[i]] - 1)
        wrong = cross | stretch | (same & share & ~follows)
        bad[shapes.ring_row[ring[i[wrong]]]] = True
        touch = np.flatnonzero(share & ~same & ~wrong)
        if len(touch):
            i, j, turns = i[touch], j[touch], turns[:, touch]
            ends = np.stack([seg[j, :2], seg[j, 2:], seg[i, :2], seg[i, 2:]])
            others = np.stack([seg[i], seg[i], seg[j], seg[j]])
            low = np.minimum(others[..., :2], others[..., 2:])
            high = np.maximum(others[..., :2], others[..., 2:])
            hit = (turns == 0) & ((low <= ends) & (ends <= high)).all(axis=2)
            at = ends[hit.argmax(axis=0), np.arange(len(i))]
            touches.append(np.column_stack([
                np.minimum(ring[i], ring[j]), np.maximum(ring[i], ring[j]), at + 0.0
            ]))
    touch = np.unique(np.concatenate(touches), axis=0) if touches else np.zeros((0, 4))
    first, second = touch[:, 0].astype(int), touch[:, 1].astype(int)
    again = (first[1:] == first[:-1]) & (second[1:] == second[:-1])
    again &= shapes.ring_part[first[1:]] == shapes.ring_part[second[1:]]
    bad[shapes.ring_row[first[1:][again]]] = True

    number = np.bincount(shapes.ring_row[filled], minlength=shapes.rows)
    nested = np.flatnonzero(filled & (number[shapes.ring_row] > 1) & ~bad[shapes.ring_row])
    if len(nested):
        owner, x, y = _probes(shapes, nested, touch)
        shell, part = shapes.is_shell[owner], shapes.ring_part

        def counts_for(k, s):
            r, other = owner[k], shapes.seg_ring[s]
            return np.where(shell[k], part[r] != part[other], (part[r] == part[other]) & (r != other))

        inside, on = _locate(x, y, shapes.ring_row[owner], shapes, counts_for)
        bad[shapes.ring_row[owner[(inside == shell) & ~on]]] = True
    return ~bad


def _probes(shapes: _Shapes, rings: np.ndarray, touch: np.ndarray):
    """Points to locate: the first point of a ring, or all its points and segment middles if it
    touches another ring (points on other rings decide nothing and are ignored later)."""
    touched = np.isin(rings, touch[:, :2].astype(int))
    plain = shapes.ring_start[rings[~touched]]
    points = np.flatnonzero(np.isin(shapes.point_ring, rings[touched]))
    segs = np.flatnonzero(np.isin(shapes.seg_ring, rings[touched]))
    middle = (shapes.seg[segs, :2] + shapes.seg[segs, 2:]) / 2
    owner = np.concatenate([rings[~touched], shapes.point_ring[points], shapes.seg_ring[segs]])
    x = np.concatenate([shapes.x[plain], shapes.x[points], middle[:, 0]])
    y = np.concatenate([shapes.y[plain], shapes.y[points], middle[:, 1]])
    return owner, x, y


def centroids(s: _Shapes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(x, y, whether there is one) per row. Shells weigh positive and holes negative, however they
    wind. Without area: the length-weighted middle; without length: the first point. Sums run in
    vertex order relative to the first point, so equal vertex lists give equal doubles."""
    row_points = s.ring_row[s.point_ring]
    first = np.searchsorted(row_points, np.arange(s.rows))
    known = np.bincount(row_points, minlength=s.rows) > 0
    x0, y0 = np.zeros(s.rows), np.zeros(s.rows)
    x0[known], y0[known] = s.x[first[known]], s.y[first[known]]
    ax, ay, bx, by = (s.seg - np.column_stack([x0, y0, x0, y0])[s.seg_row]).T

    def per_ring(values):
        return np.bincount(s.seg_ring, weights=values, minlength=len(s.ring_len))

    def per_row(values):
        return np.bincount(s.ring_row, weights=values, minlength=s.rows)

    cross = ax * by - bx * ay
    area = per_ring(cross)
    role = np.sign(area) * np.where(s.is_shell, 1.0, -1.0)
    total = per_row(role * area)
    length = np.hypot(bx - ax, by - ay)
    line = per_row(per_ring(length))
    flat = total == 0
    x, y = x0.copy(), y0.copy()
    with np.errstate(invalid="ignore", divide="ignore"):
        for out, plus in ((x, ax + bx), (y, ay + by)):
            by_area = per_row(role * per_ring(cross * plus)) / (3 * total)
            by_line = per_row(per_ring(length * plus)) / (2 * line)
            out += np.where(~flat, by_area, np.where(line > 0, by_line, 0.0))
    return x, y, known


def _with_nulls(result: np.ndarray, *inputs: pa.Array) -> pa.Array:
    missing = np.zeros(len(result), bool)
    for column in inputs:
        missing |= column.is_null().to_numpy(zero_copy_only=False)
    return pa.array(result, pa.bool_(), mask=missing)


def _points(x: np.ndarray, y: np.ndarray, known: np.ndarray) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(x), pa.array(y)], names=["x", "y"], mask=pa.array(~known))


@F.arrow_udf(POINT_TYPE)
def centroid(geom: pa.Array) -> pa.Array:
    """Area centroid; null for a missing or empty geometry."""
    return _points(*centroids(_Shapes(geom)))


@F.arrow_udf(T.StructType([T.StructField("valid", T.BooleanType()), T.StructField("centroid", POINT_TYPE)]))
def measure(geom: pa.Array) -> pa.Array:
    """Validity and centroid at once, so that a geometry crosses to Python once."""
    shapes = _Shapes(geom)
    valid = _with_nulls(valid_rows(shapes), geom)
    return pa.StructArray.from_arrays([valid, _points(*centroids(shapes))], names=["valid", "centroid"])
