"""Polygons as columns: measures, membership, exact overlap areas, pixel coverage, simplification, cutting, and codes of places.

A shape is an array of rings; a ring is a flat array of coordinates, x then y,
whose last point repeats the first.  Outlines run counter-clockwise and holes
clockwise, and a place belongs to a shape where the rings wind around it at
all.  So the rings of several shapes, in one array, are their union, whether
they overlap or not.  Null shapes give null; empty ones have no area.

Measures are built-in functions.  What needs the edges of two shapes against
each other goes by Arrow batches.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

RINGS = T.ArrayType(T.ArrayType(T.DoubleType()))
#: Edges of a shape that meet all edges of another at a time; numbers of an array in which small shapes are worked out together.
BLOCK, TOGETHER = 512, 1 << 18
#: Fixed values of the open location code: digits, and units of its tenth and eleventh digit.
OLC_DIGITS, OLC_PAIR, OLC_ROWS, OLC_COLUMNS = "23456789CFGHJMPQRVWX", 8000, 5, 4


# Measures by built-in functions ----------------------------------------------------------------------


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """An upright rectangle as a shape."""
    return F.array(F.array(x0, y0, x1, y0, x1, y1, x0, y1, x0, y0))


def _over_edges(ring: Column, term) -> Column:
    """Sum of term(x, y, next x, next y) over the edges of a ring."""
    last = (F.size(ring) / 2).cast("int") - 2
    edges = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    at = lambda i, k: F.get(ring, i * 2 + k)
    return F.aggregate(edges, F.lit(0.0), lambda s, i: s + term(at(i, 0), at(i, 1), at(i, 2), at(i, 3)))


def _over_rings(rings: Column, term) -> Column:
    return F.when(rings.isNotNull(), F.aggregate(rings, F.lit(0.0), lambda s, r: s + _over_edges(r, term)))


def area(rings: Column) -> Column:
    """Outlines less holes; where outlines overlap, use `union_area`."""
    return _over_rings(rings, lambda x, y, u, v: (x * v - u * y) / 2)


def perimeter(rings: Column) -> Column:
    return _over_rings(rings, lambda x, y, u, v: F.hypot(u - x, v - y))


def centroid(rings: Column) -> Column:
    """(x, y) of the centre of gravity; null without area."""
    a = area(rings)
    cx = _over_rings(rings, lambda x, y, u, v: (x + u) * (x * v - u * y) / 6)
    cy = _over_rings(rings, lambda x, y, u, v: (y + v) * (x * v - u * y) / 6)
    return F.when(a != 0, F.struct((cx / a).alias("x"), (cy / a).alias("y")))


def bounds(rings: Column) -> Column:
    """(xmin, ymin, xmax, ymax); null for empty shapes."""
    flat = F.flatten(rings)
    xs, ys = F.filter(flat, lambda _, i: i % 2 == 0), F.filter(flat, lambda _, i: i % 2 == 1)
    return F.when(F.size(flat) > 0, F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax")))


def vertices(rings: Column) -> Column:
    """Number of points, the repeated last ones left out."""
    return F.aggregate(rings, F.lit(0), lambda n, r: n + F.greatest(F.lit(0), (F.size(r) / 2).cast("int") - 1))


def thinness(rings: Column) -> Column:
    """Perimeter squared over area: 4 pi for a circle, more for slivers; null without area."""
    return F.try_divide(perimeter(rings) * perimeter(rings), F.nullif(area(rings), F.lit(0.0)))


def present(rings: Column) -> Column:
    """Whether there is a shape with any point; false for null."""
    return F.coalesce(F.size(F.flatten(rings)) > 0, F.lit(False))


def defects(rings: Column) -> Column:
    """Names of what is wrong, in order: open_ring, few_points, no_area."""
    bad = {
        "open_ring": F.exists(rings, lambda r: (F.size(r) > 0) & ((F.get(r, F.lit(0)) != F.get(r, F.size(r) - 2)) | (F.get(r, F.lit(1)) != F.get(r, F.size(r) - 1)))),
        "few_points": F.exists(rings, lambda r: F.size(r) < 8),
        "no_area": F.coalesce(area(rings), F.lit(0.0)) <= 0,
    }
    return F.filter(F.array(*(F.when(is_bad, F.lit(name)) for name, is_bad in bad.items())), lambda x: x.isNotNull())


def mended(rings: Column) -> Column:
    """Rings closed, those of fewer than three points left out."""
    whole = F.transform(rings, lambda r: F.when((F.get(r, F.lit(0)) == F.get(r, F.size(r) - 2)) & (F.get(r, F.lit(1)) == F.get(r, F.size(r) - 1)), r).otherwise(F.concat(r, F.slice(r, 1, 2))))
    return F.filter(whole, lambda r: F.size(r) >= 8)


def holds(rings: Column, px: Column, py: Column) -> Column:
    """Whether a shape holds a point: its rings wind around it.  Lower and left edges belong to it, others don't."""

    def turn(x: Column, y: Column, u: Column, v: Column) -> Column:
        side = (u - x) * (py - y) - (px - x) * (v - y)
        return F.when((y <= py) & (v > py) & (side > 0), 1.0).when((y > py) & (v <= py) & (side < 0), -1.0).otherwise(0.0)

    return _over_rings(rings, turn) != 0


@F.arrow_udf(T.BooleanType())
def held(rings: pa.Array, px: pa.Array, py: pa.Array) -> pa.Array:
    """holds() of many shapes and points at a time; false for null."""
    (e, of), n = _edges_of(rings), len(rings)
    x, y, u, v = e.T
    p, q = (z.to_numpy(zero_copy_only=False)[of] for z in (px, py))
    side = (u - x) * (q - y) - (p - x) * (v - y)
    turn = ((y <= q) & (v > q) & (side > 0)).astype(float) - ((y > q) & (v <= q) & (side < 0))
    return pa.array(np.bincount(of, turn, n) != 0)


def convert_area(value: Column, source: str, target: str) -> Column:
    """Between m2, ha, km2, sqft and acre."""
    square_metres = {"m2": 1.0, "ha": 1e4, "km2": 1e6, "sqft": 0.09290304, "acre": 4046.8564224}
    return value * F.lit(square_metres[source] / square_metres[target])


# Edges against edges ---------------------------------------------------------------------------------


def _edges(rings) -> np.ndarray:
    """Rows (x, y, u, v) of the edges that aren't level."""
    parts = []
    for r in rings:
        p = np.asarray(r, float).reshape(-1, 2)
        if len(p) > 1:
            parts.append(np.hstack([p[:-1], p[1:]]))
    e = np.concatenate(parts) if parts else np.empty((0, 4))
    return e[e[:, 1] != e[:, 3]]


def _crossings(e: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Heights at which edges of e and f cross."""
    out = []
    for i in range(0, len(e), BLOCK):
        a = e[i : i + BLOCK, None, :]
        dx, dy, gx, gy = a[..., 2] - a[..., 0], a[..., 3] - a[..., 1], f[None, :, 2] - f[None, :, 0], f[None, :, 3] - f[None, :, 1]
        d = dx * gy - dy * gx
        with np.errstate(divide="ignore", invalid="ignore"):
            t = ((f[None, :, 0] - a[..., 0]) * gy - (f[None, :, 1] - a[..., 1]) * gx) / d
            s = ((f[None, :, 0] - a[..., 0]) * dy - (f[None, :, 1] - a[..., 1]) * dx) / d
            hit = (d != 0) & (t > 0) & (t < 1) & (s > 0) & (s < 1)
            out.append((a[..., 1] + t * dy)[hit])
    return np.concatenate(out) if out else np.empty(0)


def overlap(a, b) -> tuple[float, float, float]:
    """(area of a, area of b, area of both), each as a union of its rings; exact for straight edges.

    Between two neighbouring heights at which an edge ends or two cross, the inside is made of trapezoids, whose area is
    their height times their width half way up.
    """
    e, f = _edges(a), _edges(b)
    every = np.concatenate([e, f])
    if not len(every):
        return 0.0, 0.0, 0.0
    heights = np.unique(np.concatenate([every[:, 1], every[:, 3], _crossings(every, every)]))
    owner = np.arange(len(every)) >= len(e)
    low, high = np.minimum(every[:, 1], every[:, 3]), np.maximum(every[:, 1], every[:, 3])
    way = np.where(every[:, 3] > every[:, 1], 1, -1)
    total = np.zeros(3)
    for i in range(0, len(heights) - 1, BLOCK):
        y0, y1 = heights[:-1][i : i + BLOCK], heights[1:][i : i + BLOCK]
        mid = (y0 + y1) / 2
        on = (low <= mid[:, None]) & (mid[:, None] < high)
        x = np.where(on, every[:, 0] + (mid[:, None] - every[:, 1]) * (every[:, 2] - every[:, 0]) / (every[:, 3] - every[:, 1]), np.inf)
        order = np.argsort(x, axis=1)
        x = np.take_along_axis(x, order, 1)
        turn = np.where(np.take_along_axis(on, order, 1), way[order], 0)
        second = owner[order]
        in_a, in_b = np.cumsum(np.where(second, 0, turn), 1)[:, :-1] != 0, np.cumsum(np.where(second, turn, 0), 1)[:, :-1] != 0
        with np.errstate(invalid="ignore"):
            width = np.where(np.isfinite(x[:, 1:]), np.diff(x, axis=1), 0.0)
        total += [((y1 - y0) * (width * inside).sum(1)).sum() for inside in (in_a, in_b, in_a & in_b)]
    return float(total[0]), float(total[1]), float(total[2])


def _edges_of(shapes: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """_edges() of all shapes of an Arrow array, one after the other, and the place of each edge's shape in the array."""
    rings = shapes.flatten()
    values = rings.flatten().to_numpy(zero_copy_only=False)
    lengths = lambda x: pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    shape_of, length = np.repeat(np.arange(len(shapes)), lengths(shapes)), lengths(rings)
    points = length // 2
    ring_of = np.repeat(np.arange(len(rings)), points)
    at = np.repeat(np.cumsum(length) - length, points) + 2 * (np.arange(len(ring_of)) - np.repeat(np.cumsum(points) - points, points))
    first = np.flatnonzero(ring_of[:-1] == ring_of[1:])
    e = np.stack([values[at[first]], values[at[first] + 1], values[at[first + 1]], values[at[first + 1] + 1]], 1)
    sloping = e[:, 1] != e[:, 3]
    return e[sloping], shape_of[ring_of[first]][sloping]


def _overlaps(e: np.ndarray, valid: np.ndarray, split: int) -> np.ndarray:
    """overlap() of many pairs at once: edges (pairs, places, 4), and which places hold one; those from `split` on are of the second shape."""
    out, plain = _plain_overlaps(e, valid, split)
    if not plain.all():
        second = np.broadcast_to(np.arange(e.shape[1]) >= split, valid.shape)
        out[~plain] = _crossed_overlaps(e[~plain], valid[~plain], second[~plain])
    return out


def _plain_overlaps(e: np.ndarray, valid: np.ndarray, split: int) -> tuple[np.ndarray, np.ndarray]:
    """_overlaps(), and for which pairs it holds: those of shapes that are one interval at each height, as convex ones are.

    Between two heights at which edges end, both are trapezoids, so the width of their common part is linear but for two breaks.
    """
    from_y = np.sort(np.where(valid, e[..., 1], np.nan), 1)
    plain = (np.isnan(from_y) | (from_y == np.sort(np.where(valid, e[..., 3], np.nan), 1))).all(1)
    near = 1e-12 * np.abs(e).max((1, 2))
    heights = np.ascontiguousarray(from_y.T)
    y, high = (heights[:-1], heights[1:]), np.nan_to_num(heights[1:] - heights[:-1])
    mid = (y[0] + y[1]) / 2
    side = []
    for part in (slice(0, split), slice(split, None)):
        x0, y0, x1, y1 = np.ascontiguousarray(e[:, part].transpose(2, 1, 0))
        up, there = y1 > y0, np.ascontiguousarray(valid[:, part].T)
        low, top = np.where(there, np.minimum(y0, y1), np.inf), np.maximum(y0, y1)
        with np.errstate(divide="ignore", invalid="ignore"):
            slope = np.where(there, (x1 - x0) / (y1 - y0), 0.0)
        ends = np.zeros((4, *mid.shape))
        count = np.zeros((2, *mid.shape), np.int8)
        for i in range(len(x0)):
            on = (low[i] <= mid) & (mid < top[i])
            for k, mine in ((0, on & ~up[i]), (1, on & up[i])):
                count[k] += mine
                for j in (0, 1):
                    np.copyto(ends[2 * k + j], x0[i] + (y[j] - y0[i]) * slope[i], where=mine)
        plain &= ((count[0] == count[1]) & (count[0] <= 1)).all(0) & (ends[2:] - ends[:2] >= -near).all((0, 1))
        side.append((count[0] > 0, *ends))
    (in_a, a0, a1, c0, c1), (in_b, b0, b1, d0, d1) = side

    def meet(p0, p1, q0, q1):
        """Where two lines cross, as a share of the way; 0 where they don't."""
        g, h = p0 - q0, p1 - q1
        out = np.zeros_like(g)
        return np.divide(g, g - h, out=out, where=(g < 0) != (h < 0)).clip(0, 1)

    s, t = meet(a0, a1, b0, b1), meet(c0, c1, d0, d1)
    ways = (0.0, np.minimum(s, t), np.maximum(s, t), 1.0)
    width = [np.minimum(c0, d0) - np.maximum(a0, b0)]
    width += [np.minimum(c0 + w * (c1 - c0), d0 + w * (d1 - d0)) - np.maximum(a0 + w * (a1 - a0), b0 + w * (b1 - b0)) for w in ways[1:3]]
    width.append(np.minimum(c1, d1) - np.maximum(a1, b1))
    both = np.zeros_like(s)
    for k in range(3):
        f, g = width[k], width[k + 1]
        p = np.maximum(f, 0) + np.maximum(g, 0)
        both += (ways[k + 1] - ways[k]) * np.divide(p * p, np.abs(f - g), out=p, where=(f < 0) != (g < 0)) / 2
    sums = [np.where(in_a, (c0 - a0 + c1 - a1) / 2, 0.0), np.where(in_b, (d0 - b0 + d1 - b1) / 2, 0.0), np.where(in_a & in_b, both, 0.0)]
    return np.stack([(x * high).sum(0) for x in sums], 1), plain


def _crossed_overlaps(e: np.ndarray, valid: np.ndarray, second: np.ndarray) -> np.ndarray:
    """_overlaps() of shapes of any kind."""
    x0, y0, x1, y1 = (e[..., i] for i in range(4))
    i, j = np.triu_indices(e.shape[1], 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        slope = (x1 - x0) / (y1 - y0)
        dx, dy, gx, gy = x1[:, i] - x0[:, i], y1[:, i] - y0[:, i], x1[:, j] - x0[:, j], y1[:, j] - y0[:, j]
        d = dx * gy - dy * gx
        t = ((x0[:, j] - x0[:, i]) * gy - (y0[:, j] - y0[:, i]) * gx) / d
        u = ((x0[:, j] - x0[:, i]) * dy - (y0[:, j] - y0[:, i]) * dx) / d
        hit = (t > 0) & (t < 1) & (u > 0) & (u < 1) & valid[:, i] & valid[:, j]
        crossed = np.where(hit, y0[:, i] + t * dy, np.nan)
        heights = np.sort(np.concatenate([np.where(valid, y0, np.nan), np.where(valid, y1, np.nan), crossed], 1), 1)
        high, mid = np.diff(heights, axis=1), (heights[:, 1:] + heights[:, :-1]) / 2
        on = (np.minimum(y0, y1)[:, None, :] <= mid[:, :, None]) & (mid[:, :, None] < np.maximum(y0, y1)[:, None, :]) & valid[:, None, :]
        x = np.where(on, x0[:, None, :] + (mid[:, :, None] - y0[:, None, :]) * slope[:, None, :], np.inf)
        order = np.argsort(x, axis=2)
        x = np.take_along_axis(x, order, 2)
        way = np.where(on, np.where(y1 > y0, 1, -1)[:, None, :], 0)
        turn, owner = np.take_along_axis(way, order, 2), np.take_along_axis(np.broadcast_to(second[:, None, :], order.shape), order, 2)
        in_a, in_b = np.cumsum(np.where(owner, 0, turn), 2)[..., :-1] != 0, np.cumsum(np.where(owner, turn, 0), 2)[..., :-1] != 0
        area = np.where(np.isfinite(x[..., 1:]), np.diff(x, axis=2), 0.0) * np.where(np.isfinite(high), high, 0.0)[:, :, None]
    return np.stack([np.where(inside, area, 0.0).sum((1, 2)) for inside in (in_a, in_b, in_a & in_b)], 1)


def _together(e: np.ndarray, of_e: np.ndarray, f: np.ndarray, of_f: np.ndarray, n: int, pair) -> np.ndarray:
    """overlap() of n pairs, as rows, from the edges of their first and second shapes; pairs of few edges are worked out together, others by pair(number)."""
    out = np.zeros((n, 3))
    counts = [np.bincount(of, minlength=n) for of in (of_e, of_f)]
    begins = [np.cumsum(c) - c for c in counts]
    few = counts[0] + counts[1] <= 32
    kinds = [np.where(c > 0, np.maximum(4, 1 << np.ceil(np.log2(np.maximum(c, 1))).astype(int)), 0) for c in counts]
    for kind in np.unique(np.where(few, kinds[0] * 64 + kinds[1], 0)):
        split, rest = divmod(int(kind), 64)
        places = split + rest
        if not places:
            continue
        some = np.flatnonzero(few & (kinds[0] == split) & (kinds[1] == rest))
        step = max(1, TOGETHER // (places * (2 * places + places * (places - 1) // 2)))
        for k in range(0, len(some), step):
            part = some[k : k + step]
            edges, valid = np.zeros((len(part), places, 4)), np.zeros((len(part), places), bool)
            for every, count, begin, at, width in ((e, counts[0], begins[0], 0, split), (f, counts[1], begins[1], split, rest)):
                if width:
                    there = np.arange(width) < count[part][:, None]
                    edges[:, at : at + width] = np.where(there[..., None], every[np.minimum(begin[part][:, None] + np.arange(width), len(every) - 1)], 0.0)
                    valid[:, at : at + width] = there
            out[part] = _overlaps(edges, valid, split)
    for at in np.flatnonzero(~few):
        out[at] = overlap(*pair(int(at)))
    return out


def overlaps(pairs: list[tuple]) -> np.ndarray:
    """overlap() of each pair of shapes, as rows."""
    sides = []
    for k in (0, 1):
        edges = [_edges(p[k]) for p in pairs]
        sides += [np.concatenate([np.empty((0, 4)), *edges]), np.repeat(np.arange(len(pairs)), [len(x) for x in edges])]
    return _together(*sides, len(pairs), pairs.__getitem__)


@F.arrow_udf(T.StructType([T.StructField(k, T.DoubleType()) for k in ("first", "second", "both")]))
def overlap_areas(a: pa.Array, b: pa.Array) -> pa.Array:
    """Areas of two shapes and of their intersection; null where one is."""
    absent = pc.or_(a.is_null(), b.is_null()).to_numpy(zero_copy_only=False)
    out = _together(*_edges_of(a), *_edges_of(b), len(a), lambda k: (a[k].as_py() or [], b[k].as_py() or []))
    return pa.StructArray.from_arrays([pa.array(x, mask=absent) for x in out.T.copy()], ["first", "second", "both"])


#: Worked out once, and not again where its result is filtered.
overlap_areas = overlap_areas.asNondeterministic()


@F.pandas_udf(T.DoubleType())
def union_area(rings: pd.Series) -> pd.Series:
    """Area that the rings cover, places covered twice counted once."""
    out = pd.Series(np.nan, index=rings.index)
    if rings.notna().any():
        out[rings.notna()] = overlaps([(r, []) for r in rings[rings.notna()]])[:, 0]
    return out


def coverage(rings, x0: float, y0: float, size: float, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Covered share, 0 to 1, of square pixels (row, col) of a grid whose pixel (0, 0) has its lower left corner in (x0, y0)."""
    left, low = x0 + cols * size, y0 + rows * size
    px, py = left + size / 2, low + size / 2
    wind, touched = np.zeros(len(rows), int), np.zeros(len(rows), bool)
    for r in rings:
        p = np.asarray(r, float).reshape(-1, 2)
        for (x, y), (u, v) in zip(p[:-1], p[1:], strict=True):
            side = (u - x) * (py - y) - (px - x) * (v - y)
            wind += ((y <= py) & (v > py) & (side > 0)).astype(int) - ((y > py) & (v <= py) & (side < 0))
            touched |= (max(x, u) > left) & (min(x, u) < left + size) & (max(y, v) > low) & (min(y, v) < low + size)
    out = (wind != 0).astype(float)
    cut = np.flatnonzero(touched)
    squares = [[[a, b, a + size, b, a + size, b + size, a, b + size, a, b]] for a, b in zip(left[cut].tolist(), low[cut].tolist(), strict=True)]
    out[cut] = overlaps([(rings, q) for q in squares])[:, 2] / (size * size)
    return out


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("value", T.DoubleType()), T.StructField("weight", T.DoubleType())])))
def covered_values(rings: pd.Series, rows: pd.Series, cols: pd.Series, values: pd.Series, x0: pd.Series, y0: pd.Series, size: pd.Series) -> pd.Series:
    """Of the pixels of a tile: each value with the pixels of it that the shape covers, as a sum of shares."""
    out = []
    for g, r, c, v, a, b, s in zip(rings, rows, cols, values, x0, y0, size, strict=True):
        w = coverage(g, a, b, s, np.asarray(r, float), np.asarray(c, float))
        found, at = np.unique(np.asarray(v, float), return_inverse=True)
        sums = np.bincount(at, w, len(found))
        out.append([{"value": x, "weight": y} for x, y in zip(found.tolist(), sums.tolist(), strict=True) if y > 0])
    return pd.Series(out)


def simpler(points: np.ndarray, tolerance: float) -> np.ndarray:
    """The points of a line that stay when none left out is further than tolerance from what joins its neighbours that stay."""
    keep = np.zeros(len(points), bool)
    keep[[0, -1]] = True
    todo = [(0, len(points) - 1)]
    while todo:
        i, j = todo.pop()
        if j - i < 2:
            continue
        a, d, p = points[i], points[j] - points[i], points[i + 1 : j]
        length = np.hypot(*d)
        t = np.clip(((p - a) @ d) / (length * length), 0, 1)[:, None] if length else np.zeros((len(p), 1))
        far = np.hypot(*(p - a - t * d).T)
        k = int(far.argmax())
        if far[k] > tolerance:
            keep[i + 1 + k] = True
            todo += [(i, i + 1 + k), (i + 1 + k, j)]
    return points[keep]


@F.pandas_udf(RINGS)
def simplified(rings: pd.Series, tolerance: pd.Series) -> pd.Series:
    """Each ring with fewer points; rings that shrink to less than three are left out."""
    out = []
    for g, t in zip(rings, tolerance, strict=True):
        cut = [simpler(np.asarray(r, float).reshape(-1, 2), t) for r in g] if g is not None else None
        out.append(None if cut is None else [c.ravel().tolist() for c in cut if len(c) >= 4])
    return pd.Series(out)


def clipped(points: np.ndarray, axis: int, at: float, above: bool) -> np.ndarray:
    """A closed ring cut at a line across an axis; what lies above (below) it stays."""
    if len(points) < 2:
        return points[:0]
    d = (points[:, axis] - at) * (1 if above else -1)
    inside = d >= 0
    cut = np.flatnonzero(inside[:-1] != inside[1:])
    crossing = points[cut] + (points[cut + 1] - points[cut]) * (d[cut] / (d[cut] - d[cut + 1]))[:, None]
    kept = np.flatnonzero(inside[:-1])
    out = np.concatenate([points[kept], crossing])[np.argsort(np.concatenate([2 * kept, 2 * cut + 1]), kind="stable")]
    return np.concatenate([out, out[:1]]) if len(out) > 2 else points[:0]


def pieces(rings: list[np.ndarray], most: int) -> list[list[list[float]]]:
    """A shape cut in halves across its longer side until no piece has more than `most` points."""
    out, todo = [], [(rings, 0)]
    while todo:
        part, depth = todo.pop()
        if not part:
            continue
        if sum(len(r) - 1 for r in part) <= most or depth >= 40:
            out.append([r.ravel().tolist() for r in part])
            continue
        every = np.concatenate(part)
        low, high = every.min(0), every.max(0)
        axis = int(high[1] - low[1] > high[0] - low[0])
        at = (low[axis] + high[axis]) / 2
        for above in (False, True):
            todo.append(([c for r in part if len(c := clipped(r, axis, at, above))], depth + 1))
    return out


@F.pandas_udf(T.ArrayType(RINGS))
def subdivided(rings: pd.Series, most: pd.Series) -> pd.Series:
    """Pieces of bounded size that make up the shape; to be exploded."""
    return pd.Series([None if g is None else pieces([np.asarray(r, float).reshape(-1, 2) for r in g], int(m)) for g, m in zip(rings, most, strict=True)])


def from_wkb(raw: bytes | None) -> list[list[float]] | None:
    """Rings of a (multi)polygon in well-known binary, turned the way shapes are; None for other kinds."""
    if raw is None:
        return None
    at = 0

    def read(form: str) -> tuple:
        nonlocal at
        found = struct.unpack_from(form, raw, at)
        at += struct.calcsize(form)
        return found

    def one() -> list[list[float]] | None:
        order = "<" if read("B")[0] else ">"
        kind = read(f"{order}I")[0]
        if kind & 0x20000000:
            read(f"{order}I")
        kind &= 0xFF
        out: list[list[float]] = []
        if kind == 6:
            for _ in range(read(f"{order}I")[0]):
                out += one() or []
            return out
        if kind != 3:
            return None
        for k in range(read(f"{order}I")[0]):
            n = read(f"{order}I")[0]
            p = np.array(read(f"{order}{2 * n}d")).reshape(-1, 2)
            turn = float((p[:-1, 0] * p[1:, 1] - p[1:, 0] * p[:-1, 1]).sum())
            out.append((p if (turn > 0) == (k == 0) else p[::-1]).ravel().tolist())
        return out

    return one()


@F.pandas_udf(RINGS)
def shape(wkb: pd.Series) -> pd.Series:
    """Shapes of well-known binary."""
    return pd.Series([from_wkb(b) for b in wkb])


# Codes of places -------------------------------------------------------------------------------------


def _digit(n: Column) -> Column:
    return F.substring(F.lit(OLC_DIGITS), n.cast("int") + 1, F.lit(1))


def location_code(lat: Column, lon: Column, digits: int = 10) -> Column:
    """Open location code of 10 or 11 digits; latitude is held in its range, longitude goes around."""
    rows, columns = (OLC_ROWS, OLC_COLUMNS) if digits > 10 else (1, 1)
    y = F.floor((F.greatest(F.lit(0.0), F.least(lat + 90, F.lit(180 - 1e-9)))) * (OLC_PAIR * rows)).cast("long")
    x = F.floor(F.pmod(lon + 180, F.lit(360.0)) * (OLC_PAIR * columns)).cast("long")
    pairs = []
    for k in range(4, -1, -1):
        for v, fine in ((y, rows), (x, columns)):
            pairs.append(_digit(F.pmod(F.floor(v / (fine * 20**k)), F.lit(20))))
    tail = [_digit(F.pmod(y, F.lit(rows)) * columns + F.pmod(x, F.lit(columns)))] if digits > 10 else []
    return F.concat(*pairs[:8], F.lit("+"), *pairs[8:], *tail)


def location_of(code: Column) -> Column:
    """(lat, lon) of the middle of a code's area of 10 digits; null for other texts."""
    plain = F.upper(F.regexp_replace(code, r"\+", ""))

    def number(first: int) -> Column:
        total = F.lit(0).cast("long")
        for k in range(5):
            total = total * 20 + F.position(F.substring(plain, first + 2 * k, 1), F.lit(OLC_DIGITS)) - 1
        return total

    lat, lon = ((number(i) + 0.5) / OLC_PAIR - r for i, r in ((1, 90), (2, 180)))
    return F.when(plain.rlike(f"^[{OLC_DIGITS}]{{10}}$"), F.struct(lat.alias("lat"), lon.alias("lon")))


def building_code(rings: Column) -> Column:
    """Unique building id: code of the centroid (x: longitude, y: latitude), and how many code areas the box reaches north, east, south and west."""
    b, c = bounds(rings), centroid(rings)
    row, col = (lambda v: F.floor((v + 90) * (OLC_PAIR * OLC_ROWS))), (lambda v: F.floor((v + 180) * (OLC_PAIR * OLC_COLUMNS)))
    reach = [row(b["ymax"]) - row(c["y"]), col(b["xmax"]) - col(c["x"]), row(c["y"]) - row(b["ymin"]), col(c["x"]) - col(b["xmin"])]
    return F.concat_ws("-", location_code(c["y"], c["x"], 11), *(r.cast("long").cast("string") for r in reach))


def shape_id(rings: Column, grid: float = 1e-5, length: int = 16) -> Column:
    """Hash of the box on a grid, of the area's order of magnitude and of the thinness: equal for shapes that hardly differ."""
    b = bounds(rings)
    corners = [F.round(b[k] / grid).cast("long").cast("string") for k in ("xmin", "ymin", "xmax", "ymax")]
    size = F.round(F.log10(F.greatest(area(rings), F.lit(1e-300)) * 1e10) * 10).cast("long").cast("string")
    return F.left(F.sha2(F.concat_ws("|", *corners, size, F.round(thinness(rings)).cast("long").cast("string")), 256), F.lit(length))
