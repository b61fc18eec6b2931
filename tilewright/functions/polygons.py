"""Features that are polygons: a column ``polygons`` of ``POLYGONS``, one entry for each polygon of a MultiPolygon.

A polygon is an array of closed rings, the first of which is its shell. Measures, bounds, projection, tests
against boxes and clipping to boxes are column expressions. What relates two polygons is one Arrow UDF, which
works on the flat coordinates of a whole batch: all edges of a pair meet all edges of the other one at once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import crs as crs_
from . import rings as rings_
from .box import PREDICATES, Box

POLYGONS = f"array<{rings_.RINGS}>"
#: The column that makes features polygons; without it they are boxes.
COLUMN = "polygons"
#: Areas count as equal up to this share of them.
TOLERANCE = 1e-9
#: Pairs of edges that are compared at once.
AT_ONCE = 1 << 21


def is_polygons(df) -> bool:
    return COLUMN in df.columns


def _let(value: Column, then) -> Column:
    """``then(value)``, with ``value`` computed once however often it is used."""
    return F.get(F.transform(F.array(value), then), 0)


def all_rings(polygons: Column) -> Column:
    return F.flatten(polygons)


def _point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def of_points(polygons: Column, f) -> Column:
    """Each point (x, y) becomes ``f(x, y)``."""
    return F.transform(polygons, lambda p: F.transform(p, lambda r: F.transform(r, lambda q: _point(*f(q["x"], q["y"])))))


def bounds(polygons: Column) -> dict[str, Column]:
    points = F.flatten(F.transform(polygons, lambda p: F.get(p, 0)))
    side = lambda f, c: f(F.transform(points, lambda q: q[c]))
    return {"x0": side(F.array_min, "x"), "y0": side(F.array_min, "y"), "x1": side(F.array_max, "x"), "y1": side(F.array_max, "y")}


def measures(polygons: Column) -> Column:
    """Struct of area, x and y (the centroid): sums about the first point, so that few digits are lost far from the origin."""
    first = F.get(F.get(F.get(polygons, 0), 0), 0)

    def of(origin: Column) -> Column:
        moved = of_points(polygons, lambda x, y: (x - origin["x"], y - origin["y"]))
        zero = F.struct(*[F.lit(0.0).alias(c) for c in ("a", "x", "y")])
        each = F.transform(moved, rings_.total)
        return F.aggregate(each, zero, lambda s, t: F.struct(*[(s[c] + t[c]).alias(c) for c in ("a", "x", "y")]), lambda t: F.struct((t["a"] / 2).alias("area"), (origin["x"] + F.try_divide(t["x"], 3 * t["a"])).alias("x"), (origin["y"] + F.try_divide(t["y"], 3 * t["a"])).alias("y")))

    return _let(first, of)


def project(polygons: Column, source: int | str, target: int | str) -> Column:
    """Every vertex in another CRS."""
    return polygons if crs_.code(source) == crs_.code(target) else of_points(polygons, lambda x, y: crs_.reproject(x, y, source, target))


def simplified(polygons: Column, tolerance: float | None) -> Column:
    """Polygons with vertices dropped that lie within ``tolerance``; None leaves them."""
    if tolerance is None:
        return polygons

    @F.arrow_udf(POLYGONS)
    def run(column: pa.Array) -> pa.Array:
        return arrow([None if p is None else [[rings_.simplify_ring(r, tolerance).tolist() for r in rings_.points_of(rings)] for rings in p] for p in column.to_pylist()])

    return run(polygons)


def from_wkb(column: Column) -> Column:
    """Well-known binary of a Polygon or MultiPolygon; other types, empty and null ones give null."""

    @F.arrow_udf(POLYGONS)
    def run(raw: pa.Array) -> pa.Array:
        rows = [rings_.from_wkb(v.as_py()) or None for v in raw]
        return arrow([None if p is None else [[r.tolist() for r in rings] for rings in p if rings] or None for p in rows])

    return run(column)


def to_wkb(polygons: Column) -> Column:
    """A Polygon, or a MultiPolygon of several; null for null."""

    @F.arrow_udf("binary")
    def run(column: pa.Array) -> pa.Array:
        return pa.array([None if not p else rings_.as_wkb([rings_.points_of(r) for r in p])[1] for p in column.to_pylist()], pa.binary())

    return run(polygons)


def edges(polygons: Column) -> Column:
    """All edges, as structs of ax, ay, bx, by."""

    def of(ring: Column) -> Column:
        return F.zip_with(F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1), lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")))

    return F.flatten(F.transform(all_rings(polygons), of))


def holds_point(polygons: Column, x: Column, y: Column) -> Column:
    """Whether a point that isn't on an edge is inside: it sees an odd number of edges to its right."""

    def crosses(e: Column) -> Column:
        at = e["ax"] + (y - e["ay"]) / (e["by"] - e["ay"]) * (e["bx"] - e["ax"])
        return F.when((e["ay"] > y) != (e["by"] > y), at > x).otherwise(False)

    return F.size(F.filter(edges(polygons), crosses)) % 2 == 1


def _enters(e: Column, b: Box, closed: bool) -> Column:
    """Whether an edge meets a box: by its extents, and by the corners on both sides of its line."""
    below = (lambda p, q: p <= q) if closed else (lambda p, q: p < q)
    near = below(F.least(e["ax"], e["bx"]), b.x1) & below(b.x0, F.greatest(e["ax"], e["bx"])) & below(F.least(e["ay"], e["by"]), b.y1) & below(b.y0, F.greatest(e["ay"], e["by"]))
    side = [(e["bx"] - e["ax"]) * (y - e["ay"]) - (e["by"] - e["ay"]) * (x - e["ax"]) for x in (b.x0, b.x1) for y in (b.y0, b.y1)]
    return near & below(F.least(*side), F.lit(0.0)) & below(F.lit(0.0), F.greatest(*side))


def representative_point(polygons: Column) -> tuple[Column, Column]:
    """A point inside: of the first polygon the middle of the widest stretch inside at half its height."""
    first = F.slice(polygons, 1, 1)
    sides = bounds(first)

    def at_height(y: Column) -> Column:
        over = F.filter(edges(first), lambda e: (e["ay"] > y) != (e["by"] > y))
        xs = F.array_sort(F.transform(over, lambda e: e["ax"] + F.try_divide(y - e["ay"], e["by"] - e["ay"]) * (e["bx"] - e["ax"])))
        return _let(xs, lambda xs: _point(widest(xs), y))

    def widest(xs: Column) -> Column:
        pairs = F.filter(F.sequence(F.lit(0), F.greatest(F.size(xs) - 2, F.lit(0))), lambda i: i % 2 == 0)
        stretches = F.transform(pairs, lambda i: F.struct((F.get(xs, i + 1) - F.get(xs, i)).alias("w"), ((F.get(xs, i) + F.get(xs, i + 1)) / 2).alias("x")))
        return F.array_max(stretches)["x"]

    point = _let((sides["y0"] + sides["y1"]) / 2, at_height)
    return point["x"], point["y"]


def is_empty(polygons: Column) -> Column:
    """Null, or without a polygon that has a corner."""
    return F.coalesce(~F.exists(polygons, lambda p: F.exists(p, lambda r: F.size(r) > 0)), F.lit(True))


def meets_box(polygons: Column, b: Box) -> Column:
    """Closed: a common point is enough. Where no edge meets the box it is inside or outside as a whole."""
    return F.exists(edges(polygons), lambda e: _enters(e, b, True)) | holds_point(polygons, *b.centroid)


def predicate(name: str, polygons: Column, own: Box, b: Box) -> Column:
    """``polygons`` NAME box; ``own`` are the polygons' bounds. For boxes that have an area."""
    if name not in (*PREDICATES, "covers", "contains_properly"):
        raise ValueError(name)
    through = F.exists(edges(polygons), lambda e: _enters(e, b, False))
    inside = holds_point(polygons, *b.centroid)
    within = (own.x0 >= b.x0) & (own.x1 <= b.x1) & (own.y0 >= b.y0) & (own.y1 <= b.y1)
    return {
        "intersects": lambda: meets_box(polygons, b),
        "contains": lambda: ~through & inside,
        "covers": lambda: ~through & inside,
        "contains_properly": lambda: ~F.exists(edges(polygons), lambda e: _enters(e, b, True)) & inside,
        "within": lambda: within,
        "touches": lambda: meets_box(polygons, b) & ~through & ~inside,
        "crosses": lambda: F.lit(False),
        "overlaps": lambda: through & ~within,
    }[name]()


def _half(ring: Column, axis: str, bound: Column, keep_above: bool) -> Column:
    """An open ring's part on one side of a line along an axis (Sutherland and Hodgman's step)."""
    other = "y" if axis == "x" else "x"
    inside = (lambda p: p[axis] >= bound) if keep_above else (lambda p: p[axis] <= bound)

    def step(i: Column) -> Column:
        p, q = F.get(ring, i), F.get(ring, (i + 1) % F.size(ring))
        t = (bound - p[axis]) / (q[axis] - p[axis])
        at = {axis: bound, other: p[other] + t * (q[other] - p[other])}
        met = F.when(inside(p) != inside(q), F.array(_point(at["x"], at["y"]))).otherwise(F.array().cast("array<struct<x:double,y:double>>"))
        return F.concat(F.when(inside(p), F.array(_point(p["x"], p["y"]))).otherwise(F.array().cast("array<struct<x:double,y:double>>")), met)

    return F.when(F.size(ring) > 0, F.flatten(F.transform(F.sequence(F.lit(0), F.size(ring) - 1), step))).otherwise(ring)


def clip_to_box(polygons: Column, b: Box) -> Column:
    """The polygons' parts inside a box. Parts of one ring that the box separates stay one ring, joined along its side."""

    def ring(r: Column) -> Column:
        steps = [("x", b.x0, True), ("x", b.x1, False), ("y", b.y0, True), ("y", b.y1, False)]
        chain = lambda v, k: _let(v, lambda u: chain(_half(u, *steps[k]), k + 1)) if k < 4 else v
        cut = chain(F.slice(r, 1, F.greatest(F.size(r) - 1, F.lit(0))), 0)
        return _let(cut, lambda c: F.when(F.size(c) > 2, F.concat(c, F.slice(c, 1, 1))).otherwise(F.array().cast("array<struct<x:double,y:double>>")))

    cut = F.transform(polygons, lambda p: F.filter(F.transform(p, ring), lambda r: F.size(r) > 0))
    return F.filter(cut, lambda p: F.size(p) > 0)


class _Flat:
    """The edges of a batch of polygons: flat arrays, row bounds, and each edge's sign for the area below it."""

    def __init__(self, column: pa.Array):
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        n = len(column)
        polygons = column.flatten()
        rings = polygons.flatten()
        points = rings.flatten()
        x, y = (np.asarray(points.field(c)) for c in ("x", "y")) if len(points) else (np.zeros(0), np.zeros(0))
        sizes = lambda a: np.asarray(a.value_lengths().fill_null(0)) if len(a) else np.zeros(0, np.int64)
        of_polygon, of_ring, of_row = sizes(polygons), sizes(rings), sizes(column)
        row_of_polygon = np.repeat(np.arange(n), of_row)
        row_of_ring = np.repeat(row_of_polygon, of_polygon)
        is_shell = np.ones(len(rings), bool)
        is_shell[:] = np.arange(len(rings)) == np.repeat(np.cumsum(of_polygon) - of_polygon, of_polygon)
        ring = np.repeat(np.arange(len(rings)), of_ring)
        more = np.append(ring[1:] == ring[:-1], False) if len(ring) else np.zeros(0, bool)
        a = np.flatnonzero(more)
        self.ax, self.ay, self.bx, self.by = x[a], y[a], x[a + 1], y[a + 1]
        ring = ring[a]
        first = np.cumsum(of_ring) - of_ring
        ox, oy = (v[np.minimum(first, len(v) - 1)][ring] if len(v) else v for v in (x, y))
        twice = np.bincount(ring, (self.ax - ox) * (self.by - oy) - (self.bx - ox) * (self.ay - oy), len(rings))
        turn = np.sign(twice) * np.where(is_shell, 1, -1)
        self.sign = np.where(self.bx < self.ax, 1.0, -1.0) * turn[ring]
        self.at = np.searchsorted(row_of_ring[ring], np.arange(n + 1))
        self.area = np.bincount(row_of_ring, np.abs(twice) / 2 * np.where(is_shell, 1, -1), n)
        self.n = n

    def inside(self, row: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether each point is in its row's polygons."""
        size = np.diff(self.at)[row]
        edge = np.repeat(self.at[:-1][row], size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        which = np.repeat(np.arange(len(row)), size)
        px, py = x[which], y[which]
        ax, ay, bx, by = self.ax[edge], self.ay[edge], self.bx[edge], self.by[edge]
        over = (ay > py) != (by > py)
        at = ax + (py - ay) / np.where(over, by - ay, 1) * (bx - ax)
        return np.bincount(which[over & (at > px)], minlength=len(row)) % 2 == 1


#: So many boxes inside a feature's polygons stand for them where only pairs are looked for that surely share enough.
PARTS = 2
#: The strips of equal height from which these boxes are put together.
STRIPS = 4


def measured(polygons: Column) -> Column:
    """``measures`` and boxes inside the polygons that share no area: struct of area, x, y and p0_x0, p0_y0, p0_x1, p0_y1, p1_x0 and so on.

    Sums are taken in the order of ``measures``, so that both give the same. Boxes that aren't found have no width.
    """
    names = [f"p{k}_{c}" for k in range(PARTS) for c in ("x0", "y0", "x1", "y1")]

    @F.arrow_udf(", ".join(f"{c} double" for c in ("area", "x", "y", *names)))
    def run(column: pa.Array) -> pa.Array:
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        values = [*_sums(column), *[pa.array(v) for v in _inner_boxes(_Flat(column))]]
        return pa.StructArray.from_arrays(values, ["area", "x", "y", *names])

    return run(polygons)


def _sums(column: pa.Array) -> list[pa.Array]:
    """Area, x and y as ``measures`` has them."""
    n, polygons = len(column), column.flatten()
    rings = polygons.flatten()
    points = rings.flatten()
    x, y = (points.field(c).to_numpy(zero_copy_only=False) if len(points) else np.zeros(0) for c in ("x", "y"))
    of_row, of_polygon, of_ring = (np.asarray(a.value_lengths().fill_null(0), np.int64) if len(a) else np.zeros(0, np.int64) for a in (column, polygons, rings))
    row_of_polygon = np.repeat(np.arange(n), of_row)
    polygon_of_ring = np.repeat(np.arange(len(polygons)), of_polygon)
    row_of_ring = row_of_polygon[polygon_of_ring]
    ring = np.repeat(np.arange(len(rings)), of_ring)
    row = row_of_ring[ring]
    unknown = np.asarray(column.is_null())
    for rows, missing in ((row_of_polygon, polygons.is_null()), (row_of_ring, rings.is_null()), (row, points.is_null()), *((row, points.field(c).is_null()) for c in ("x", "y"))):
        unknown[rows[np.asarray(missing)]] = True
    unknown[row_of_ring[of_ring < 2]] = True
    # The first point is that of the first polygon's first ring.
    shell = (np.cumsum(of_row) - of_row)[of_row > 0]
    hollow = np.ones(n, bool)
    hollow[of_row > 0] = of_polygon[shell] == 0
    unknown[row[hollow[row]]] = True
    start = np.searchsorted(row, np.arange(n))
    ox, oy = (np.append(v, 0.0)[start] for v in (x, y))
    a = np.flatnonzero(ring[1:] == ring[:-1])
    px, py, qx, qy = x[a] - ox[row[a]], y[a] - oy[row[a]], x[a + 1] - ox[row[a]], y[a + 1] - oy[row[a]]
    cross = px * qy - qx * py
    sums = [np.bincount(ring[a], v, len(rings)) for v in (cross, (px + qx) * cross, (py + qy) * cross)]
    is_shell = np.arange(len(rings)) == (np.cumsum(of_polygon) - of_polygon)[polygon_of_ring]
    turn = np.where(is_shell, 1.0, -1.0) * np.sign(sums[0])
    sums = [np.bincount(row_of_polygon, np.bincount(polygon_of_ring, turn * v, len(polygons)), n) for v in sums]
    flat = sums[0] == 0
    thrice = np.where(flat, 1.0, 3 * sums[0])
    return [pa.array(sums[0] / 2, mask=unknown), *[pa.array(o + v / thrice, mask=unknown | flat) for o, v in ((ox, sums[1]), (oy, sums[2]))]]


def _inner_boxes(flat: _Flat) -> list[np.ndarray]:
    """Sides (x0, y0, x1, y1) of ``PARTS`` boxes for each row that lie inside of its polygons, above one another.

    In each of some strips the widest stretch that no edge enters and that is inside; stretches of neighbouring strips
    are put together to what they have in common, and the two boxes that hold the most are taken.
    """
    n, size = flat.n, np.diff(flat.at)
    row, some = np.repeat(np.arange(n), size), np.flatnonzero(size)
    low, high = np.minimum(flat.ay, flat.by), np.maximum(flat.ay, flat.by)
    y0, y1 = np.zeros(n), np.zeros(n)
    if len(some):
        y0[some], y1[some] = np.minimum.reduceat(low, flat.at[some]), np.maximum.reduceat(high, flat.at[some])
    y = [y0 + (y1 - y0) * (k / STRIPS) for k in range(STRIPS)] + [y1]
    left, right = ([np.zeros(n) for _ in range(STRIPS)] for _ in "lr")
    for k in range(STRIPS):
        e = np.flatnonzero((low < y[k + 1][row]) & (high > y[k][row]))
        if not len(e):
            continue
        ax, ay, bx, by = (v[e] for v in (flat.ax, flat.ay, flat.bx, flat.by))
        r = row[e]
        level = ay == by
        slope = (bx - ax) / np.where(level, 1, by - ay)
        ends = [np.where(level, end, np.clip(ax + (h - ay) * slope, np.minimum(ax, bx), np.maximum(ax, bx))) for end, h in ((ax, np.maximum(low[e], y[k][r])), (bx, np.minimum(high[e], y[k + 1][r])))]
        begin, end = np.minimum(*ends), np.maximum(*ends)
        middle = (y[k][r] + y[k + 1][r]) / 2
        over = (ay > middle) != (by > middle)
        order = np.lexsort((begin, r))
        r, begin, end, over = r[order], begin[order], end[order], np.cumsum(over[order])
        starts = np.flatnonzero(np.diff(r, prepend=-1))
        of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(r))))
        over -= np.where(starts > 0, over[starts - 1], 0)[of]
        reach = pd.Series(end).groupby(of).cummax().to_numpy()  # the right end of what has begun
        free = np.append(np.where(r[1:] == r[:-1], begin[1:] - reach[:-1], 0.0), 0.0) * (over % 2)
        widest = np.flatnonzero((free > 0) & (free == np.maximum.reduceat(free, starts)[of]))
        left[k][r[widest]], right[k][r[widest]] = reach[widest], begin[widest + 1]
    ranges = {}
    for i in range(STRIPS):
        l, r = left[i], right[i]
        for j in range(i + 1, STRIPS + 1):
            l, r = np.maximum(l, left[j - 1]), np.minimum(r, right[j - 1])
            ranges[i, j] = np.maximum(r - l, 0) * (y[j] - y[i]), l, y[i], np.maximum(l, r), y[j]
    best = [np.zeros(n)] + [np.zeros(n) for _ in range(4 * PARTS)]
    for s in range(1, STRIPS):
        halves = []
        for inside in ([v for (i, j), v in ranges.items() if j <= s], [v for (i, j), v in ranges.items() if i >= s]):
            pick = np.argmax([v[0] for v in inside], 0)[None]
            halves.append([np.take_along_axis(np.stack([v[c] for v in inside]), pick, 0)[0] for c in range(5)])
        more = halves[0][0] + halves[1][0] > best[0]
        best = [np.where(more, new, old) for new, old in zip([halves[0][0] + halves[1][0], *halves[0][1:], *halves[1][1:]], best, strict=True)]
    return best[1:]


def related(a: _Flat, b: _Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row: whether the two meet, whether their boundaries do, and the area that they share.

    The area below the lower one of two edges, summed over all pairs of edges with their signs, is the shared
    area: what lies below a polygon's edges adds up to the polygon.
    """
    shared, touching = np.zeros(a.n), np.zeros(a.n, bool)
    na, nb = np.diff(a.at), np.diff(b.at)
    pairs = np.cumsum(na * nb)
    start = 0
    while start < a.n:
        stop = max(start + 1, int(np.searchsorted(pairs, (pairs[start - 1] if start else 0) + AT_ONCE, "right")))
        rows = np.arange(start, stop)
        size = (na * nb)[rows]
        row = np.repeat(rows, size)
        k = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        i, j = a.at[row] + k // np.maximum(nb[row], 1), b.at[row] + k % np.maximum(nb[row], 1)
        p = [v[i] for v in (a.ax, a.ay, a.bx, a.by)]
        q = [v[j] for v in (b.ax, b.ay, b.bx, b.by)]
        low, high = np.maximum(np.minimum(p[0], p[2]), np.minimum(q[0], q[2])), np.minimum(np.maximum(p[0], p[2]), np.maximum(q[0], q[2]))
        live = np.flatnonzero(low < high)
        lo, hi = low[live], high[live]
        base = b.ay[b.at[row[live]]]  # any constant of a row will do; one nearby keeps digits

        def height(e, x, live=live, base=base):
            ax, ay, bx, by = (v[live] for v in e)
            return ay - base + (x - ax) / (bx - ax) * (by - ay)

        l1, r1, l2, r2 = height(p, lo), height(p, hi), height(q, lo), height(q, hi)
        d, e = l1 - l2, r1 - r2
        mixed = d * e < 0
        worst = np.minimum(d, e)
        under = np.where(mixed, -(worst**2) / np.where(mixed, 2 * (np.abs(d) + np.abs(e)), 1), np.minimum(d + e, 0) / 2)
        area = (hi - lo) * ((l2 + r2) / 2 + under) * a.sign[i[live]] * b.sign[j[live]]
        shared[start:stop] = np.bincount(row[live] - start, area, stop - start)
        # Segments meet if each one's ends are not on one side of the other, and their extents meet.
        side = lambda e, x, y: (e[2] - e[0]) * (y - e[1]) - (e[3] - e[1]) * (x - e[0])
        near = (low <= high) & (np.maximum(np.minimum(p[1], p[3]), np.minimum(q[1], q[3])) <= np.minimum(np.maximum(p[1], p[3]), np.maximum(q[1], q[3])))
        met = near & (side(p, q[0], q[1]) * side(p, q[2], q[3]) <= 0) & (side(q, p[0], p[1]) * side(q, p[2], p[3]) <= 0)
        touching[row[met]] = True
        start = stop
    apart = np.flatnonzero(~touching & (na > 0) & (nb > 0))
    inside = a.inside(apart, b.ax[b.at[apart]], b.ay[b.at[apart]]) | b.inside(apart, a.ax[a.at[apart]], a.ay[a.at[apart]])
    meet = touching.copy()
    meet[apart[inside]] = True
    return meet, touching, np.where(meet, np.maximum(shared, 0), 0)


def relation(a: Column, b: Column) -> Column:
    """Struct of meets, boundaries (whether they meet), shared, area_a and area_b of two columns of polygons."""

    @F.arrow_udf("meets boolean, boundaries boolean, shared double, area_a double, area_b double")
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        p, q = _Flat(x), _Flat(y)
        meets, boundaries, shared = related(p, q)
        return pa.StructArray.from_arrays([pa.array(v) for v in (meets, boundaries, shared, p.area, q.area)], ["meets", "boundaries", "shared", "area_a", "area_b"])

    return run(a, b)


def shared_area(a: Column, b: Column) -> Column:
    return relation(a, b)["shared"]


def any_shares(a: Column, b: Column, need: Column, likely: Column, of: Column) -> Column:
    """Whether pairs of polygons share more than ``need``, until a pair of the same ``of`` in a batch does; what is left of its
    pairs is false. Those with the largest ``likely`` are tested first, then twice as many each time."""

    @F.arrow_udf("boolean")
    def run(x: pa.Array, y: pa.Array, need: pa.Array, likely: pa.Array, of: pa.Array) -> pa.Array:
        x, y, need, likely, of = (v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v for v in (x, y, need, likely, of))
        need, likely = (np.asarray(v.fill_null(np.inf)) for v in (need, likely))
        code = np.asarray(of.dictionary_encode("encode").indices)
        order = np.lexsort((-likely, code))
        starts = np.flatnonzero(np.diff(code[order], prepend=-1))
        rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
        out, known = np.zeros(len(order), bool), np.zeros(len(order) + 1, bool)
        at, size = 0, 1
        while at <= rank.max(initial=-1):
            rows = order[(rank >= at) & (rank < at + size)]
            rows = rows[~known[code[rows]]]
            if len(rows):
                pick = pa.array(rows)
                hit = related(_Flat(x.take(pick)), _Flat(y.take(pick)))[2] > need[rows]
                out[rows[hit]] = known[code[rows[hit]]] = True
            at, size = at + size, at + size
        return pa.array(out)

    return run(a, b, need, likely, of)


def related_by(name: str, r: Column) -> Column:
    """a NAME b, from their ``relation``; for polygons that have an area."""
    common = r["shared"] > TOLERANCE * F.least(r["area_a"], r["area_b"])
    within, contains = (r["shared"] >= (1 - TOLERANCE) * r[c] for c in ("area_a", "area_b"))
    return {
        "intersects": lambda: r["meets"], "contains": lambda: r["meets"] & contains, "covers": lambda: r["meets"] & contains, "within": lambda: r["meets"] & within,
        "contains_properly": lambda: r["meets"] & contains & ~r["boundaries"], "touches": lambda: r["meets"] & ~common, "crosses": lambda: F.lit(False),
        "overlaps": lambda: common & ~contains & ~within,
    }[name]()


def of_box(b: Box) -> Column:
    """A box as polygons."""
    corners = [(b.x0, b.y0), (b.x1, b.y0), (b.x1, b.y1), (b.x0, b.y1), (b.x0, b.y0)]
    return F.array(F.array(F.array(*[_point(x, y) for x, y in corners])))


def slabs(flat: _Flat, x0: float, y0: float, x1: float, y1: float):
    """A box cut into trapezoids between the corners and crossings of some rows' edges: ((l, r, low, high), depth) each.

    Slabs between the x of all corners and crossings hold no crossing, so in each one the edges are in one order
    from below, and what lies between an edge and the next is inside the same rows as a whole. ``low`` and
    ``high`` are heights at l and r; ``depth`` tells how many rows' polygons hold the trapezoid.
    """
    up = flat.ax != flat.bx
    ax, ay, bx, by = (np.where(flat.ax < flat.bx, p, q)[up] for p, q in ((flat.ax, flat.bx), (flat.ay, flat.by), (flat.bx, flat.ax), (flat.by, flat.ay)))
    sign, row = flat.sign[up], np.repeat(np.arange(flat.n), np.diff(flat.at))[up]
    slope = (by - ay) / (bx - ax)
    xs = [ax, bx, np.array([x0, x1])]
    for k in range(len(ax)):  # where later edges cross this one
        other = np.flatnonzero((slope[k + 1 :] != slope[k]) & (ax[k + 1 :] < bx[k]) & (bx[k + 1 :] > ax[k])) + k + 1
        at = ax[k] + (ay[other] + slope[other] * (ax[k] - ax[other]) - ay[k]) / (slope[k] - slope[other])
        xs.append(at[(at > np.maximum(ax[k], ax[other])) & (at < np.minimum(bx[k], bx[other]))])
    xs = np.unique(np.clip(np.concatenate(xs), x0, x1))
    for left, right in zip(xs[:-1].tolist(), xs[1:].tolist(), strict=True):
        middle = (left + right) / 2
        here = np.flatnonzero((ax < middle) & (bx > middle))
        here = here[np.argsort(ay[here] + slope[here] * (middle - ax[here]), kind="stable")]
        heights = np.clip(np.stack([ay[here] + slope[here] * (x - ax[here]) for x in (left, right)], 1), y0, y1)
        bounds_ = np.concatenate([[[y0, y0]], heights, [[y1, y1]]])
        within = np.zeros(flat.n)
        for k in range(len(here) + 1):
            low, high = bounds_[k], bounds_[k + 1]
            if (high > low).any():
                yield (left, right, low, high), int(np.count_nonzero(within > 0.5))
            if k < len(here):
                within[row[here[k]]] -= sign[here[k]]


def trapezoid(left: float, right: float, low: np.ndarray, high: np.ndarray) -> list[list[tuple[float, float]]]:
    """As a polygon of one closed ring."""
    return [[(left, float(low[0])), (right, float(low[1])), (right, float(high[1])), (left, float(high[0])), (left, float(low[0]))]]


#: ``POLYGONS`` as Arrow's type; points may be given as pairs.
ARROW = pa.list_(pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))


def arrow(rows: list) -> pa.Array:
    return pa.array([None if p is None else [[[{"x": x, "y": y} for x, y in r] for r in rings] for rings in p] for p in rows], ARROW)


def common_parts(a: Column, b: Column) -> Column:
    """What two columns of polygons have in common, as trapezoids; points and lines that are common give none."""

    @F.arrow_udf(POLYGONS)
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        out = []
        for k in range(len(x)):
            pair = pa.chunked_array([x.slice(k, 1), y.slice(k, 1)]).combine_chunks()
            flat = _Flat(pair)
            xs, ys = np.append(flat.ax, flat.bx), np.append(flat.ay, flat.by)
            parts = [trapezoid(*t) for t, depth in slabs(flat, xs.min(), ys.min(), xs.max(), ys.max()) if depth == 2] if len(xs) else []
            out.append(parts)
        return arrow(out)

    return run(a, b)
