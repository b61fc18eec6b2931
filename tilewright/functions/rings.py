"""Polygons as arrays of rings, ``array<array<struct<x,y>>>``: the first is the shell, others are holes.

Area and centroid are column expressions. What needs a loop over vertices (clipping, simplifying, overlap of
two polygons) are Arrow-batched pandas UDFs. ``to_wkb`` and ``from_wkb`` convert to well-known binary.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

RINGS = "array<array<struct<x:double,y:double>>>"


def _sums(ring: Column) -> Column:
    """Struct of twice the signed area, and the sums for the centroid, of a closed ring."""

    def step(acc: Column, i: Column) -> Column:
        p, q = F.get(ring, i - 1), F.get(ring, i)
        cross = p["x"] * q["y"] - q["x"] * p["y"]
        return F.struct((acc["a"] + cross).alias("a"), (acc["x"] + (p["x"] + q["x"]) * cross).alias("x"), (acc["y"] + (p["y"] + q["y"]) * cross).alias("y"))

    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    return F.aggregate(F.sequence(F.lit(1), F.size(ring) - 1), zero, step)


def total(rings: Column) -> Column:
    """The sums over rings: the shell counts as positive and holes as negative, however they are turned."""
    each = F.transform(rings, lambda r, i: F.struct(_sums(r).alias("s"), F.when(i == 0, 1.0).otherwise(-1.0).alias("sign")))

    def step(acc: Column, e: Column) -> Column:
        k = e["sign"] * F.signum(e["s"]["a"])
        return F.struct(*[(acc[c] + k * e["s"][c]).alias(c) for c in ("a", "x", "y")])

    return F.aggregate(each, F.struct(*[F.lit(0.0).alias(c) for c in ("a", "x", "y")]), step)


def area(rings: Column) -> Column:
    return total(rings)["a"] / 2


def centroid(rings: Column) -> tuple[Column, Column]:
    t = total(rings)
    return F.try_divide(t["x"], 3 * t["a"]), F.try_divide(t["y"], 3 * t["a"])


def bounds(rings: Column) -> dict[str, Column]:
    shell = F.get(rings, 0)
    side = lambda f, c: f(F.transform(shell, lambda p: p[c]))
    return {"x0": side(F.array_min, "x"), "y0": side(F.array_min, "y"), "x1": side(F.array_max, "x"), "y1": side(F.array_max, "y")}


def to_wkb(rings: list[np.ndarray] | None) -> bytes | None:
    """A polygon as little-endian well-known binary."""
    if rings is None:
        return None
    body = b"".join(struct.pack("<I", len(r)) + np.asarray(r, "<f8").tobytes() for r in rings)
    return struct.pack("<BII", 1, 3, len(rings)) + body


def as_wkb(polygons: list[list[np.ndarray]]) -> tuple[str, bytes]:
    """The type's name and the well-known binary of one polygon, or of several as a MultiPolygon."""
    one = [to_wkb(p) for p in polygons]
    return ("Polygon", one[0]) if len(one) == 1 else ("MultiPolygon", struct.pack("<BII", 1, 6, len(one)) + b"".join(one))


def from_wkb(raw: bytes | None) -> list[list[np.ndarray]] | None:
    """The polygons of a Polygon or MultiPolygon, each a list of rings of (n, 2) points; other types give none.

    Further dimensions (Z, M) are left out, in ISO's numbering of types and in the one by flags.
    """
    if raw is None:
        return None
    at = 0

    def read(fmt: str):
        nonlocal at
        out = struct.unpack_from(fmt, raw, at)
        at += struct.calcsize(fmt)
        return out if len(out) > 1 else out[0]

    def geometry() -> list[list[np.ndarray]]:
        nonlocal at
        order = "<" if read("B") else ">"
        kind = read(order + "I")
        flags, kind = kind >> 28, kind & 0xFFFFFF
        if flags & 2:  # an SRID comes first
            read(order + "I")
        extra = kind // 1000 % 10
        wide = 2 + (flags >> 3 & 1) + (flags >> 2 & 1) + (0, 1, 1, 2)[extra & 3]
        kind %= 1000
        if kind == 6:
            return [p for _ in range(read(order + "I")) for p in geometry()]
        if kind != 3:
            return []
        rings = []
        for _ in range(read(order + "I")):
            n = read(order + "I")
            rings.append(np.frombuffer(raw, order + "f8", wide * n, at).reshape(n, wide)[:, :2].astype(float))
            at += 8 * wide * n
        return [rings]

    return geometry()


def points_of(rings) -> list[np.ndarray]:
    """Rows of a ``RINGS`` column to arrays of points."""
    return [np.array([(p["x"], p["y"]) for p in r], float).reshape(-1, 2) for r in rings]


def signed_area(p: np.ndarray) -> float:
    x, y = p[:, 0], p[:, 1]
    return 0.5 * float(np.dot(x, np.roll(y, -1)) - np.dot(np.roll(x, -1), y))


def clip_to_convex(p: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Sutherland-Hodgman: an open ring cut to a convex window given counter-clockwise."""
    out = p
    for a, b in zip(window, np.roll(window, -1, 0), strict=True):
        if not len(out):
            break
        side = (b[0] - a[0]) * (out[:, 1] - a[1]) - (b[1] - a[1]) * (out[:, 0] - a[0])
        nxt, after = np.roll(out, -1, 0), np.roll(side, -1)
        crossing = (side >= 0) != (after >= 0)
        t = np.where(crossing, side / np.where(crossing, side - after, 1), 0)[:, None]
        met = out + t * (nxt - out)
        both = np.stack([out, met], 1).reshape(-1, 2)
        out = both[np.stack([side >= 0, crossing], 1).ravel()]
    return out


def _open(p: np.ndarray) -> np.ndarray:
    return p[:-1] if len(p) > 1 and (p[0] == p[-1]).all() else p


def area_in_convex(rings: list[np.ndarray], window: np.ndarray) -> float:
    """Area that a polygon shares with a convex window."""
    parts = [abs(signed_area(c)) if len(c := clip_to_convex(_open(r), window)) > 2 else 0.0 for r in rings]
    return parts[0] - sum(parts[1:]) if parts else 0.0


def overlap_area(a: list[np.ndarray], b: list[np.ndarray]) -> float:
    """Area that two polygons share: signed fans of triangles from a common point, clipped pair by pair."""

    def fan(rings: list[np.ndarray]) -> list[tuple[float, np.ndarray]]:
        out = []
        for k, r in enumerate(rings):
            r = _open(r)
            turn = np.sign(signed_area(r)) * (1 if k == 0 else -1)
            for p, q in zip(r, np.roll(r, -1, 0), strict=True):
                t = np.array([origin, p, q])
                s = signed_area(t)
                if s:
                    out.append((turn * np.sign(s), t if s > 0 else t[::-1]))
        return out

    if not a or not b:
        return 0.0
    origin = a[0][0]
    total = 0.0
    others = fan(b)
    for s, t in fan(a):
        for u, v in others:
            c = clip_to_convex(t, v)
            if len(c) > 2:
                total += s * u * abs(signed_area(c))
    return total


def simplify_ring(p: np.ndarray, tolerance: float) -> np.ndarray:
    """Douglas-Peucker on a closed ring; a result of fewer than four points leaves the ring as it is."""
    keep = np.zeros(len(p), bool)
    keep[[0, -1]] = True
    stack = [(0, len(p) - 1)]
    while stack:
        i, j = stack.pop()
        if j - i < 2:
            continue
        a, d = p[i], p[j] - p[i]
        n = np.hypot(*d)
        v = p[i + 1 : j] - a
        away = np.abs(d[0] * v[:, 1] - d[1] * v[:, 0]) / n if n else np.hypot(v[:, 0], v[:, 1])
        k = int(away.argmax())
        if away[k] > tolerance:
            keep[i + 1 + k] = True
            stack += [(i, i + 1 + k), (i + 1 + k, j)]
    return p[keep] if keep.sum() >= 4 else p


def simplified(rings: Column, tolerance: float | None) -> Column:
    """Rings with vertices dropped that lie within ``tolerance``; None leaves them."""
    if tolerance is None:
        return rings

    @F.pandas_udf(RINGS)
    def run(column: pd.Series) -> pd.Series:
        return column.map(lambda rs: None if rs is None else [[{"x": x, "y": y} for x, y in simplify_ring(r, tolerance)] for r in points_of(rs)])

    return run(rings)


def shared_area(a: Column, b: Column) -> Column:
    """Area that two ``RINGS`` have in common."""

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([overlap_area(points_of(p), points_of(q)) for p, q in zip(x, y, strict=True)])

    return run(a, b)


def area_in_box(rings: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Area of ``RINGS`` inside a box."""

    @F.pandas_udf("double")
    def run(r: pd.Series, a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([area_in_convex(points_of(p), np.array([(s, t), (u, t), (u, v), (s, v)])) for p, s, t, u, v in zip(r, a, b, c, d, strict=True)])

    return run(rings, x0, y0, x1, y1)


def wkb_rings(column: Column) -> Column:
    """Well-known binary to an array of polygons (``RINGS`` each)."""

    @F.pandas_udf(f"array<{RINGS}>")
    def run(raw: pd.Series) -> pd.Series:
        return raw.map(lambda g: None if g is None else [[[{"x": x, "y": y} for x, y in r] for r in p] for p in from_wkb(bytes(g))])

    return run(column)


def geometry_type(wkb: Column) -> Column:
    """The type's name, from the header of well-known binary."""
    names = ("Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon", "GeometryCollection")
    little = F.substring(wkb, 1, 1) == F.lit(b"\x01")
    kind = F.conv(F.hex(F.when(little, F.substring(wkb, 2, 1)).otherwise(F.substring(wkb, 5, 1))), 16, 10).cast("int")
    return F.get(F.array(*map(F.lit, names)), kind - 1)
