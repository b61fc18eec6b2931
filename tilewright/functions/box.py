"""Axis-aligned boxes as four double columns: measures and predicates in closed form.

A box is named by a prefix: ``Box("a.")`` reads a.x0, a.y0, a.x1 and a.y1.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What ``Grid.sjoin`` accepts, and what a boundary clip accepts.
PREDICATES = ("intersects", "contains", "within", "touches", "crosses", "overlaps")
CLIP_PREDICATES = ("contains", "contains_properly", "covers", "crosses", "intersects", "overlaps", "touches", "within")


@dataclass(frozen=True)
class Box:
    prefix: str = ""

    def __getattr__(self, side: str) -> Column:
        if side not in ("x0", "y0", "x1", "y1"):
            raise AttributeError(side)
        return F.col(f"{self.prefix}{side}")

    @property
    def width(self) -> Column:
        return self.x1 - self.x0

    @property
    def height(self) -> Column:
        return self.y1 - self.y0

    @property
    def area(self) -> Column:
        return self.width * self.height

    @property
    def centroid(self) -> tuple[Column, Column]:
        return (self.x0 + self.x1) / 2, (self.y0 + self.y1) / 2


def meets(a: Box, b: Box) -> Column:
    """Closed: common edges and corners count."""
    return (a.x0 <= b.x1) & (b.x0 <= a.x1) & (a.y0 <= b.y1) & (b.y0 <= a.y1)


def shares_area(a: Box, b: Box) -> Column:
    return (a.x0 < b.x1) & (b.x0 < a.x1) & (a.y0 < b.y1) & (b.y0 < a.y1)


def covers(a: Box, b: Box) -> Column:
    return (a.x0 <= b.x0) & (a.x1 >= b.x1) & (a.y0 <= b.y0) & (a.y1 >= b.y1)


def intersection(a: Box, b: Box) -> dict[str, Column]:
    """The four sides of what two boxes have in common; meaningful where they meet."""
    return {"x0": F.greatest(a.x0, b.x0), "y0": F.greatest(a.y0, b.y0), "x1": F.least(a.x1, b.x1), "y1": F.least(a.y1, b.y1)}


def intersection_area(a: Box, b: Box) -> Column:
    c = intersection(a, b)
    return F.greatest(c["x1"] - c["x0"], F.lit(0.0)) * F.greatest(c["y1"] - c["y0"], F.lit(0.0))


def predicate(name: str, a: Box, b: Box) -> Column:
    """``a`` NAME ``b`` for boxes that have an area.

    Two areas never cross. contains_properly: no point of b is on a's boundary.
    """
    return {
        "intersects": lambda: meets(a, b),
        "contains": lambda: covers(a, b),
        "covers": lambda: covers(a, b),
        "contains_properly": lambda: (a.x0 < b.x0) & (a.x1 > b.x1) & (a.y0 < b.y0) & (a.y1 > b.y1),
        "within": lambda: covers(b, a),
        "touches": lambda: meets(a, b) & ~shares_area(a, b),
        "crosses": lambda: F.lit(False),
        "overlaps": lambda: shares_area(a, b) & ~covers(a, b) & ~covers(b, a),
    }[name]()
