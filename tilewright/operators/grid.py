"""Regular grids and tile grids: settings on the driver, lookups as column expressions.

A cell owns (low, high] in x and in y: a point on a common edge belongs to the western or southern cell,
and one on the grid's western or southern edge to none.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from numbers import Integral, Real

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import crs as crs_
from ..functions import polygons as polygons_
from ..functions.box import PREDICATES, Box, intersection, predicate, shares_area

#: Tile matrix sets: CRS, bounds, and columns and rows at level 0 (OGC 17-083r2).
_MERCATOR, _UPS = 20037508.342789244, 16440759.350252
TILE_MATRIX_SETS = {
    "WGS1984Quad": {"crs": 4326, "bounds": (-180.0, -90.0, 180.0, 90.0), "columns": 2, "rows": 1},
    "WorldCRS84Quad": {"crs": 4326, "bounds": (-180.0, -90.0, 180.0, 90.0), "columns": 2, "rows": 1},
    "WebMercatorQuad": {"crs": 3857, "bounds": (-_MERCATOR, -_MERCATOR, _MERCATOR, _MERCATOR), "columns": 1, "rows": 1},
    "WorldMercatorWGS84Quad": {"crs": 3395, "bounds": (-_MERCATOR, -_MERCATOR, _MERCATOR, _MERCATOR), "columns": 1, "rows": 1},
    "UPSArcticWGS84Quad": {"crs": 5041, "bounds": (2e6 - _UPS, 2e6 - _UPS, 2e6 + _UPS, 2e6 + _UPS), "columns": 1, "rows": 1},
    "UPSAntarcticWGS84Quad": {"crs": 5042, "bounds": (2e6 - _UPS, 2e6 - _UPS, 2e6 + _UPS, 2e6 + _UPS), "columns": 1, "rows": 1},
}
ROW, COLUMN = "grid_row_index", "grid_column_index"
HOWS = ("left", "right", "inner")


@dataclass(frozen=True)
class Grid:
    """``bounds`` (minx, miny, maxx, maxy) cut evenly into ``nrows`` x ``ncols`` cells with integer indices."""

    bounds: tuple[float, float, float, float]
    nrows: int
    ncols: int
    crs: int | str = 4326
    first_row_i: int = 0
    first_col_i: int = 0
    left_to_right: bool = True
    top_to_bottom: bool = True

    def __post_init__(self) -> None:
        if not isinstance(self.bounds, (list, tuple)) or len(self.bounds) != 4 or not all(isinstance(b, Real) for b in self.bounds):
            raise TypeError("bounds must be four numbers: minx, miny, maxx, maxy")
        for name in ("nrows", "ncols", "first_row_i", "first_col_i"):
            v = getattr(self, name)
            if not isinstance(v, Integral) or isinstance(v, bool):
                raise TypeError(f"{name} must be an integer")
        for name in ("left_to_right", "top_to_bottom"):
            if not isinstance(getattr(self, name), bool):
                raise TypeError(f"{name} must be a boolean")
        if self.nrows < 1 or self.ncols < 1:
            raise ValueError("nrows and ncols must be positive")
        if self.bounds[0] >= self.bounds[2] or self.bounds[1] >= self.bounds[3]:
            raise ValueError("bounds must have a positive width and height")
        crs_.code(self.crs)
        object.__setattr__(self, "bounds", tuple(map(float, self.bounds)))

    minx = property(lambda self: self.bounds[0])
    miny = property(lambda self: self.bounds[1])
    maxx = property(lambda self: self.bounds[2])
    maxy = property(lambda self: self.bounds[3])
    width = property(lambda self: self.maxx - self.minx)
    height = property(lambda self: self.maxy - self.miny)
    area = property(lambda self: self.width * self.height)
    cell_width = property(lambda self: self.width / self.ncols)
    cell_height = property(lambda self: self.height / self.nrows)
    cell_area = property(lambda self: self.cell_width * self.cell_height)
    ncells = property(lambda self: self.nrows * self.ncols)

    def with_size(self, width: float | None = None, height: float | None = None) -> Grid:
        """A grid of another size with the same minimum corner."""
        w, h = self.width if width is None else width, self.height if height is None else height
        if w <= 0 or h <= 0:
            raise ValueError("width and height must be positive")
        return replace(self, bounds=(self.minx, self.miny, self.minx + w, self.miny + h))

    @property
    def row_indices(self) -> list[int]:
        """Indices from south to north."""
        out = list(range(self.first_row_i, self.first_row_i + self.nrows))
        return out[::-1] if self.top_to_bottom else out

    @property
    def col_indices(self) -> list[int]:
        """Indices from west to east."""
        out = list(range(self.first_col_i, self.first_col_i + self.ncols))
        return out if self.left_to_right else out[::-1]

    @property
    def row_fences(self) -> list[float]:
        return [self.miny + self.height * k / self.nrows for k in range(self.nrows + 1)]

    @property
    def col_fences(self) -> list[float]:
        return [self.minx + self.width * k / self.ncols for k in range(self.ncols + 1)]

    def _named(self, kx: Column | None, ky: Column | None) -> tuple[Column | None, Column | None]:
        """Row and column index of a cell counted from the south-west."""
        row = None if ky is None else ((F.lit(self.first_row_i + self.nrows - 1) - ky) if self.top_to_bottom else ky + self.first_row_i).cast("long")
        col = None if kx is None else (kx + self.first_col_i if self.left_to_right else F.lit(self.first_col_i + self.ncols - 1) - kx).cast("long")
        return row, col

    def indices_from_xy(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Row and column of the owning cell; both null outside."""
        kx = F.ceil((x - self.minx) / self.cell_width) - 1
        ky = F.ceil((y - self.miny) / self.cell_height) - 1
        inside = kx.between(0, self.ncols - 1) & ky.between(0, self.nrows - 1)
        row, col = self._named(kx, ky)
        return F.when(inside, row), F.when(inside, col)

    def _strips(self, spark: SparkSession, n: int) -> DataFrame:
        return spark.range(n).withColumnRenamed("id", "k")

    def rows(self, spark: SparkSession) -> DataFrame:
        """One box for each row, from south to north."""
        k = F.col("k")
        return self._strips(spark, self.nrows).select(self._named(None, k)[0].alias(ROW), F.lit(self.minx).alias("x0"), (k * self.cell_height + self.miny).alias("y0"), F.lit(self.maxx).alias("x1"), ((k + 1) * self.cell_height + self.miny).alias("y1"))

    def cols(self, spark: SparkSession) -> DataFrame:
        """One box for each column, from west to east."""
        k = F.col("k")
        return self._strips(spark, self.ncols).select(self._named(k, None)[1].alias(COLUMN), (k * self.cell_width + self.minx).alias("x0"), F.lit(self.miny).alias("y0"), ((k + 1) * self.cell_width + self.minx).alias("x1"), F.lit(self.maxy).alias("y1"))

    def _box(self, kx: Column, ky: Column) -> dict[str, Column]:
        return {
            "x0": kx * self.cell_width + self.minx, "y0": ky * self.cell_height + self.miny,
            "x1": (kx + 1) * self.cell_width + self.minx, "y1": (ky + 1) * self.cell_height + self.miny,
        }

    def cells(self, spark: SparkSession) -> DataFrame:
        """All cells as boxes, row by row from the south."""
        n = F.lit(self.ncols).cast("long")
        kx, ky = F.col("k") % n, F.expr(f"k div {self.ncols}")
        row, col = self._named(kx, ky)
        return self._strips(spark, self.ncells).select(row.alias(ROW), col.alias(COLUMN), *[v.alias(k) for k, v in self._box(kx, ky).items()])

    def _check(self, how: str, name: str) -> None:
        if how not in HOWS:
            raise ValueError(f"how must be one of {HOWS}")
        if name not in PREDICATES:
            raise ValueError(f"predicate must be one of {PREDICATES}")

    def plot(self, ax=None, **how):
        """Draws the cells' sides with matplotlib, where that is installed; returns the axes. ``how`` goes to its line collections."""
        if ax is None:
            import matplotlib.pyplot as plt

            ax = plt.gca()
        ax.vlines(self.col_fences, self.miny, self.maxy, **how)
        ax.hlines(self.row_fences, self.minx, self.maxx, **how)
        return ax

    def sjoin_points(self, points: DataFrame, how: str = "left", x: str = "x", y: str = "y", crs: int | str | None = None, as_index: bool = False, as_tile: int | None = None) -> DataFrame:
        """Points with their cell. ``left`` and ``inner`` both keep points without a cell; ``right`` gives each
        cell, as a box, with the attributes of its points, and cells without points once. Options as for ``sjoin``."""
        self._check(how, "intersects")
        px, py = (F.col(x), F.col(y)) if crs is None else crs_.reproject(F.col(x), F.col(y), crs, self.crs)
        row, col = self.indices_from_xy(px, py)
        out = points.withColumns({ROW: row, COLUMN: col})
        if how == "right":
            out = self.cells(points.sparkSession).join(out.drop(x, y), [ROW, COLUMN], "left")
        return self._labelled(out, as_tile, as_index)

    def candidates(self, boxes: DataFrame) -> DataFrame:
        """Boxes once for each cell that they meet (closed), with the cell's place ``kx``, ``ky`` from the south-west.

        A range explode: no join, and no more rows than meeting pairs.
        """
        b = Box()
        spans = {}
        for k, (low, high, least, size, n) in {"kx": (b.x0, b.x1, self.minx, self.cell_width, self.ncols), "ky": (b.y0, b.y1, self.miny, self.cell_height, self.nrows)}.items():
            first = F.greatest(F.ceil((low - least) / size) - 1, F.lit(0)).cast("long")
            last = F.least(F.floor((high - least) / size), F.lit(n - 1)).cast("long")
            spans[k] = F.when(first <= last, F.sequence(first, last))
        return boxes.withColumn("kx", F.explode(spans["kx"])).withColumn("ky", F.explode(spans["ky"]))

    def _with_cells(self, features: DataFrame) -> DataFrame:
        """``candidates`` with the cell's box, cell_x0 and so on."""
        return self.candidates(features).withColumns({f"cell_{k}": v for k, v in self._box(F.col("kx"), F.col("ky")).items()})

    def meeting(self, features: DataFrame) -> DataFrame:
        """Features once for each cell that they meet (closed), with ``kx`` and ``ky``: boxes by their sides, polygons by their edges."""
        if not polygons_.is_polygons(features):
            return self.candidates(features)
        own, cell = Box(), Box("cell_")
        within = (own.x0 >= cell.x0) & (own.x1 <= cell.x1) & (own.y0 >= cell.y0) & (own.y1 <= cell.y1)
        return self._with_cells(features).where(within | polygons_.meets_box(F.col(polygons_.COLUMN), cell)).select(*features.columns, "kx", "ky")

    def _labelled(self, out: DataFrame, as_tile: int | None, as_index: bool) -> DataFrame:
        """Rows with their cell's tile of level ``as_tile`` instead of its indices, or with the indices as the first columns."""
        if as_tile is not None:
            from ..functions.paths import tile_text  # which needs this module

            z = F.lit(as_tile)
            text = F.when(F.col(ROW).isNotNull(), tile_text(F.col(COLUMN), F.col(ROW), z))
            return out.withColumns({"tile": text}).drop(ROW, COLUMN)
        return out.select(ROW, COLUMN, *[c for c in out.columns if c not in (ROW, COLUMN)]) if as_index else out

    def sjoin(self, features: DataFrame, how: str = "left", predicate_: str = "intersects", crs: int | str | None = None, as_index: bool = False, as_tile: int | None = None) -> DataFrame:
        """Features joined with cells by ``feature PREDICATE cell``.

        Features are boxes (x0, y0, x1, y1 and attributes) or, with a column ``polygons``, polygons with these bounds.
        ``left`` keeps features without a cell, with null indices; ``right`` gives cells as boxes, also those
        without a partner, with the attributes of the features. ``as_index``: the indices come first, as Spark has
        no index. ``as_tile``: the level whose tiles the cells are; a column ``tile`` replaces the indices.
        A ``crs`` other than the grid's moves the features' coordinates for the test.
        """
        self._check(how, predicate_)
        features = reprojected(features, crs, self.crs)
        row, col = self._named(F.col("kx"), F.col("ky"))
        shapes, attributes = ("x0", "y0", "x1", "y1", polygons_.COLUMN), [c for c in features.columns if c not in ("x0", "y0", "x1", "y1", polygons_.COLUMN)]
        exact = polygons_.is_polygons(features)
        test = polygons_.predicate(predicate_, F.col(polygons_.COLUMN), Box(), Box("cell_")) if exact else predicate(predicate_, Box(), Box("cell_"))
        pairs = self._with_cells(features).where(test).withColumns({ROW: row, COLUMN: col})
        if how == "right":
            return self._labelled(self.cells(features.sparkSession).join(pairs.select(*attributes, ROW, COLUMN), [ROW, COLUMN], "left"), as_tile, as_index)
        pairs = pairs.select(*attributes, *[c for c in shapes if c in features.columns], ROW, COLUMN).select(*features.columns, ROW, COLUMN)
        if how == "inner":
            return self._labelled(pairs, as_tile, as_index)
        # Those without a cell are found per row, from the same expressions, rather than by a second join.
        key = F.struct(*features.columns)
        if predicate_ == "intersects" and not exact:
            alone = features.where(~((F.col("x1") >= self.minx) & (F.col("x0") <= self.maxx) & (F.col("y1") >= self.miny) & (F.col("y0") <= self.maxy)))
        else:
            alone = features.withColumn("key_", F.xxhash64(key)).join(pairs.select(F.xxhash64(key).alias("key_")).distinct(), "key_", "left_anti").drop("key_")
        return self._labelled(pairs.unionByName(alone.withColumns({ROW: F.lit(None).cast("long"), COLUMN: F.lit(None).cast("long")})), as_tile, as_index)

    def overlay(self, features: DataFrame, how: str = "intersection", crs: int | str | None = None, as_index: bool = False, as_tile: int | None = None) -> DataFrame:
        """Features cut along the cells: a row for each part that has an area, with its cell's indices.

        Features are boxes, or polygons with a column ``polygons``, which is cut as well. ``identity`` adds the
        parts outside the grid, with null indices; ``union`` also what no feature covers of each cell, as rows
        whose attributes are null; ``symmetric_difference`` gives the latter and the parts outside.
        ``difference`` isn't implemented. What is left of a cell is a row with its bounds, ``area`` and the
        geometry itself: ``polygons`` of trapezoids between the features' corners. Other options as for ``sjoin``.
        """
        if how == "difference":
            raise NotImplementedError("difference")
        if how not in ("intersection", "union", "identity", "symmetric_difference"):
            raise ValueError(f"unknown overlay: {how}")
        self._check("left", "intersects")
        features = reprojected(features, crs, self.crs)
        exact, whole = polygons_.is_polygons(features), F.col(polygons_.COLUMN)
        pairs = self._with_cells(features).where(shares_area(Box(), Box("cell_")))
        row, col = self._named(F.col("kx"), F.col("ky"))
        sides = intersection(Box(), Box("cell_"))
        attributes = [c for c in features.columns if c not in (*sides, polygons_.COLUMN)]
        named = [*[F.col(c) for c in attributes], row.alias(ROW), col.alias(COLUMN)]
        if exact:
            inside = self._measured(pairs.select(*named, polygons_.clip_to_box(whole, Box("cell_")).alias(polygons_.COLUMN)))
        else:
            inside = pairs.select(*named, *[v.alias(k) for k, v in sides.items()]).withColumn("area", Box().area)
        if how == "intersection":
            return self._labelled(inside, as_tile, as_index)
        none = [F.lit(None).cast("long").alias(c) for c in (ROW, COLUMN)]
        if exact:
            beyond = features.select(*attributes, *none, F.explode(F.array(*[polygons_.clip_to_box(whole, b) for b in self._around()])).alias(polygons_.COLUMN))
            beyond = self._measured(beyond)
        else:
            beyond = self._beyond(features).select(*attributes, *none, "x0", "y0", "x1", "y1").withColumn("area", Box().area)
        if how == "identity":
            return self._labelled(inside.unionByName(beyond), as_tile, as_index)
        left = self.remainder(features.sparkSession, inside)
        left = left.select(*[F.lit(None).cast(features.schema[c].dataType).alias(c) for c in attributes], ROW, COLUMN, "x0", "y0", "x1", "y1", polygons_.COLUMN, "area")
        parts = beyond if how == "symmetric_difference" else inside.unionByName(beyond)
        if not exact:
            parts = parts.withColumn(polygons_.COLUMN, polygons_.of_box(Box()))
        return self._labelled(parts.unionByName(left), as_tile, as_index)

    @staticmethod
    def _measured(parts: DataFrame) -> DataFrame:
        """Parts that have an area, with it and their bounds."""
        out = parts.where(F.size(polygons_.COLUMN) > 0).withColumn("area", polygons_.measures(F.col(polygons_.COLUMN))["area"])
        return out.where("area > 0").withColumns(polygons_.bounds(F.col(polygons_.COLUMN)))

    def _around(self) -> list[Box]:
        """The plane around the grid as four boxes: west, east, and south and north between."""
        far = 1e300
        sides = [(-far, -far, self.minx, far), (self.maxx, -far, far, far), (self.minx, -far, self.maxx, self.miny), (self.minx, self.maxy, self.maxx, far)]
        return [LiteralBox(*s) for s in sides]

    def _beyond(self, boxes: DataFrame) -> DataFrame:
        """The parts of boxes outside the grid, as up to four boxes each: west, east, and south and north between."""
        b = Box()
        w, e = F.least(b.x1, F.lit(self.minx)), F.greatest(b.x0, F.lit(self.maxx))
        x0, x1 = F.greatest(b.x0, F.lit(self.minx)), F.least(b.x1, F.lit(self.maxx))
        parts = [(b.x0, b.y0, w, b.y1), (e, b.y0, b.x1, b.y1), (x0, b.y0, x1, F.least(b.y1, F.lit(self.miny))), (x0, F.greatest(b.y0, F.lit(self.maxy)), x1, b.y1)]
        four = F.array(*[F.struct(*[v.alias(n) for n, v in zip(("x0", "y0", "x1", "y1"), p, strict=True)]) for p in parts])
        out = boxes.withColumn("part", F.explode(F.filter(four, lambda p: (p["x0"] < p["x1"]) & (p["y0"] < p["y1"]))))
        return out.withColumns({k: F.col(f"part.{k}") for k in ("x0", "y0", "x1", "y1")}).drop("part")

    def remainder(self, spark: SparkSession, parts: DataFrame) -> DataFrame:
        """Each cell that ``parts`` (of ``overlay``) doesn't cover: its indices, box, the ``area`` that is left, and its ``polygons``.

        A cell's parts meet in one task; equal boxes count once before they are sent.
        """
        cells = self.cells(spark)
        if not polygons_.is_polygons(parts):
            parts = parts.select(ROW, COLUMN, "x0", "y0", "x1", "y1").distinct().withColumn(polygons_.COLUMN, polygons_.of_box(Box()))
        held = parts.select(ROW, COLUMN, polygons_.COLUMN).join(cells, [ROW, COLUMN])
        cut = held.groupBy(ROW, COLUMN).applyInArrow(_uncovered, f"{ROW} long, {COLUMN} long, covered double, {polygons_.COLUMN} {polygons_.POLYGONS}")
        out = cells.join(cut, [ROW, COLUMN], "left")
        untouched = F.col("covered").isNull()
        out = out.withColumn("area", F.lit(self.cell_area) - F.coalesce("covered", F.lit(0.0))).where(F.col("area") > 1e-12 * self.cell_area)
        return out.withColumn(polygons_.COLUMN, F.when(untouched, polygons_.of_box(Box())).otherwise(F.col(polygons_.COLUMN))).drop("covered")


@dataclass(frozen=True)
class LiteralBox(Box):
    """A box with fixed sides."""

    def __init__(self, *sides: float):
        object.__setattr__(self, "prefix", "")
        object.__setattr__(self, "sides", dict(zip(("x0", "y0", "x1", "y1"), map(float, sides), strict=True)))

    def __getattr__(self, side: str) -> Column:
        if side not in ("x0", "y0", "x1", "y1"):
            raise AttributeError(side)
        return F.lit(self.sides[side])


def reprojected(features: DataFrame, source: int | str | None, target: int | str) -> DataFrame:
    """Features in another CRS: polygons vertex by vertex, boxes by their corners. None, and equal codes, leave them."""
    if source is None or crs_.code(source) == crs_.code(target):
        return features
    if polygons_.is_polygons(features):
        moved = features.withColumn(polygons_.COLUMN, polygons_.project(F.col(polygons_.COLUMN), source, target))
        return moved.withColumns(polygons_.bounds(F.col(polygons_.COLUMN)))
    corners = [crs_.reproject(F.col(x), F.col(y), source, target) for x in ("x0", "x1") for y in ("y0", "y1")]
    xs, ys = zip(*corners, strict=True)
    return features.withColumns({"x0": F.least(*xs), "y0": F.least(*ys), "x1": F.greatest(*xs), "y1": F.greatest(*ys)})


def _uncovered(group):
    """Of one cell: the area that some polygons cover, and what is left of it as trapezoids."""
    import pyarrow as pa

    sides = [group.column(c)[0].as_py() for c in ("x0", "y0", "x1", "y1")]
    covered, left = 0.0, []
    for (a, b, low, high), depth in polygons_.slabs(polygons_._Flat(group.column(polygons_.COLUMN)), *sides):
        if depth:
            covered += (b - a) * float((high - low).sum()) / 2
        else:
            left.append(polygons_.trapezoid(a, b, low, high))
    return pa.table({ROW: group.column(ROW).slice(0, 1), COLUMN: group.column(COLUMN).slice(0, 1), "covered": pa.array([covered]), polygons_.COLUMN: polygons_.arrow([left])})


EPSILON = 1e-11


def level_of(tms_id: str, z: int) -> Grid:
    """The whole grid of a level: tiles counted from the north-west."""
    if tms_id not in TILE_MATRIX_SETS:
        raise ValueError(f"{tms_id} is not a valid tms_id")
    t = TILE_MATRIX_SETS[tms_id]
    return Grid(t["bounds"], t["rows"] << z, t["columns"] << z, t["crs"])


def tms_grids(tms_id: str, z: int, bounds: tuple[float, float, float, float] | None = None) -> list[Grid]:
    """The tiles of a level that cover ``bounds``, snapped outward; a bound on a tile's edge adds no neighbour.

    Bounds are clamped to the set's. With west > east they cross the antimeridian, and there are two grids.
    """
    whole = level_of(tms_id, z)
    if bounds is None:
        return [whole]
    west, south, east, north = map(float, bounds)
    if west > east:
        return [*tms_grids(tms_id, z, (west, south, whole.maxx, north)), *tms_grids(tms_id, z, (whole.minx, south, east, north))]
    place = lambda v, low, size, n: min(max(math.floor((v - low) / size), 0), n - 1)
    x0, x1 = (place(v, whole.minx, whole.cell_width, whole.ncols) for v in (max(west, whole.minx) + EPSILON, min(east, whole.maxx) - EPSILON))
    k0, k1 = (place(v, whole.miny, whole.cell_height, whole.nrows) for v in (max(south, whole.miny) + EPSILON, min(north, whole.maxy) - EPSILON))
    x1, k1 = max(x0, x1), max(k0, k1)
    snapped = (whole.minx + x0 * whole.cell_width, whole.miny + k0 * whole.cell_height, whole.minx + (x1 + 1) * whole.cell_width, whole.miny + (k1 + 1) * whole.cell_height)
    return [Grid(snapped, k1 - k0 + 1, x1 - x0 + 1, whole.crs, whole.nrows - 1 - k1, x0)]


def tile_bounds(tms_id: str, x: Column, y: Column, z: Column) -> dict[str, Column]:
    """top, right, bottom and left of tiles, in the set's CRS."""
    t = TILE_MATRIX_SETS[tms_id]
    minx, miny, maxx, maxy = t["bounds"]
    w = (maxx - minx) / t["columns"] / F.pow(F.lit(2.0), z)
    h = (maxy - miny) / t["rows"] / F.pow(F.lit(2.0), z)
    return {"top": maxy - y * h, "right": minx + (x + 1) * w, "bottom": maxy - (y + 1) * h, "left": minx + x * w}


def parent(x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """Of level 0 there is none."""
    up = lambda v: F.when(z > 0, F.shiftright(v, 1))
    return up(x), up(y), F.when(z > 0, z - 1)


def children(x: Column, y: Column, z: Column) -> Column:
    """The four tiles one level down: west before east, north before south."""
    return F.array(*[F.struct((x * 2 + a).alias("x"), (y * 2 + b).alias("y"), (z + 1).alias("z")) for a in (0, 1) for b in (0, 1)])
