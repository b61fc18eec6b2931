"""Queries of the core operators on derived features, each with the SQL that gives the same rows.

The SQL is written from the definitions: joins by plain inequalities, no bins, no range explode.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures
from .functions import crs, paths, polygons, registry, rings
from .functions.box import PREDICATES, Box
from .operators import cells, checks, dedup
from .operators.grid import COLUMN, ROW, Grid, children, level_of, parent, tile_bounds
from .plans import hex_runs, prep, staging

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

Z = 5
SPAN = 180 / 2**Z
FEAT, PTS, LAND, FOOT = (f"({fixtures.duck(n)})" for n in ("feat", "pts", "land", "footprint"))
GRID = Grid((-120, -60, 100, 60), 12, 22, first_row_i=3, first_col_i=5)
CONFIG = staging.StagingConfig(z=Z)


def query(sql: str | None = None):
    """Registers a function of (spark, sf_dir) under its name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _feat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.load(spark, sf_dir, "feat")


# Grids and tiles.

_CELLS = f"""(select cast({GRID.first_row_i + GRID.nrows - 1} - ky as bigint) as {ROW}, cast(kx + {GRID.first_col_i} as bigint) as {COLUMN}, kx * {GRID.cell_width}::double + {GRID.minx} as x0,
ky * {GRID.cell_height}::double + {GRID.miny} as y0, (kx + 1) * {GRID.cell_width}::double + {GRID.minx} as x1, (ky + 1) * {GRID.cell_height}::double + {GRID.miny} as y1
from (select unnest(range({GRID.nrows})) as ky) r, (select unnest(range({GRID.ncols})) as kx) c)"""


@query(f"select fid, filename, price, x0, x1, y0, y1, cx, cy, area, geom_type from {FEAT}")
def feature_boxes(spark, sf_dir):
    return _feat(spark, sf_dir).drop("dt")


@query(f"select * from {_CELLS}")
def grid_cells(spark, sf_dir):
    return GRID.cells(spark)


@query(f"select {ROW}, cast({GRID.minx} as double) as x0, y0, cast({GRID.maxx} as double) as x1, y1 from {_CELLS} where {COLUMN} = {GRID.first_col_i}")
def grid_rows(spark, sf_dir):
    return GRID.rows(spark)


@query(f"select {COLUMN}, x0, cast({GRID.miny} as double) as y0, x1, cast({GRID.maxy} as double) as y1 from {_CELLS} where {ROW} = {GRID.first_row_i}")
def grid_cols(spark, sf_dir):
    return GRID.cols(spark)


_OWNER = "p.x > c.x0 and p.x <= c.x1 and p.y > c.y0 and p.y <= c.y1"


@query(f"select p.*, c.{ROW}, c.{COLUMN} from {PTS} p left join {_CELLS} c on {_OWNER}")
def grid_point_index(spark, sf_dir):
    return GRID.sjoin_points(fixtures.load(spark, sf_dir, "pts"))


@query(f"select c.*, p.fid, p.user_id, p.event_type, p.value from {_CELLS} c left join {PTS} p on {_OWNER}")
def grid_point_right_join(spark, sf_dir):
    return GRID.sjoin_points(fixtures.load(spark, sf_dir, "pts"), "right")


_TILE = "case when {c} between 0 and 63 and {r} between 0 and 31 then 'Tile(x=' || {c} || ', y=' || {r} || ', z=5)' end"
_COL, _ROW = f"cast(ceil((x + 180) / {SPAN}) - 1 as bigint)", f"cast(floor((90 - y) / {SPAN}) as bigint)"


@query(f"select fid, {_TILE.format(c=_COL, r=_ROW)} as tile from {PTS}")
def tile_from_xy(spark, sf_dir):
    row, col = level_of("WGS1984Quad", Z).indices_from_xy(F.col("x"), F.col("y"))
    return fixtures.load(spark, sf_dir, "pts").select("fid", paths.tile_text(col, row, F.lit(Z)).alias("tile"))


_TILES = f"(select distinct {_COL} as x, {_ROW} as y, 5 as z from {PTS} where x > -180 and y > -90)"


def _tiles(spark, sf_dir) -> DataFrame:
    row, col = level_of("WGS1984Quad", Z).indices_from_xy(F.col("x"), F.col("y"))
    return fixtures.load(spark, sf_dir, "pts").select(col.alias("x"), row.alias("y"), F.lit(Z).alias("z")).where("x is not null").distinct()


@query(f"select x, y, z, cast(90 - y * 180 / pow(2, z) as double) as top, cast(-180 + (x + 1) * 180 / pow(2, z) as double) as \"right\", cast(90 - (y + 1) * 180 / pow(2, z) as double) as bottom, cast(-180 + x * 180 / pow(2, z) as double) as \"left\" from {_TILES}")
def tile_bbox(spark, sf_dir):
    return _tiles(spark, sf_dir).select("x", "y", "z", *[v.alias(k) for k, v in tile_bounds("WGS1984Quad", F.col("x"), F.col("y"), F.col("z")).items()])


@query(f"select x, y, z, x // 2 as px, y // 2 as py, z - 1 as pz from {_TILES}")
def tile_parent(spark, sf_dir):
    return _tiles(spark, sf_dir).select("x", "y", "z", *[v.alias(k) for k, v in zip(("px", "py", "pz"), parent(F.col("x"), F.col("y"), F.col("z")), strict=True)])


@query(f"select x, y, z, 2 * x + a as cx, 2 * y + b as cy, z + 1 as cz from {_TILES}, (values (0), (1)) p(a), (values (0), (1)) q(b)")
def tile_children(spark, sf_dir):
    t = _tiles(spark, sf_dir).withColumn("c", F.explode(children(F.col("x"), F.col("y"), F.col("z"))))
    return t.select("x", "y", "z", F.col("c.x").alias("cx"), F.col("c.y").alias("cy"), F.col("c.z").alias("cz"))


# Staging.

_LEVEL = f"(select tx, ty, -180 + tx * {SPAN}::double as x0, -180 + (tx + 1) * {SPAN}::double as x1, 90 - (ty + 1) * {SPAN}::double as y0, 90 - ty * {SPAN}::double as y1 from (select unnest(range(64)) as tx) a, (select unnest(range(32)) as ty) b)"
_MEET = "f.x0 <= t.x1 and t.x0 <= f.x1 and f.y0 <= t.y1 and t.y0 <= f.y1"
_NAME = "'Tile(x=' || tx || ', y=' || ty || ', z=5)'"
_CENTRE = _TILE.format(c=f"cast(ceil((cx + 180) / {SPAN}) - 1 as bigint)", r=f"cast(floor((90 - cy) / {SPAN}) as bigint)")
# The grid is snapped to the tiles around the data: a touch beyond it doesn't count.
_SNAPPED = f"""(select t.* from {_LEVEL} t, (select min(x0) as a, max(x1) as b, min(y0) as c, max(y1) as d from {FEAT} where geom_type in ('Polygon', 'MultiPolygon')) e
where t.x1 > e.a + 1e-11 and t.x0 <= e.b - 1e-11 and t.y1 > e.c + 1e-11 and t.y0 <= e.d - 1e-11)"""
_STAGED = f"""(select f.fid, f.filename as staging_filename, f.price, f.x0, f.x1, f.y0, f.y1, f.cx, f.cy, f.area as staging_area, (f.x0 + f.x1) / 2 as staging_centroid_x, (f.y0 + f.y1) / 2 as staging_centroid_y,
{_CENTRE} as staging_centroid_tile, t.tx as tile_x, t.ty as tile_y, 5 as tile_z, {_NAME} as staging_tile, coalesce({_NAME} = {_CENTRE}, false) as staging_centroid_within_tile,
t.y1 as tile_top, t.x1 as tile_right, t.y0 as tile_bottom, t.x0 as tile_left from {FEAT} f join {_SNAPPED} t on {_MEET} where f.geom_type in ('Polygon', 'MultiPolygon'))"""


def _staged(spark, sf_dir) -> DataFrame:
    feat = _feat(spark, sf_dir).drop("dt", "area")
    return staging.stage(feat, CONFIG, F.col("filename"), identifier=F.col("fid").cast("string"))


@query(f"select f.fid, t.tx as tile_x, t.ty as tile_y, 5 as tile_z, {_NAME} as tile from {FEAT} f join {_LEVEL} t on {_MEET}")
def assign_tiles(spark, sf_dir):
    return staging.assign_tiles(_feat(spark, sf_dir).select("fid", "x0", "x1", "y0", "y1"), level_of("WGS1984Quad", Z), Z).drop("x0", "x1", "y0", "y1")


_STAGED_COLS = ["fid", "staging_filename", "price", "staging_area", "staging_centroid_x", "staging_centroid_y", "staging_centroid_tile", "staging_tile", "staging_centroid_within_tile"]


@query(f"select {', '.join(_STAGED_COLS)} from {_STAGED}")
def staged_features(spark, sf_dir):
    return _staged(spark, sf_dir).select(*_STAGED_COLS)


@query(f"""select staging_filename as filename, count(*) as num_polygons, sum(staging_area) as area_polygons, tile_x, tile_y, tile_z, tile_top, tile_right, tile_bottom, tile_left, 'WGS1984Quad' as tms_identifier
from {_STAGED} group by all""")
def staging_summary(spark, sf_dir):
    return staging.summarise(_staged(spark, sf_dir), CONFIG)


@query(f"select min(x0) as minx, min(y0) as miny, max(x1) as maxx, max(y1) as maxy from {FEAT}")
def total_bounds(spark, sf_dir):
    return staging.total_bounds(_feat(spark, sf_dir))


@query(f"select tx // 2 as x, ty // 2 as y, 4 as z, count(*) as n from (select distinct tx, ty from {FEAT} f join {_LEVEL} t on {_MEET}) group by all")
def tile_pyramid_counts(spark, sf_dir):
    tiles = staging.assign_tiles(_feat(spark, sf_dir).select("x0", "x1", "y0", "y1"), level_of("WGS1984Quad", Z), Z).select("tile_x", "tile_y").distinct()
    x, y, z = parent(F.col("tile_x"), F.col("tile_y"), F.lit(Z))
    return tiles.groupBy(x.alias("x"), y.alias("y"), z.alias("z")).agg(F.count("*").alias("n"))


@query(f"select fid, geom_type from {FEAT} where geom_type in ('Polygon', 'MultiPolygon')")
def type_filter(spark, sf_dir):
    return staging.only_polygons(_feat(spark, sf_dir)).select("fid", "geom_type")


_COVERS = "{a}.x0 <= {b}.x0 and {a}.x1 >= {b}.x1 and {a}.y0 <= {b}.y0 and {a}.y1 >= {b}.y1"
_AREA = "f.x0 < t.x1 and t.x0 < f.x1 and f.y0 < t.y1 and t.y0 < f.y1"
_OF_PREDICATE = {
    "intersects": _MEET, "contains": _COVERS.format(a="f", b="t"), "within": _COVERS.format(a="t", b="f"), "touches": f"{_MEET} and not ({_AREA})", "crosses": "false",
    "overlaps": f"{_AREA} and not ({_COVERS.format(a='f', b='t')}) and not ({_COVERS.format(a='t', b='f')})",
}


def _sjoin(name: str, how: str) -> None:
    columns = f"f.fid, t.{ROW}, t.{COLUMN}" if how != "right" else f"t.{ROW}, t.{COLUMN}, t.x0, t.y0, t.x1, t.y1, f.fid"
    sql = f"select {columns} from {FEAT} f {how} join {_CELLS} t on {_OF_PREDICATE[name]}"

    def run(spark, sf_dir):
        out = GRID.sjoin(_feat(spark, sf_dir).select("fid", "x0", "x1", "y0", "y1"), how, name)
        return out if how == "right" else out.select("fid", ROW, COLUMN)

    run.__name__ = f"grid_sjoin_{name}" if how == "left" else f"grid_sjoin_{name}_{how}"
    query(sql)(run)


for _p in PREDICATES:
    _sjoin(_p, "left")
_sjoin("intersects", "inner")
_sjoin("intersects", "right")

_PART = f"""(select f.fid, t.{ROW}, t.{COLUMN}, greatest(f.x0, t.x0) as x0, greatest(f.y0, t.y0) as y0, least(f.x1, t.x1) as x1, least(f.y1, t.y1) as y1 from {FEAT} f join {_CELLS} t on {_AREA})"""


@query(f"select *, (x1 - x0) * (y1 - y0) as area from {_PART}")
def grid_overlay(spark, sf_dir):
    return GRID.overlay(_feat(spark, sf_dir).select("fid", "x0", "x1", "y0", "y1"))


def _inside(x: str) -> str:
    return f"greatest(least({x}x1, {GRID.maxx}) - greatest({x}x0, {GRID.minx}), 0) * greatest(least({x}y1, {GRID.maxy}) - greatest({x}y0, {GRID.miny}), 0)"


@query(f"select fid, area, area - {_inside('')} as outside from {FEAT}")
def grid_overlay_identity(spark, sf_dir):
    """The parts' areas by feature: all of it, and what lies outside the grid."""
    out = GRID.overlay(_feat(spark, sf_dir).select("fid", "x0", "x1", "y0", "y1"), "identity")
    return out.groupBy("fid").agg(F.sum("area").alias("area"), F.sum(F.when(F.col(ROW).isNull(), F.col("area")).otherwise(0.0)).alias("outside"))



# What lies outside the grid, as boxes, and what is left of each cell between the sides of all that meets it.
_SIDES = {"w": ("x0", "y0", "{minx}", "y1"), "e": ("{maxx}", "y0", "x1", "y1"), "s": ("{minx}", "y0", "{maxx}", "{miny}"), "n": ("{minx}", "{maxy}", "{maxx}", "y1")}


def _outside() -> str:
    grid = {k: f"{getattr(GRID, k)}::double" for k in ("minx", "miny", "maxx", "maxy")}
    parts = []
    for a, b, c, d in ([v.format(**grid) for v in side] for side in _SIDES.values()):
        parts.append(f"select fid, (least(x1, {c}) - greatest(x0, {a})) * (least(y1, {d}) - greatest(y0, {b})) as area from {FEAT} where least(x1, {c}) > greatest(x0, {a}) and least(y1, {d}) > greatest(y0, {b})")
    return f"select fid, cast(null as bigint) as {ROW}, cast(null as bigint) as {COLUMN}, area from ({' union all '.join(parts)})"


_LEFT = f"""xs as (select {ROW}, {COLUMN}, x, lead(x) over (partition by {ROW}, {COLUMN} order by x) as nx from (select {ROW}, {COLUMN}, x0 as x from p union select {ROW}, {COLUMN}, x1 from p)),
ys as (select {ROW}, {COLUMN}, y, lead(y) over (partition by {ROW}, {COLUMN} order by y) as ny from (select {ROW}, {COLUMN}, y0 as y from p union select {ROW}, {COLUMN}, y1 from p)),
slab as (select xs.*, p.y0, p.y1 from xs join p on p.{ROW} = xs.{ROW} and p.{COLUMN} = xs.{COLUMN} and p.x0 <= x and p.x1 >= nx),
held as (select distinct slab.{ROW}, slab.{COLUMN}, x, nx, y, ny from slab join ys on ys.{ROW} = slab.{ROW} and ys.{COLUMN} = slab.{COLUMN} and slab.y0 <= y and slab.y1 >= ny),
sums as (select {ROW}, {COLUMN}, sum((nx - x) * (ny - y)) as held from held group by all)"""
_REST = f"select cast(null as bigint) as fid, {ROW}, {COLUMN}, {GRID.cell_area}::double - coalesce(held, 0) as area from {_CELLS} c left join sums using ({ROW}, {COLUMN}) where {GRID.cell_area}::double - coalesce(held, 0) > {1e-12 * GRID.cell_area}"


@query(f"with p as (select * from {_PART}), {_LEFT} select fid, {ROW}, {COLUMN}, (x1 - x0) * (y1 - y0) as area from p union all {_outside()} union all {_REST}")
def grid_overlay_union(spark, sf_dir):
    return GRID.overlay(_feat(spark, sf_dir).select("fid", "x0", "x1", "y0", "y1"), "union").select("fid", ROW, COLUMN, "area")


@query(f"with p as (select * from {_PART}), {_LEFT} {_outside()} union all {_REST}")
def grid_overlay_symmetric_difference(spark, sf_dir):
    return GRID.overlay(_feat(spark, sf_dir).select("fid", "x0", "x1", "y0", "y1"), "symmetric_difference").select("fid", ROW, COLUMN, "area")


@query(f"""select filename, coalesce(bool_and(coalesce(geom_type = 'Polygon', false)), false) as only_polygons, coalesce(bool_or(geom_type = 'MultiPolygon'), false) as multipolygons,
count(*) filter (fid % 3 = 0) as n_true, coalesce(bool_or(geom_type is null), false) as any_null, count(distinct geom_type) as n_types from {FEAT} group by filename""")
def table_checks(spark, sf_dir):
    feat = _feat(spark, sf_dir).withColumn("label", F.when(F.col("fid") % 3 == 0, True))
    wanted = {"only_polygons": checks.all_of_type("Polygon"), "multipolygons": checks.contains_multipolygons(), "n_true": checks.n_true("label"), "any_null": checks.any_null("geom_type"), "n_types": F.count_distinct("geom_type")}
    return checks.check(feat, wanted, ["filename"])


@query(f"select fid, {_TILE.format(c=_COL, r=_ROW)} as tile, {_COL} // 2 as parent_x from {PTS} where x > -180 and y > -90")
def sql_functions(spark, sf_dir):
    """The same lookup as ``tile_from_xy``, in SQL by the registered functions."""
    registry.register(spark)
    pts = fixtures.load(spark, sf_dir, "pts").where("x > -180 and y > -90")
    return spark.sql("select fid, tw_tile_text(tw_tile_column(x, 5), tw_tile_row(y, 5), 5) as tile, tw_parent_x(tw_tile_column(x, 5)) as parent_x from {pts}", pts=pts)


# Paths and preparation.

_PATHS = paths.TilePaths("WGS1984Quad")


@query(f"select fid, staging_tile, 'staged/vec/WGS1984Quad/' || tile_z || '/' || tile_x || '/' || tile_y || '.gpkg' as path from {_STAGED}")
def tile_path_format(spark, sf_dir):
    return _staged(spark, sf_dir).select("fid", "staging_tile", _PATHS.path(F.col("tile_x"), F.col("tile_y"), F.col("tile_z"), "staged", "vec", ".gpkg").alias("path"))


@query(f"select distinct '/staged' as base_dir, 'vec' as style, 'WGS1984Quad' as tms, tile_z as z, tile_x as x, tile_y as y, '.gpkg' as ext from {_STAGED}")
def tile_path_parse(spark, sf_dir):
    path = _PATHS.path(F.col("tile_x"), F.col("tile_y"), F.col("tile_z"), "/staged/", "vec", ".gpkg").alias("path")
    return _staged(spark, sf_dir).select(path).distinct().select(*[v.alias(k) for k, v in _PATHS.parse(F.col("path")).items()])


@query(f"select distinct tile_x as x, tile_y as y, tile_z as z from {_STAGED}")
def tile_str_parse(spark, sf_dir):
    return _staged(spark, sf_dir).select("staging_tile").distinct().select(paths.tile_from_text(F.col("staging_tile")).alias("t")).select("t.*")


@query(f"select min(tile_left) as minx, min(tile_bottom) as miny, max(tile_right) as maxx, max(tile_top) as maxy from {_STAGED}")
def total_bounding_box(spark, sf_dir):
    path = _PATHS.path(F.col("tile_x"), F.col("tile_y"), F.col("tile_z"), "staged", "vec", ".gpkg").alias("path")
    t = _staged(spark, sf_dir).select(path).distinct().select(_PATHS.tile_of(F.col("path")).alias("t")).select("t.*")
    b = tile_bounds("WGS1984Quad", F.col("x"), F.col("y"), F.col("z"))
    return t.select(*[v.alias(k) for k, v in b.items()]).agg(F.min("left").alias("minx"), F.min("bottom").alias("miny"), F.max("right").alias("maxx"), F.max("top").alias("maxy"))


def _read(spark, sf_dir, name) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("""with f as (select 'foot/' || s_suppkey || '.shp' as p, s_suppkey % 40 as k from supplier), d as (select case when p_partkey % 29 = 0 then p_size % 40 else 40 + p_partkey end as k, 'in/' || p_partkey as path from part)
select p as original_footprint_path, case count(path) when 0 then 'no_match' when 1 then 'matched' else 'multiple_matches' end as status, case when count(path) = 1 then min(path) end as match
from f left join d using (k) group by p""")
def footprint_dir_match(spark, sf_dir):
    f = _read(spark, sf_dir, "supplier").selectExpr("concat('foot/', s_suppkey, '.shp') as original_footprint_path", "s_suppkey % 40 as key")
    d = _read(spark, sf_dir, "part").selectExpr("cast(case when p_partkey % 29 = 0 then p_size % 40 else 40 + p_partkey end as bigint) as key", "concat('in/', p_partkey) as path")
    return prep.directory_match(f, d)


@query("""with f as (select 'foot/' || s_suppkey as p, 'a' || s_suppkey || '_d' || (s_suppkey % 7) || '_c' as id from supplier),
m as (select 'a' || k || '_d' || (p_partkey % 7) || '_c' as id, min('in/' || p_brand || '/a' || k || '_d' || (p_partkey % 7) || '_c_u_v.shp') as match from (select *, p_partkey * case when p_partkey % 3 > 0 then 1 else -1 end as k from part) t group by 1)
select p as original_footprint_path, id as footprint_id, string_split(id, '_')[2] as date, case when match is null then 'no_match' else 'matched' end as status, match from f left join m using (id)""")
def footprint_feature_match(spark, sf_dir):
    f = _read(spark, sf_dir, "supplier").selectExpr("concat('foot/', s_suppkey) as original_footprint_path", "concat('a', s_suppkey, '_d', s_suppkey % 7, '_c') as footprint_id")
    files = _read(spark, sf_dir, "part").selectExpr("p_brand", "p_partkey", "p_partkey * case when p_partkey % 3 > 0 then 1 else -1 end as k")
    files = files.selectExpr("concat('in/', p_brand, '/a', k, '_d', p_partkey % 7, '_c_u_v.shp') as path")
    return prep.feature_match(f, files)


@query("""select c_nationkey as region, 'id' || c_custkey as footprint_id, 'p/' || c_custkey as path from customer c
where not exists (select 1 from supplier s where s.s_nationkey = c.c_nationkey and 'id' || s.s_suppkey = 'id' || c.c_custkey)""")
def missing_footprints(spark, sf_dir):
    rows = _read(spark, sf_dir, "customer").selectExpr("c_nationkey as region", "concat('id', c_custkey) as footprint_id", "concat('p/', c_custkey) as path")
    return prep.missing_footprints(rows, _read(spark, sf_dir, "supplier").selectExpr("s_nationkey as region", "concat('id', s_suppkey) as name")).select("region", "footprint_id", "path")


@query(f"""with m as (select path, regexp_extract(path, '[^/]*$') as name from ({fixtures.duck('main_paths')})), p as (select min(path) as better, regexp_extract(path, '[^/]*$') as name from ({fixtures.duck('preferred')}) group by 2),
n as (select *, row_number() over (partition by name order by path) as k from m)
select path as main_path, case when k = 1 and better is not null then better else path end as path, k = 1 and better is not null as replaced from n left join p using (name)""")
def preferred_paths(spark, sf_dir):
    return prep.preferred_paths(fixtures.load(spark, sf_dir, "main_paths"), fixtures.load(spark, sf_dir, "preferred"))


@query("""select regexp_extract(path, '([^/.]*)[^/]*$', 1) as base, string_split(regexp_extract(path, '([^/.]*)[^/]*$', 1), '_')[2] as date, trim(path[6:], '/') as filename from (""" + fixtures.duck("main_paths") + ")")
def path_functions(spark, sf_dir):
    p = F.col("path")
    return fixtures.load(spark, sf_dir, "main_paths").select(prep.base_name(p).alias("base"), prep.date_of_id(prep.base_name(p)).alias("date"), staging.filename_of(p, "/main").alias("filename"))


@query(f"select fid, staging_filename, staging_centroid_tile, staging_area from {_STAGED} where staging_centroid_within_tile")
def archive_filter(spark, sf_dir):
    return staging.archive(_staged(spark, sf_dir)).select("fid", "staging_filename", "staging_centroid_tile", "staging_area")


# Deduplication.


@query(f"select fid, not exists (select 1 from {LAND} t where {_MEET}) as staging_duplicated from {FEAT} f")
def clip_footprint(spark, sf_dir):
    return dedup.clip_to_boundary(_feat(spark, sf_dir).select("fid", "x0", "x1", "y0", "y1"), fixtures.load(spark, sf_dir, "land")).select("fid", "staging_duplicated")


@query(f"select fid, not exists (select 1 from {LAND} t where {_OF_PREDICATE['within']}) as staging_duplicated from {FEAT} f")
def clip_footprint_within(spark, sf_dir):
    return dedup.clip_to_boundary(_feat(spark, sf_dir).select("fid", "x0", "x1", "y0", "y1"), fixtures.load(spark, sf_dir, "land"), "within").select("fid", "staging_duplicated")


def _pairs(n: int, test: str, loser: str) -> str:
    f = f"(select *, 'file_' || (fid % {n}) || '.shp' as file from {FEAT})"
    ia = "(least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0))"
    return f"""q as (select a.fid as fa, b.fid as fb, a.file as ga, b.file as gb, {loser} as loser from {f} a join {f} b on a.file < b.file and a.x0 < b.x1 and b.x0 < a.x1 and a.y0 < b.y1 and b.y0 < a.y1
where {test.format(ia=ia)})"""


_LARGER = "case when b.price > a.price then a.fid else b.fid end"
_EITHER, _BOTH = "({ia} > 0.3e0 * a.area or {ia} > 0.3e0 * b.area)", "({ia} > 0.3e0 * a.area and {ia} > 0.3e0 * b.area)"


def _two(name: str, test: str, loser: str, **how) -> None:
    sql = f"with {_pairs(2, test, loser)} select fid, fid in (select loser from q) as staging_duplicated from {FEAT}"

    def run(spark, sf_dir):
        return dedup.deduplicate_neighbors(fixtures.files(spark, sf_dir, 2), "filename", **how).select("fid", "staging_duplicated")

    run.__name__ = name
    query(sql)(run)


_two("dedup_neighbors_either", _EITHER, _LARGER, keep_rules=[("price", "larger")], overlap_tolerance=0.3, overlap_both=False)
_two("dedup_neighbors_both", _BOTH, _LARGER, keep_rules=[("price", "larger")], overlap_tolerance=0.3)
_two("dedup_neighbors_any", "true", "case when b.area < a.area then a.fid else b.fid end", keep_rules=[("area_", "smaller")], overlap_tolerance=None)
_two("dedup_neighbors_centroid", _EITHER + " and sqrt((a.cx - b.cx) * (a.cx - b.cx) + (a.cy - b.cy) * (a.cy - b.cy)) <= 1", _LARGER, keep_rules=[("price", "larger")], overlap_tolerance=0.3, overlap_both=False, centroid_tolerance=1.0, distance_crs=4326)
_two("dedup_neighbors_ties", _EITHER, "case when b.y0 > a.y0 or (b.y0 = a.y0 and b.area < a.area) then a.fid else b.fid end", keep_rules=[("y0", "larger"), ("area_", "smaller")], overlap_tolerance=0.3, overlap_both=False)


@query(f"""with {_pairs(3, _EITHER, _LARGER)}, r1 as (select distinct loser from q where ga = 'file_0.shp' and gb = 'file_1.shp'),
r2 as (select distinct loser from q where ga = 'file_0.shp' and gb = 'file_2.shp' and fa not in (select loser from r1) and fb not in (select loser from r1)), r12 as (select * from r1 union select * from r2),
r3 as (select distinct loser from q where ga = 'file_1.shp' and fa not in (select loser from r12) and fb not in (select loser from r12))
select fid, fid in (select loser from r12 union select loser from r3) as staging_duplicated from {FEAT}""")
def dedup_neighbors_three_groups(spark, sf_dir):
    return dedup.deduplicate_neighbors(fixtures.files(spark, sf_dir, 3), "filename", [("price", "larger")], 0.3, False).select("fid", "staging_duplicated")


@query(f"select filename, row_number() over (order by yr desc) as rank from {FOOT}")
def footprint_rank(spark, sf_dir):
    return dedup.footprint_rank(fixtures.load(spark, sf_dir, "footprint"), [("yr", "larger")])


_ZONES = f"""(select case when a.yr > b.yr then b.filename else a.filename end as file, greatest(a.x0, b.x0) as x0, greatest(a.y0, b.y0) as y0, least(a.x1, b.x1) as x1, least(a.y1, b.y1) as y1
from {FOOT} a join {FOOT} b on a.filename < b.filename and a.x0 <= b.x1 and b.x0 <= a.x1)"""


@query(f"select fid, filename, fid % 17 = 0 or exists (select 1 from {_ZONES} t where t.file = f.filename and {_MEET}) as staging_duplicated from {FEAT} f")
def dedup_footprint(spark, sf_dir):
    feat = _feat(spark, sf_dir).select("fid", "filename", "x0", "x1", "y0", "y1", (F.col("fid") % 17 == 0).alias("staging_duplicated"))
    return dedup.deduplicate_by_footprint(feat, fixtures.load(spark, sf_dir, "footprint"), "filename", [("yr", "larger")]).select("fid", "filename", "staging_duplicated")


@query(f"select fid, case when fid % 4 = 1 then true else coalesce(case fid % 3 when 0 then true when 1 then false end, false) end as staging_duplicated from {FEAT}")
def label_merge(spark, sf_dir):
    feat = _feat(spark, sf_dir).select("fid").withColumn("staging_duplicated", F.when(F.col("fid") % 3 == 0, True).when(F.col("fid") % 3 == 1, False))
    return dedup.label_duplicates(feat.where("fid % 4 <> 1"), feat.where("fid % 4 = 1"))


_TILED = "(select *, staging_tile as tile, 'file_' || (fid % 2) || '.shp' as file from staged)"
_IN_TILE = f"""q as (select a.tile, case when b.price > a.price then a.fid else b.fid end as loser from {_TILED} a join {_TILED} b on a.tile = b.tile and a.file < b.file
and a.x0 < b.x1 and b.x0 < a.x1 and a.y0 < b.y1 and b.y0 < a.y1
where (least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0)) > 0.3e0 * a.staging_area or (least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0)) > 0.3e0 * b.staging_area)"""


def _by_tile(df: DataFrame) -> DataFrame:
    return dedup.deduplicate_neighbors(df, "file", [("price", "larger")], 0.3, False, partition_by=["staging_tile"])


def _tiled(spark, sf_dir) -> DataFrame:
    out = _staged(spark, sf_dir).withColumn("file", F.expr("concat('file_', cast(fid % 2 as string), '.shp')"))
    return out.select("fid", "file", "price", "x0", "x1", "y0", "y1", "staging_tile")


@query(f"with staged as (select * from {_STAGED}), {_IN_TILE} select fid, staging_tile from staged where (staging_tile, fid) not in (select tile, loser from q)")
def combine_and_dedup(spark, sf_dir):
    """Old rows (fid a multiple of 3) and new ones, deduplicated tile by tile."""
    rows = _tiled(spark, sf_dir)
    return dedup.combine_and_deduplicate(rows.where("fid % 3 = 0"), rows.where("fid % 3 <> 0"), _by_tile).select("fid", "staging_tile")


def _matrix(name: str, with_dedup: bool, at: str) -> None:
    known = "(select distinct staging_tile from staged where fid % 3 = 0)"
    dup = f"(staging_tile, fid) in (select tile, loser from q)"
    if with_dedup:
        keep = f"where not ({dup})" if at == "staging" else ""
        label = "false" if at == "staging" else dup
        sql = f"""with staged as (select * from {_STAGED}), {_IN_TILE} select fid, staging_tile, 'overwrite' as mode, {label} as staging_duplicated from
(select * from staged where staging_tile in (select staging_tile from {known}) and staging_tile in (select staging_tile from staged where fid % 3 <> 0)) {keep}
union all select fid, staging_tile, 'new' as mode, false from staged where fid % 3 <> 0 and staging_tile not in (select staging_tile from {known})"""
    else:
        sql = f"""with staged as (select * from {_STAGED}) select fid, staging_tile, case when staging_tile in (select staging_tile from {known}) then 'append' else 'new' end as mode from staged where fid % 3 <> 0"""

    def run(spark, sf_dir):
        rows = _tiled(spark, sf_dir)
        out = staging.save_plan(rows.where("fid % 3 <> 0"), rows.where("fid % 3 = 0"), _by_tile if with_dedup else None, at)
        return out.select("fid", "staging_tile", "mode", *(["staging_duplicated"] if with_dedup else []))

    run.__name__ = name
    query(sql)(run)


_matrix("save_matrix_append", False, "staging")
_matrix("save_matrix_dedup", True, "staging")
_matrix("save_matrix_later", True, "later")


# Cells.

HEX = cells.PlanarHex(5.0)
_Q, _R = f"(({math.sqrt(3) / 3!r}e0 * x - y / 3) / 5.0e0)", "((2.0e0 / 3 * y) / 5.0e0)"
_HEX_OF = """select *, cast(case when dq > dr and dq > ds then -nr - ns else nq end as bigint) as q, cast(case when not (dq > dr and dq > ds) and dr > ds then -nq - ns else nr end as bigint) as r
from (select *, abs(nq - q0) as dq, abs(nr - r0) as dr, abs(ns - s0) as ds from (select *, floor(q0 + 0.5e0) as nq, floor(r0 + 0.5e0) as nr, floor(s0 + 0.5e0) as ns from
(select *, -q0 - r0 as s0 from (select *, {q} as q0, {r} as r0 from {t}))))"""


@query(f"select q, r, count(*) as _count, cast(sum(user_id) as bigint) as sum_user_id from ({_HEX_OF.format(q=_Q, r=_R, t=PTS)}) group by q, r")
def hex_point_counts(spark, sf_dir):
    q, r = HEX.cell_of_point(F.col("x"), F.col("y"))
    return cells.summarise(fixtures.load(spark, sf_dir, "pts").select(q.alias("q"), r.alias("r"), "user_id"), ["q", "r"], ["user_id"])


_W, _H = f"{5 * math.sqrt(3)!r}e0", "7.5e0"
_BOXES = f"(select fid, x0, x1, y0, y1, cast(round(price * 100) as bigint) as cents, (x0 + x1) / 2 as x, (y0 + y1) / 2 as y from {FEAT})"
_HEX_BOX = f"""with f as (select * from {_BOXES}), rr as (select *, unnest(range(cast(ceil(y0 / {_H}) as bigint), cast(floor(y1 / {_H}) as bigint) + 1)) as r from f),
cc as (select fid, cents, unnest(range(cast(ceil(x0 / {_W} - r / 2) as bigint), cast(floor(x1 / {_W} - r / 2) as bigint) + 1)) as q, r from rr),
own as (select fid, cents, q, r from ({_HEX_OF.format(q=_Q, r=_R, t="(select * from f where fid not in (select fid from cc))")})), every as (select * from cc union all select * from own)"""


def _cents(spark, sf_dir) -> DataFrame:
    return _feat(spark, sf_dir).selectExpr("fid", "x0", "x1", "y0", "y1", "cast(round(price * 100) as bigint) as cents")


@query(_HEX_BOX + " select q, r, count(*) as _count, cast(sum(cents) as bigint) as sum_cents, round(avg(cents), 4) as mean_cents from every group by q, r")
def hex_polygon_summary(spark, sf_dir):
    return cells.hex_summary(_cents(spark, sf_dir), HEX, ["cents"], ["cents"]).withColumn("mean_cents", F.round("mean_cents", 4))


def _hex_common(box: str) -> str:
    """Area that hexagon (q, r) and a box share: the height of what they share is linear between the x at which a side begins to count."""
    w, top, low = math.sqrt(3), "(r * 7.5e0 + 5)", "(r * 7.5e0 - 5)"
    cx = f"((q + r / 2e0) * {5 * w!r}e0)"
    at = lambda x: f"greatest(least({box}y1, {top} - abs({x} - {cx}) / {w!r}e0) - greatest({box}y0, {low} + abs({x} - {cx}) / {w!r}e0), 0)"
    first, last = f"greatest({box}x0, {cx} - {2.5 * w!r}e0)", f"least({box}x1, {cx} + {2.5 * w!r}e0)"
    turns = [cx, *[f"{cx} {sign} {w!r}e0 * {d}" for sign in "+-" for d in (f"({top} - {box}y1)", f"({top} - {box}y0)", f"({box}y0 - {low})", f"({box}y1 - {low})")]]
    turns = ", ".join(f"greatest(least({t}, {last}), {first})" for t in turns)
    xs = f"list_sort([{first}, greatest({last}, {first}), {turns}])"
    return f"list_sum(list_transform(range(1, 11), lambda i: ({xs}[i + 1] - {xs}[i]) * ({at(f'{xs}[i]')} + {at(f'{xs}[i + 1]')}) / 2))"


_HEX_AREAS = _HEX_BOX + f", sums as (select q, r, count(*) as _count, sum({_hex_common('f.')}) as area from every join f using (fid) group by q, r)"


@query(_HEX_AREAS + " select q, r, _count, round(area, 6) as area_km2 from sums")
def hex_polygon_areas(spark, sf_dir):
    out = cells.hex_summary(_cents(spark, sf_dir), HEX, with_area=True, unit=1.0)
    return out.select("q", "r", "_count", F.round("area_km2", 6).alias("area_km2"))


@query(_HEX_AREAS + f""", land as (select q, r, sum({_hex_common('b.')}) as land from sums join {LAND} b on b.x0 < (q + r / 2e0) * {5 * math.sqrt(3)!r}e0 + {2.5 * math.sqrt(3)!r}e0
and b.x1 > (q + r / 2e0) * {5 * math.sqrt(3)!r}e0 - {2.5 * math.sqrt(3)!r}e0 and b.y0 < r * 7.5e0 + 5 and b.y1 > r * 7.5e0 - 5 group by q, r)
select q, r, _count, round(coalesce(land, 0), 6) as land_area_km2, round(greatest(least(coalesce(land, 0) / {HEX.area!r}e0, 1), 0), 6) as land_fraction,
case when land > 0 then round(greatest(least(area / land, 1), 0), 6) end as land_coverage_fraction from sums left join land using (q, r)""")
def hex_land_metrics(spark, sf_dir):
    summary = HEX.as_box(cells.hex_summary(_cents(spark, sf_dir), HEX, with_area=True, unit=1.0))
    shared = HEX.shared_area(F.col("a.q"), F.col("a.r"), Box("b."))
    out = cells.land_metrics(summary, fixtures.load(spark, sf_dir, "land"), ["q", "r"], F.lit(HEX.area), "area_km2", shared)
    return out.select("q", "r", "_count", *[F.round(c, 6).alias(c) for c in ("land_area_km2", "land_fraction", "land_coverage_fraction")])


@query(f"""with c as (select * from {_CELLS}), s as (select c.{ROW}, c.{COLUMN}, sum((least(c.x1, t.x1) - greatest(c.x0, t.x0)) * (least(c.y1, t.y1) - greatest(c.y0, t.y0))) as land from c join {LAND} t
on c.x0 < t.x1 and t.x0 < c.x1 and c.y0 < t.y1 and t.y0 < c.y1 group by all)
select {ROW}, {COLUMN}, 100e0 as cell_area_km2, coalesce(land, 0) as land_area_km2, greatest(least(coalesce(land, 0) / 100e0, 1), 0) as land_fraction,
case when land > 0 then greatest(least(50e0 / land, 1), 0) end as land_coverage_fraction from c left join s using ({ROW}, {COLUMN})""")
def grid_land_metrics(spark, sf_dir):
    out = cells.land_metrics(GRID.cells(spark).withColumn("covered", F.lit(50.0)), fixtures.load(spark, sf_dir, "land"), [ROW, COLUMN], F.lit(GRID.cell_area), "covered")
    return out.drop("x0", "y0", "x1", "y1", "covered")


# Rings and projections.


def _ell() -> Column:
    """The rings of an L-shape: a feature's box less its upper right quarter."""
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    shape = [("x0", "y0"), ("x1", "y0"), ("x1", "cy"), ("cx", "cy"), ("cx", "y1"), ("x0", "y1"), ("x0", "y0")]
    return F.array(F.array(*[corner(*p) for p in shape]))


def _rings(spark, sf_dir) -> DataFrame:
    return _feat(spark, sf_dir).select("fid", "x0", "x1", "y0", "y1", "cx", "cy", _ell().alias("rings"))


@query(f"select fid, 0.75e0 * area as area, round(cx - (x1 - x0) / 12, 9) as x, round(cy - (y1 - y0) / 12, 9) as y from {FEAT}")
def ring_area_centroid(spark, sf_dir):
    x, y = rings.centroid(F.col("rings"))
    # Sums far from the origin lose digits: the ring is moved to its own corner first.
    moved = F.transform("rings", lambda r: F.transform(r, lambda p: F.struct((p["x"] - F.col("x0")).alias("x"), (p["y"] - F.col("y0")).alias("y"))))
    out = _rings(spark, sf_dir).withColumn("rings", moved)
    return out.select("fid", rings.area(F.col("rings")).alias("area"), F.round(x + F.col("x0"), 9).alias("x"), F.round(y + F.col("y0"), 9).alias("y"))


@query(f"select fid, round(radians(x) * {crs.RADIUS!r}, 3) + 0e0 as mx, round(ln(tan(pi() / 4 + radians(y) / 2)) * {crs.RADIUS!r}, 3) + 0e0 as my from {PTS} where abs(y) < 85")
def reproject_3857(spark, sf_dir):
    x, y = crs.reproject(F.col("x"), F.col("y"), 4326, 3857)
    return fixtures.load(spark, sf_dir, "pts").where("abs(y) < 85").select("fid", (F.round(x, 3) + 0.0).alias("mx"), (F.round(y, 3) + 0.0).alias("my"))


@query(f"select fid, cast(5 + cast((x1 - x0) / 64 > 0.05e0 as int) as int) as n_points, area + case when (x1 - x0) / 64 > 0.05e0 then (x1 - x0) * (x1 - x0) / 128 else 0 end as area from {FEAT}")
def ring_simplify(spark, sf_dir):
    """Boxes with a corner a 64th of their width below their lower side, which goes if that is within the tolerance."""
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    x0, x1, y0, y1, cx = (F.col(c) for c in ("x0", "x1", "y0", "y1", "cx"))
    shape = F.array(F.array(F.array(corner(x0, y0), corner(cx, y0 - (x1 - x0) / 64), corner(x1, y0), corner(x1, y1), corner(x0, y1), corner(x0, y0))))
    out = staging.simplify(_feat(spark, sf_dir).withColumn("polygons", shape), 0.05)
    return out.select("fid", F.size(F.get(F.get("polygons", 0), 0)).alias("n_points"), polygons.measures(F.col("polygons"))["area"].alias("area"))


@query(f"select f.fid, t.{ROW}, t.{COLUMN}, round(greatest(least(f.x1, t.x1) - greatest(f.x0, t.x0), 0) * greatest(least(f.y1, t.y1) - greatest(f.y0, t.y0), 0) - greatest(least(f.x1, t.x1) - greatest(f.cx, t.x0), 0) * greatest(least(f.y1, t.y1) - greatest(f.cy, t.y0), 0), 6) as area from {FEAT} f join {_CELLS} t on {_AREA}")
def ring_cell_area(spark, sf_dir):
    """Area of each L-shape in each cell that its box shares an area with."""
    out = GRID.candidates(_rings(spark, sf_dir)).select("*", *[v.alias(f"cell_{k}") for k, v in GRID._box(F.col("kx"), F.col("ky")).items()])
    out = out.where((F.col("x0") < F.col("cell_x1")) & (F.col("cell_x0") < F.col("x1")) & (F.col("y0") < F.col("cell_y1")) & (F.col("cell_y0") < F.col("y1")))
    row, col = GRID._named(F.col("kx"), F.col("ky"))
    area = rings.area_in_box(F.col("rings"), *[F.col(f"cell_{k}") for k in ("x0", "y0", "x1", "y1")])
    return out.select("fid", row.alias(ROW), col.alias(COLUMN), F.round(area, 6).alias("area"))


# Polygons: L-shapes, a feature's box less its upper right quarter. In SQL they are two boxes that share a side.


def _ells(spark, sf_dir) -> DataFrame:
    return _feat(spark, sf_dir).select("fid", "filename", "price", "geom_type", "x0", "x1", "y0", "y1", F.array(_ell()).alias("polygons"))


_LOW, _TALL = {"x0": "{f}.x0", "y0": "{f}.y0", "x1": "{f}.x1", "y1": "{f}.cy"}, {"x0": "{f}.x0", "y0": "{f}.cy", "x1": "{f}.cx", "y1": "{f}.y1"}
_GAP = {"x0": "{f}.cx", "y0": "{f}.cy", "x1": "{f}.x1", "y1": "{f}.y1"}
_WHOLE = {k: f"{{f}}.{k}" for k in ("x0", "y0", "x1", "y1")}


def _of(part: dict, f: str) -> dict:
    return {k: v.format(f=f) for k, v in part.items()}


def _meet_sql(a: dict, b: dict, closed: bool = True) -> str:
    le = "<=" if closed else "<"
    return f"({a['x0']} {le} {b['x1']} and {b['x0']} {le} {a['x1']} and {a['y0']} {le} {b['y1']} and {b['y0']} {le} {a['y1']})"


def _common_sql(a: dict, b: dict) -> str:
    return f"greatest(least({a['x1']}, {b['x1']}) - greatest({a['x0']}, {b['x0']}), 0) * greatest(least({a['y1']}, {b['y1']}) - greatest({a['y0']}, {b['y0']}), 0)"


def _ell_meets(f: str, t: str, closed: bool = True) -> str:
    return "(" + " or ".join(_meet_sql(_of(part, f), _of(_WHOLE, t), closed) for part in (_LOW, _TALL)) + ")"


_FINE = Grid((-20, -20, 20, 20), 80, 80, first_row_i=-3)
_FINE_CELLS = f"""(select cast({_FINE.first_row_i + _FINE.nrows - 1} - ky as bigint) as {ROW}, cast(kx as bigint) as {COLUMN}, kx * 0.5e0 - 20 as x0, ky * 0.5e0 - 20 as y0, (kx + 1) * 0.5e0 - 20 as x1, (ky + 1) * 0.5e0 - 20 as y1
from (select unnest(range(80)) as ky) r, (select unnest(range(80)) as kx) c)"""
_ELL_CONTAINS = f"({_COVERS.format(a='f', b='t')} and not {_meet_sql(_of(_GAP, 'f'), _of(_WHOLE, 't'), False)})"
_ELL_PREDICATE = {
    "intersects": _ell_meets("f", "t"), "contains": _ELL_CONTAINS, "within": _COVERS.format(a="t", b="f"), "touches": f"{_ell_meets('f', 't')} and not {_ell_meets('f', 't', False)}", "crosses": "false",
    "overlaps": f"{_ell_meets('f', 't', False)} and not {_ELL_CONTAINS} and not ({_COVERS.format(a='t', b='f')})",
}


def _ell_sjoin(name: str) -> None:
    def run(spark, sf_dir):
        return _FINE.sjoin(_ells(spark, sf_dir), "inner", name).select("fid", ROW, COLUMN)

    run.__name__ = f"polygon_sjoin_{name}"
    query(f"select f.fid, t.{ROW}, t.{COLUMN} from {FEAT} f join {_FINE_CELLS} t on f.x0 <= t.x1 and t.x0 <= f.x1 and f.y0 <= t.y1 and t.y0 <= f.y1 and {_ELL_PREDICATE[name]}")(run)


for _p in PREDICATES:
    _ell_sjoin(_p)


@query(f"select f.fid, t.{ROW}, t.{COLUMN} from {FEAT} f left join (select f.fid as id, t.{ROW}, t.{COLUMN} from {FEAT} f join {_CELLS} t on {_ell_meets('f', 't')}) t on f.fid = t.id")
def polygon_sjoin_left(spark, sf_dir):
    return GRID.sjoin(_ells(spark, sf_dir)).select("fid", ROW, COLUMN)


_ELL_PART = f"(select f.fid, t.{ROW}, t.{COLUMN}, {_common_sql(_of(_LOW, 'f'), _of(_WHOLE, 't'))} + {_common_sql(_of(_TALL, 'f'), _of(_WHOLE, 't'))} as area from {FEAT} f join {_CELLS} t on {_AREA})"


@query(f"select * from {_ELL_PART} where area > 0")
def polygon_overlay(spark, sf_dir):
    return GRID.overlay(_ells(spark, sf_dir).select("fid", "x0", "x1", "y0", "y1", "polygons")).select("fid", ROW, COLUMN, "area")


@query(f"select f.fid, 0.75e0 * f.area as area, 0.75e0 * f.area - coalesce(sum(p.area), 0) as outside from {FEAT} f left join {_ELL_PART} p on f.fid = p.fid group by f.fid, f.area")
def polygon_overlay_identity(spark, sf_dir):
    out = GRID.overlay(_ells(spark, sf_dir).select("fid", "x0", "x1", "y0", "y1", "polygons"), "identity")
    return out.groupBy("fid").agg(F.sum("area").alias("area"), F.sum(F.when(F.col(ROW).isNull(), F.col("area")).otherwise(0.0)).alias("outside"))


@query(f"""select f.fid, f.filename as staging_filename, 0.75e0 * f.area as staging_area, round(f.cx - (f.x1 - f.x0) / 12, 6) as x, round(f.cy - (f.y1 - f.y0) / 12, 6) as y, {_NAME} as staging_tile
from {FEAT} f join {_SNAPPED} t on {_ell_meets('f', 't')} where f.geom_type in ('Polygon', 'MultiPolygon')""")
def polygon_staged(spark, sf_dir):
    """Area, centroid and tiles of the shapes themselves, not of their bounds."""
    out = staging.stage(_ells(spark, sf_dir), CONFIG, F.col("filename"))
    return out.select("fid", "staging_filename", "staging_area", F.round("staging_centroid_x", 6).alias("x"), F.round("staging_centroid_y", 6).alias("y"), "staging_tile")


_ELL_COMMON = " + ".join(_common_sql(_of(p, "a"), _of(q, "b")) for p in (_LOW, _TALL) for q in (_LOW, _TALL))


def _ell_pairs(both: bool) -> str:
    f = f"(select *, 'file_' || (fid % 2) || '.shp' as file from {FEAT})"
    ratio = f" {'and' if both else 'or'} ".join(f"common > 0.30001e0 * 0.75e0 * {s}" for s in ("aa", "ab"))
    return f"""q as (select loser from (select {_LARGER} as loser, {_ELL_COMMON} as common, a.area as aa, b.area as ab from {f} a join {f} b
on a.file < b.file and a.x0 < b.x1 and b.x0 < a.x1 and a.y0 < b.y1 and b.y0 < a.y1) where common > 0 and ({ratio}))"""


def _ell_dedup(both: bool) -> None:
    def run(spark, sf_dir):
        shapes = _ells(spark, sf_dir).withColumn("filename", F.expr("concat('file_', cast(fid % 2 as string), '.shp')"))
        return dedup.deduplicate_neighbors(shapes, "filename", [("price", "larger")], 0.30001, both).select("fid", "staging_duplicated")

    run.__name__ = f"polygon_dedup_neighbors_{'both' if both else 'either'}"
    query(f"with {_ell_pairs(both)} select fid, fid in (select loser from q) as staging_duplicated from {FEAT}")(run)


_ell_dedup(False)
_ell_dedup(True)


@query(f"select fid, not exists (select 1 from {LAND} t where {_ell_meets('f', 't')}) as staging_duplicated from {FEAT} f")
def polygon_clip_footprint(spark, sf_dir):
    return dedup.clip_to_boundary(_ells(spark, sf_dir), fixtures.load(spark, sf_dir, "land")).select("fid", "staging_duplicated")


def _ell_clip(name: str) -> None:
    def run(spark, sf_dir):
        return dedup.clip_to_boundary(_ells(spark, sf_dir), fixtures.load(spark, sf_dir, "land"), name).select("fid", "staging_duplicated")

    run.__name__ = f"polygon_clip_{name}"
    test = _ELL_PREDICATE[{"covers": "contains", "contains_properly": "contains"}.get(name, name)]
    query(f"select fid, not exists (select 1 from {LAND} t where {test}) as staging_duplicated from {FEAT} f")(run)


for _p in ("within", "overlaps", "touches", "covers", "contains_properly"):
    _ell_clip(_p)


@query(f"select fid, filename, fid % 17 = 0 or exists (select 1 from {_ZONES} t where t.file = f.filename and {_ell_meets('f', 't')}) as staging_duplicated from {FEAT} f")
def polygon_dedup_footprint(spark, sf_dir):
    shapes = _ells(spark, sf_dir).withColumn("staging_duplicated", F.col("fid") % 17 == 0)
    return dedup.deduplicate_by_footprint(shapes, fixtures.load(spark, sf_dir, "footprint"), "filename", [("yr", "larger")]).select("fid", "filename", "staging_duplicated")


@query(f"select fid, (x0 + cx) / 2 as x, cy as y, false as is_empty, 'Polygon' as kind, 0.75e0 * area as area from {FEAT}")
def polygon_accessors(spark, sf_dir):
    """A point inside, emptiness, type and area, the last two through well-known binary and back."""
    out = _ells(spark, sf_dir).withColumn("wkb", polygons.to_wkb(F.col("polygons"))).withColumn("back", polygons.from_wkb(F.col("wkb")))
    x, y = polygons.representative_point(F.col("polygons"))
    area = polygons.measures(F.col("back"))["area"]
    return out.select("fid", x.alias("x"), y.alias("y"), polygons.is_empty(F.col("polygons")).alias("is_empty"), rings.geometry_type(F.col("wkb")).alias("kind"), area.alias("area"))


@query(f"select filename, count(*) as n, count(*) as n_ids from {FEAT} where geom_type in ('Polygon', 'MultiPolygon') group by filename")
def feature_identifiers(spark, sf_dir):
    """Features and their identifiers by file: each has one of its own, and keeps it in all of its tiles."""
    staged = staging.stage(_ells(spark, sf_dir), CONFIG, F.col("filename"))
    return staged.groupBy("filename").agg(F.count_distinct("fid").alias("n"), F.count_distinct("staging_identifier").alias("n_ids"))


_HEX_ELL = f"""with f as (select *, cast(round(price * 100) as bigint) as cents from {FEAT}), rr as (select *, unnest(range(cast(ceil(y0 / {_H}) as bigint), cast(floor(y1 / {_H}) as bigint) + 1)) as r from f),
cc as (select *, unnest(range(cast(ceil(x0 / {_W} - r / 2) as bigint), cast(floor(x1 / {_W} - r / 2) as bigint) + 1)) as q from rr),
ee as (select fid, cents, q, r from (select *, (q + r / 2e0) * {_W} as px, r * {_H} as py from cc) where (py >= y0 and py < cy and px >= x0 and px < x1) or (py >= cy and py < y1 and px >= x0 and px < cx)),
own as (select fid, cents, q, r from ({_HEX_OF.format(q=_Q, r=_R, t="(select fid, cents, (x0 + cx) / 2 as x, cy as y from f where fid not in (select fid from ee))")})), every as (select * from ee union all select * from own)"""


@query(_HEX_ELL + " select q, r, count(*) as _count, cast(sum(cents) as bigint) as sum_cents from every group by q, r")
def polygon_hex_summary(spark, sf_dir):
    """L-shapes by the hexagons whose centres they hold, else by that of a point inside."""
    shapes = _ells(spark, sf_dir).withColumn("cents", F.round(F.col("price") * 100).cast("bigint"))
    return cells.hex_summary(shapes, HEX, ["cents"]).select("q", "r", "_count", "sum_cents")


@query(f"select distinct q, r, round((q + r / 2e0) * {_W}, 6) + 0e0 as x, r * {_H} as y, round({HEX.area!r}e0, 6) as area, 7 as n_points from ({_HEX_OF.format(q=_Q, r=_R, t=PTS)})")
def hex_cell_polygons(spark, sf_dir):
    q, r = HEX.cell_of_point(F.col("x"), F.col("y"))
    shape = fixtures.load(spark, sf_dir, "pts").select(q.alias("q"), r.alias("r")).distinct().withColumn("polygons", HEX.polygon(F.col("q"), F.col("r")))
    m = polygons.measures(F.col("polygons"))
    return shape.select("q", "r", (F.round(m["x"], 6) + 0.0).alias("x"), (F.round(m["y"], 6) + 0.0).alias("y"), F.round(m["area"], 6).alias("area"), F.size(F.get(F.get("polygons", 0), 0)).alias("n_points"))


@query(f"""select '/staged/vec/WGS1984Quad/5/' || x || '/' || y || '.gpkg' as path, '/staged/vec/WGS1984Quad/4/' || (x // 2) || '/' || (y // 2) || '.gpkg' as parent,
'/staged/vec/WGS1984Quad/6/' || (2 * x + a) || '/' || (2 * y + b) || '.gpkg' as child from {_TILES}, (values (0), (1)) p(a), (values (0), (1)) q(b)""")
def tile_path_family(spark, sf_dir):
    path = _PATHS.path(F.col("x"), F.col("y"), F.col("z"), "/staged", "vec", ".gpkg").alias("path")
    return _tiles(spark, sf_dir).select(path).select("path", _PATHS.parent_path(F.col("path")).alias("parent"), F.explode(_PATHS.child_paths(F.col("path"))).alias("child"))


@query("""select path, '/hex' || regexp_replace(path[6:], '[.][^./]*$', '') || '_h3r5.gpkg' as hex_path, '/foot' || regexp_replace(path[6:], '[^/]*$', '') || 'fp_' || regexp_extract(path, '([^/.]*)[^/]*$', 1) || '.shp' as footprint,
'fp_' || regexp_extract(path, '([^/]*)/[^/]*$', 1) || '.shp' as of_dir, case when path like '%.shp' then path else path || '.shp' end as name from (""" + fixtures.duck("main_paths") + ")")
def footprint_paths(spark, sf_dir):
    p = F.col("path")
    return fixtures.load(spark, sf_dir, "main_paths").select(
        "path", hex_runs.output_path(p, "/main", "hex", 5).alias("hex_path"), prep.footprint_path(p, "/main", "/foot", "fp_").alias("footprint"),
        prep.dir_to_filename(F.regexp_replace(p, "/[^/]*$", ""), "fp_").alias("of_dir"), prep.id_to_name(p, ".shp").alias("name"),
    )


@query("""with f as (select 'foot/' || s_suppkey || '.shp' as p, s_suppkey % 40 as k from supplier), d as (select case when p_partkey % 29 = 0 then p_size % 40 else 40 + p_partkey end as k, 'in/' || p_partkey as path from part),
m as (select p, case count(path) when 0 then 'no_match' when 1 then 'matched' else 'multiple_matches' end as status from f left join d using (k) group by p) select status, count(*) as n from m group by status""")
def footprint_status_counts(spark, sf_dir):
    return prep.status_counts(footprint_dir_match(spark, sf_dir))


@query(f"""with m as (select path, regexp_extract(path, '[^/]*$') as name from ({fixtures.duck('main_paths')})), p as (select path, regexp_extract(path, '[^/]*$') as name from ({fixtures.duck('preferred')}))
select (select count(*) from m) as n_main, (select count(distinct name) from m where name in (select name from p)) as n_replaced, (select count(*) from p) as n_preferred, (select count(*) from p where name not in (select name from m)) as n_unused""")
def preferred_report(spark, sf_dir):
    preferred = fixtures.load(spark, sf_dir, "preferred")
    return prep.replacement_report(prep.preferred_paths(fixtures.load(spark, sf_dir, "main_paths"), preferred), preferred)


@query(f"""select 'row' as side, cast({GRID.first_row_i + GRID.nrows - 1} - k as bigint) as i, {GRID.miny} + {GRID.height} * k / {GRID.nrows} as low, {GRID.cell_height}::double as size from (select unnest(range({GRID.nrows})) as k)
union all select 'column', cast({GRID.first_col_i} + k as bigint), {GRID.minx} + {GRID.width} * k / {GRID.ncols}, {GRID.cell_width}::double from (select unnest(range({GRID.ncols})) as k)""")
def grid_indices(spark, sf_dir):
    """The grid's indices from south and from west, with their lower fences and sizes."""
    rows = [("row", i, low, GRID.cell_height) for i, low in zip(GRID.row_indices, GRID.row_fences[:-1], strict=True)]
    cols = [("column", i, low, GRID.cell_width) for i, low in zip(GRID.col_indices, GRID.col_fences[:-1], strict=True)]
    return spark.createDataFrame(rows + cols, "side string, i long, low double, size double")


@query(f"select f.fid, {_NAME} as tile from {FEAT} f join {_LEVEL} t on {_ell_meets('f', 't')}")
def polygon_sjoin_tiles(spark, sf_dir):
    return level_of("WGS1984Quad", Z).sjoin(_ells(spark, sf_dir), "inner", as_tile=Z).select("fid", "tile")


@query(f"select fid, tile, sum(area) as area from (select f.fid, {_NAME} as tile, {_common_sql(_of(_LOW, 'f'), _of(_WHOLE, 't'))} + {_common_sql(_of(_TALL, 'f'), _of(_WHOLE, 't'))} as area from {FEAT} f join {_LEVEL} t on {_AREA}) where area > 0 group by all")
def polygon_overlay_tiles(spark, sf_dir):
    return level_of("WGS1984Quad", Z).overlay(_ells(spark, sf_dir).select("fid", "x0", "x1", "y0", "y1", "polygons"), as_tile=Z).select("fid", "tile", "area")


def entry(spark: SparkSession) -> DataFrame:
    """The flagship: features to tiles to the summary by file and tile, on the smallest tables."""
    return staging_summary(spark, "/root/testdata/sf0.001")
