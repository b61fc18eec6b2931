"""The scalar functions under SQL names, as SQL functions of the session: they are inlined, not Python UDFs."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators.grid import TILE_MATRIX_SETS

_WORLD = TILE_MATRIX_SETS["WGS1984Quad"]["bounds"]
_SPAN = f"({_WORLD[3] - _WORLD[1]}D / pow(2, z))"

FUNCTIONS = {
    "tw_tile_text": ("x bigint, y bigint, z int", "string", "format_string('Tile(x=%d, y=%d, z=%d)', x, y, z)"),
    "tw_tile_x": ("t string", "bigint", "cast(nullif(regexp_extract(t, 'x=([0-9]+)', 1), '') as bigint)"),
    "tw_tile_y": ("t string", "bigint", "cast(nullif(regexp_extract(t, 'y=([0-9]+)', 1), '') as bigint)"),
    "tw_tile_z": ("t string", "int", "cast(nullif(regexp_extract(t, 'z=([0-9]+)', 1), '') as int)"),
    "tw_parent_x": ("x bigint", "bigint", "shiftright(x, 1)"),
    "tw_tile_column": ("lon double, z int", "bigint", f"cast(ceil((lon - ({_WORLD[0]}D)) / {_SPAN}) - 1 as bigint)"),
    "tw_tile_row": ("lat double, z int", "bigint", f"cast(floor(({_WORLD[3]}D - lat) / {_SPAN}) as bigint)"),
    "tw_box_area": ("x0 double, y0 double, x1 double, y1 double", "double", "(x1 - x0) * (y1 - y0)"),
    "tw_box_meets": ("ax0 double, ay0 double, ax1 double, ay1 double, bx0 double, by0 double, bx1 double, by1 double", "boolean", "ax0 <= bx1 and bx0 <= ax1 and ay0 <= by1 and by0 <= ay1"),
    "tw_box_shared_area": ("ax0 double, ay0 double, ax1 double, ay1 double, bx0 double, by0 double, bx1 double, by1 double", "double", "greatest(least(ax1, bx1) - greatest(ax0, bx0), 0D) * greatest(least(ay1, by1) - greatest(ay0, by0), 0D)"),
    "tw_base_name": ("path string", "string", "substring_index(substring_index(path, '/', -1), '.', 1)"),
}


def register(spark: SparkSession) -> list[str]:
    """Makes the functions known to the session; returns their names."""
    for name, (arguments, result, body) in FUNCTIONS.items():
        spark.sql(f"create or replace temporary function {name}({arguments}) returns {result} return {body}")
    return list(FUNCTIONS)
