"""Features derived from the driver's tables, which hold no geometry.

Coordinates are multiples of 1/64, so that areas and sums are exact in any order. The same text serves
Spark and DuckDB; ``{S}`` is the string type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_SQL = {
    "feat": """select o_orderkey as fid, concat('file_', cast(o_orderkey % 4 as {S}), '.shp') as filename, o_orderdate as dt, o_totalprice as price,
  cx - hw as x0, cx + hw as x1, cy - hh as y0, cy + hh as y1, cx, cy, 4 * hw * hh as area,
  case when o_orderkey % 13 = 0 then null when o_orderkey % 11 = 0 then 'Point' when o_orderkey % 5 = 0 then 'MultiPolygon' else 'Polygon' end as geom_type
from (select *, cast((o_orderkey * 7919) % 20480 as double) / 64 - 160 as cx, cast((o_custkey * 6151 + o_orderkey * 31) % 8960 as double) / 64 - 70 as cy,
  cast(1 + (o_orderkey % 32) as double) / 64 * 4 as hw, cast(1 + (o_custkey % 24) as double) / 64 * 4 as hh from orders) q""",
    "footprint": """select concat('file_', cast(k as {S}), '.shp') as filename, cast(-160 + k * 60 as double) as x0, cast(-160 + k * 60 + 120 as double) as x1,
  -75e0 as y0, 75e0 as y1, cast(2019 + (k * 3) % 4 as int) as yr from (select distinct o_orderkey % 4 as k from orders) t""",
    "pts": """select event_id as fid, user_id, event_type, value, cast((event_id * 7919) % 23040 as double) / 64 - 180 as x,
  cast((event_id * 104729 + user_id * 31) % 11520 as double) / 64 - 90 as y from events""",
    "land": """select n_nationkey as land_id, -180 + 70e0 * (n_nationkey % 5) as x0, -100 + 70e0 * (n_nationkey % 5) as x1,
  -80 + 32e0 * floor(n_nationkey / 5e0) as y0, -56 + 32e0 * floor(n_nationkey / 5e0) as y1 from nation""",
    "main_paths": """select concat('/main/', p_brand, '/img_', cast(p_partkey as {S}), '.shp') as path from part
union all select concat('/main/dup/img_', cast(p_partkey as {S}), '.shp') as path from part where p_partkey % 50 = 0""",
    "preferred": "select concat('/water/img_', cast(p_partkey as {S}), '.shp') as path from part where p_partkey % 7 = 0",
}
_SOURCE = {"feat": "orders", "footprint": "orders", "pts": "events", "land": "nation", "main_paths": "part", "preferred": "part"}


def duck(name: str) -> str:
    return _SQL[name].replace("{S}", "varchar")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source = _SOURCE[name]
    text = _SQL[name].replace("{S}", "string").replace(f"from {source}", "from {source}")
    return spark.sql(text, source=spark.read.parquet(f"{sf_dir}/{source}.parquet"))


def files(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """``feat`` dealt to n files instead of four."""
    return load(spark, sf_dir, "feat").selectExpr("fid", f"concat('file_', cast(fid % {n} as string), '.shp') as filename", "price", "x0", "x1", "y0", "y1", "cx", "cy", "area")
