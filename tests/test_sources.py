"""Vector files, the streaming ingest, runs by hexagon and the command line, on files made here."""

import struct

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tilewright import __main__ as cli
from tilewright.functions import paths, rings
from tilewright.plans import hex_runs, prep, staging
from tilewright.sources import vector
from tilewright.streaming import ingest

SQUARE = np.array([(0, 0), (0, 1), (1, 1), (1, 0), (0, 0)], float)  # clockwise
HOLE = np.array([(0.2, 0.2), (0.4, 0.2), (0.4, 0.4), (0.2, 0.4), (0.2, 0.2)], float)


def shapefile(records) -> bytes:
    body = b""
    for n, parts in enumerate(records, 1):
        if parts is None:
            content = struct.pack("<i", 0)
        else:
            every = np.concatenate(parts)
            first = np.cumsum([0, *map(len, parts)])[:-1]
            content = struct.pack("<i4d2i", 5, *every.min(0), *every.max(0), len(parts), len(every)) + np.asarray(first, "<i4").tobytes() + every.astype("<f8").tobytes()
        body += struct.pack(">ii", n, len(content) // 2) + content
    return struct.pack(">i5ii", 9994, 0, 0, 0, 0, 0, (100 + len(body)) // 2) + struct.pack("<ii", 1000, 5) + bytes(64) + body


def dbf(rows, width=10) -> bytes:
    names = list(rows[0])
    head = struct.pack("<BBBBIHH", 3, 24, 1, 1, len(rows), 33 + 32 * len(names), 1 + width * len(names)) + bytes(20)
    head += b"".join(n.encode().ljust(11, b"\0") + b"C" + bytes(4) + bytes([width, 0]) + bytes(14) for n in names) + b"\r"
    return head + b"".join(b" " + b"".join(str(r[n]).encode().ljust(width) for n in names) for r in rows)


def test_shapefiles(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/one.shp").write_bytes(shapefile([[SQUARE, HOLE], [SQUARE + 5, SQUARE + 7], None]))
    (tmp_path / "a/one.dbf").write_bytes(dbf([{"name": "x", "size": 1.5}, {"name": "y", "size": 2}, {"name": "z", "size": 3}]))
    (tmp_path / "two.shp").write_bytes(shapefile([[SQUARE]]))
    (tmp_path / "bad.shp").write_bytes(shapefile([[SQUARE]])[:120])
    rows = vector.read_shp(spark, f"file://{tmp_path}").orderBy("input_path", "fid").collect()
    assert [(r.geom_type, r.error is None) for r in rows] == [("Polygon", True), ("MultiPolygon", True), (None, True), (None, False), ("Polygon", True)]
    assert rows[0].attributes == {"name": "x", "size": "1.5"} and rows[4].attributes == {}
    assert [len(r) for r in rings.from_wkb(bytes(rows[0].geometry))[0]] == [5, 5] and len(rings.from_wkb(bytes(rows[1].geometry))) == 2
    boxes = vector.as_boxes(vector.read_shp(spark, f"file://{tmp_path}/a"))
    assert sorted((r.x0, r.y1) for r in boxes.collect()) == [(0, 1), (5, 6), (7, 8)]
    out = f"file://{tmp_path}/out"
    (tmp_path / "settings.json").write_text('{"z": 4}')
    assert cli.main(["--config", str(tmp_path / "settings.json"), "--input", f"file://{tmp_path}/a", "--output", out, "--hex-res", "3", "--sum-cols", "size"], spark) == 0
    tiles = spark.read.parquet(f"{out}/tiles")
    areas = {r.fid: round(r.staging_area, 9) for r in tiles.where("staging_centroid_within_tile").collect()}
    assert areas == {0: 0.96, 1: 2.0}  # a hole, and a MultiPolygon as one feature
    assert spark.read.parquet(f"{out}/hexagons").agg(F.sum("_count")).first()[0] >= 2
    assert spark.read.parquet(f"{out}/hex_log").first().ok


def test_geopackages(spark, tmp_path):
    df = spark.createDataFrame([("t1", 1.5, bytearray(rings.to_wkb([SQUARE]))), ("t1", None, None), ("t2", 2.0, bytearray(rings.to_wkb([SQUARE + 1, HOLE + 1])))], "tile string, size double, geometry binary")
    log = vector.write_gpkg(df, f"file://{tmp_path}/g", "tile").collect()
    assert sorted((r.tile, r.n) for r in log) == [("t1", 2), ("t2", 1)]
    (tmp_path / "g/bad.gpkg").write_bytes(b"no database")
    back = vector.read_gpkg(spark, f"file://{tmp_path}/g").orderBy("geom_type", F.col("attributes")["size"]).collect()
    assert sorted((r.geom_type or "", (r.attributes or {}).get("tile") or "", r.error is None) for r in back) == [("", "", False), ("", "t1", True), ("Polygon", "t1", True), ("Polygon", "t2", True)]
    assert vector.gpkg_bytes("l", pd.DataFrame({"g": [None]}), "g", 4326)[:6] == b"SQLite"
    files = vector.list_files(spark, f"file://{tmp_path}/g", ".gpkg")
    assert files.count() == 3 and vector.existing(files.select("path").limit(1), files).count() == 1
    p = paths.TilePaths()
    some = spark.createDataFrame([("s/vec/WGS1984Quad/5/1/2.gpkg",), ("s/vec/WGS1984Quad/6/1/2.gpkg",)], "path string")
    assert vector.at_level(some, p.tile_of(F.col("path")), 5).count() == 1


PRJ_3413 = 'PROJCS["WGS_1984_NSIDC_Sea_Ice_Polar_Stereographic_North",GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984"]],PROJECTION["Stereographic_North_Pole"]]'


def test_prj():
    assert vector.srid_of_prj('PROJCS["WGS_1984_UTM_Zone_6N",GEOGCS["x"]]') == 32606 and vector.srid_of_prj('PROJCS["WGS 84 / UTM zone 33S",GEOGCS["x"]]') == 32733
    assert vector.srid_of_prj(PRJ_3413) == 3413 and vector.srid_of_prj('GEOGCS["GCS_WGS_1984",DATUM["D"]]') == 4326 and vector.srid_of_prj("junk") is None
    assert vector.srid_of_prj('PROJCS["x",GEOGCS["WGS 84",AUTHORITY["EPSG","4326"]],AUTHORITY["EPSG","3857"]]') == 3857
    assert vector.srid_of_prj('PROJCS["x",GEOGCS["WGS 84",AUTHORITY["EPSG","4326"]],UNIT["m",1]]') is None


def test_polar_geopackage(spark, tmp_path):
    """A file in polar stereographic coordinates: its own CRS is read, and every vertex is moved."""
    side = 20_000.0
    ring = np.array([(0, 0), (side, 0), (side, side), (0, side), (0, 0)]) + [500_000, -1_200_000]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/one.gpkg").write_bytes(vector.gpkg_bytes("layer", pd.DataFrame({"geometry": [rings.to_wkb([ring])], "size": [1.0]}), "geometry", 3413))
    (tmp_path / "land").mkdir()
    (tmp_path / "land/l.gpkg").write_bytes(vector.gpkg_bytes("layer", pd.DataFrame({"geometry": [rings.to_wkb([ring * 1.0 + [side / 2, 0]])]}), "geometry", 3413))
    (tmp_path / "foot").mkdir()
    (tmp_path / "foot/one.gpkg").write_bytes(vector.gpkg_bytes("layer", pd.DataFrame({"geometry": [rings.to_wkb([ring + 10 * side])], "rank": [1]}), "geometry", 3413))
    (tmp_path / "settings.json").write_text('{"z": 6, "clip_to_footprint": true, "dedup_method": "neighbor", "deduplicate_at": "later", "keep_rules": [["rank", "larger"]], "simplify_tolerance": 1.0}')
    uri, out = (f"file://{tmp_path}/{x}" for x in ("in", "out"))
    args = ["--config", str(tmp_path / "settings.json"), "--input", uri, "--output", out, "--format", "gpkg", "--hex-res", "6", "--sum-cols", "size", "--gpkg"]
    assert cli.main([*args, "--footprints", f"file://{tmp_path}/foot", "--land-polygons", f"file://{tmp_path}/land"], spark) == 0
    rows = spark.read.parquet(f"{out}/tiles").collect()
    assert len(rows) >= 1 and all(r.staging_duplicated for r in rows)  # the footprint is elsewhere
    r = rows[0]
    corners = np.array([(p.x, p.y) for p in r.polygons[0][0]])
    lon = np.degrees(np.arctan2(ring[:, 0], -ring[:, 1])) - 45
    assert np.allclose(corners[:, 0], lon) and r.x0 < r.x1 and np.isclose(r.x0, lon.min()) and 77 < r.y0 < r.y1 < 80
    cells_ = spark.read.parquet(f"{out}/hexagons")
    covered, land = cells_.agg(F.sum("area_km2"), F.sum("land_area_km2")).first()
    assert 350 < covered < 450 and 0 < land and len(cells_.first().polygons[0][0]) == 7
    assert vector.read_gpkg(spark, f"{out}/gpkg").where("srid = 4326").count() == len(rows) and vector.read_gpkg(spark, f"{out}/hex_gpkg").where("srid = 6933").count() == cells_.count()


def test_torn_batch(spark, tmp_path):
    """A batch that crashed after its rows and before its summary is written again without adding them twice."""
    path, config = f"file://{tmp_path}", staging.StagingConfig(z=4)
    box = "fid int, x0 double, y0 double, x1 double, y1 double"
    stage = lambda *rows: staging.stage(spark.createDataFrame(rows, box), config, F.lit("f"), identifier=F.col("fid").cast("string"))
    staging.save_tiles(stage((1, 1.0, 1.0, 2.0, 2.0)), path, config, batch_id="a")
    two = stage((2, 1.5, 1.5, 2.5, 2.5), (3, 50.0, 50.0, 51.0, 51.0))
    staging.save_tiles(two, path, config, batch_id="b")
    before = sorted((r.fid, r.tile_x, r.staging_batch) for r in spark.read.parquet(f"{path}/tiles").collect())
    kept = [tuple(r) for r in spark.read.parquet(f"{path}/summary").where("batch_id = 'a'").collect()]
    spark.createDataFrame(kept, spark.read.parquet(f"{path}/summary").schema).write.parquet(f"{path}/s2")
    import shutil

    shutil.rmtree(tmp_path / "summary")
    shutil.move(tmp_path / "s2", tmp_path / "summary")
    for _ in range(2):  # the second time the summary tells that it is done
        staging.save_tiles(two, path, config, batch_id="b")
        assert sorted((r.fid, r.tile_x, r.staging_batch) for r in spark.read.parquet(f"{path}/tiles").collect()) == before
    assert spark.read.parquet(f"{path}/summary").groupBy("batch_id").count().count() == 2


def test_streaming(spark, tmp_path):
    src, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    box = "fid int, x0 double, y0 double, x1 double, y1 double"
    config = staging.StagingConfig(z=4)
    stage = lambda df: staging.stage(df, config, F.lit("f"), identifier=F.col("fid").cast("string"))
    for k in range(2):
        spark.createDataFrame([(k, 1.0 + k, 1.0, 2.0 + k, 2.0)], box).write.mode("append").parquet(src)
        stream = spark.readStream.schema(box).parquet(src)
        q = ingest.ingest(stream, out, config, f"{tmp_path}/check", stage, once=True)
        q.awaitTermination(120)
        assert q.exception() is None
    assert spark.read.parquet(f"{out}/tiles").select("fid").distinct().count() == 2
    assert ingest.done_before(spark, out, "stream-0") and not ingest.done_before(spark, out, "stream-9") and not ingest.done_before(spark, f"{out}/none", "x")


def test_runs_and_records(spark, tmp_path):
    rows = [("/d/in/a/x.shp", 0.0, 0.0, 1.0, 1.0, 2.0, None), ("/d/in/bad.shp", None, None, None, None, None, "boom"), ("/d/in/none.shp", None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "input_path string, x0 double, y0 double, x1 double, y1 double, size double, error string")
    summary, log = hex_runs.stage_all(df, 4, ["size"], ["size"])
    assert {r.input_path[-8:]: (r.ok, r.error) for r in log.collect()} == {"/a/x.shp": (True, None), "/bad.shp": (False, "boom"), "none.shp": (False, "no features")}
    assert summary.agg(F.min("sum_size")).first()[0] == 2.0 and summary.select("area_km2").first()[0] > 0
    of = lambda path, root: spark.range(1).select(hex_runs.output_path(F.lit(path), root, "hex", 4)).first()[0]
    assert of("/d/in/a/x.shp", "/d/in") == "/d/hex/a/x_h3r4.gpkg" and of("/other/x.shp", "/d/in") == "/d/hex/x_h3r4.gpkg"
    prep.write_by_status(spark.createDataFrame([("a", "matched"), ("b", "no_match")], "p string, status string"), f"file://{tmp_path}/s")
    assert spark.read.json(f"file://{tmp_path}/s/matched").count() == 1
    prep.split_by_name(spark.createDataFrame([("n1", 1), ("n2", 2), (None, 3)], "Name string, v int"), f"file://{tmp_path}/n")
    assert spark.read.parquet(f"file://{tmp_path}/n").count() == 2
    (tmp_path / "t.csv").write_text("a,b\n1,x\n2,y\n")
    staging.csv_to_parquet(spark, f"file://{tmp_path}/t.csv", f"file://{tmp_path}/t")
    assert spark.read.parquet(f"file://{tmp_path}/t").agg(F.sum("a")).first()[0] == 3
    first = prep.in_first_order(spark.createDataFrame([("k", 2), ("k", 1)], "k string, v int"), "k", "v")
    assert first.first().v == 1
