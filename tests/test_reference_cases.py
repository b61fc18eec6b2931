"""The documented small cases, through our interface, and the edge rules around them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.functions import crs, paths, rings
from tilewright.functions.box import Box
from tilewright.operators import cells, dedup
from tilewright.operators.grid import COLUMN, ROW, Grid, children, level_of, parent, tms_grids
from tilewright.plans import prep, staging

BOX = "x0 double, y0 double, x1 double, y1 double"


def boxes(spark, rows, more=""):
    return spark.createDataFrame(rows, more + BOX)


def test_clip_labels(spark):
    features = boxes(spark, [("a", 1.0, 1.0, 2.0, 2.0), ("b", 20.0, 20.0, 21.0, 21.0)], "prop string, ")
    edge = boxes(spark, [(0.0, 0.0, 10.0, 10.0), (0.0, 0.0, 5.0, 5.0)])
    out = dedup.clip_to_boundary(features, edge, label="dup", key="prop")
    assert {r.prop: r.dup for r in out.collect()} == {"a": False, "b": True}
    assert dedup.clip_to_boundary(features, edge, label="dup", key="prop", dedupe_matches=False).where("prop = 'a'").count() == 2
    assert dedup.clip_to_boundary(features, edge.limit(0), label="dup", key="prop").where("dup").count() == 2
    with pytest.raises(ValueError):
        dedup.clip_to_boundary(features, edge, "equals")
    assert dedup.clip_to_footprint(features, edge).columns == features.columns


def test_label_merge(spark):
    out = dedup.label_duplicates(boxes(spark, [(1, 0.0, 0.0, 1.0, 1.0)], "a int, "), boxes(spark, [(2, 1.0, 1.0, 2.0, 2.0)], "a int, "), "dup")
    assert {r.a: r.dup for r in out.collect()} == {1: False, 2: True}


def test_neighbours(spark):
    rows = [("A", 0.0, 0.0, 2.0, 2.0), ("B", 1.0, 1.0, 2.5, 2.5), (None, 0.0, 0.0, 2.0, 2.0)]
    df = boxes(spark, rows, "source string, ").withColumn("fid", F.coalesce("source", F.lit("none")))
    how = {"overlap_tolerance": 0.2, "overlap_both": False}
    out = dedup.deduplicate_neighbors(df, "source", [("area_", "larger")], **how)
    assert {r.fid: r.staging_duplicated for r in out.collect()} == {"A": False, "B": True, "none": False}
    assert not dedup.deduplicate_neighbors(df, "source", [("area_", "larger")], 0.5, False).where("staging_duplicated").count()
    tied = dedup.deduplicate_neighbors(df.withColumn("k", F.lit(1)), "source", [("k", "larger")], **how)
    assert [r.fid for r in tied.where("staging_duplicated").collect()] == ["B"]
    null = df.withColumn("k", F.when(F.col("source") == "A", 1))
    assert not dedup.deduplicate_neighbors(null, "source", [("k", "larger")], **how).where("staging_duplicated").count()
    touching = boxes(spark, [("A", 0.0, 0.0, 1.0, 1.0), ("B", 1.0, 0.0, 2.0, 1.0)], "fid string, ")
    assert not dedup.deduplicate_neighbors(touching, "fid", [("area_", "larger")], None).where("staging_duplicated").count()
    for bad in ({"split_by": None, "keep_rules": [("a", "larger")]}, {"split_by": "source", "keep_rules": []}, {"split_by": "source", "keep_rules": [("a", "larger")], "crs": None}):
        with pytest.raises(ValueError):
            dedup.deduplicate_neighbors(df, **bad)


def test_greedy_turns_match_a_plain_loop(spark):
    rng = np.random.default_rng(5)
    rows = [(k, f"f{k % 5}", float(x), float(y), float(x + w), float(y + h), float(p)) for k, (x, y, w, h, p) in enumerate(rng.uniform(0, 1, (250, 5)) * [10, 10, 2, 2, 9])]
    df = spark.createDataFrame(rows, "fid long, g string, x0 double, y0 double, x1 double, y1 double, p double")
    gone = set()
    for a in sorted({r[1] for r in rows}):
        for b in sorted({r[1] for r in rows}):
            lose = set()
            for r in (r for r in rows if a < b and r[1] == a and r[0] not in gone):
                for s in (s for s in rows if s[1] == b and s[0] not in gone):
                    w, h = min(r[4], s[4]) - max(r[2], s[2]), min(r[5], s[5]) - max(r[3], s[3])
                    if w > 0 and h > 0 and (w * h > 0.2 * (r[4] - r[2]) * (r[5] - r[3]) or w * h > 0.2 * (s[4] - s[2]) * (s[5] - s[3])):
                        lose.add(r[0] if s[6] > r[6] else s[0])
            gone |= lose
    out = dedup.deduplicate_neighbors(df, "g", [("p", "larger")], 0.2, False)
    assert {r.fid for r in out.where("staging_duplicated").collect()} == gone and gone


@pytest.mark.parametrize("groups", [3, 5])
def test_boxes_that_lie_on_one_another_write_no_table_of_all_pairs(spark, monkeypatch, groups):
    rng = np.random.default_rng(groups)
    rows = [(k, f"f{k % groups}", float(x), float(y), float(x + w), float(y + h), float(p)) for k, (x, y, w, h, p) in enumerate(rng.uniform(0, 1, (240, 5)) * [2, 2, 1, 1, 9] + [0, 0, 2, 2, 0])]
    df = spark.createDataFrame(rows, "fid long, g string, x0 double, y0 double, x1 double, y1 double, p double")
    gone = set()
    for a in range(groups):
        for b in range(a + 1, groups):
            lose = set()
            for r in (r for r in rows if r[0] % groups == a and r[0] not in gone):
                for s in (s for s in rows if s[0] % groups == b and s[0] not in gone):
                    w, h = min(r[4], s[4]) - max(r[2], s[2]), min(r[5], s[5]) - max(r[3], s[3])
                    areas = [(t[4] - t[2]) * (t[5] - t[3]) for t in (r, s)]
                    if w > 0 and h > 0 and w * h > 0.3 * min(areas):
                        lose.add(r[0] if s[6] > r[6] else s[0])
            gone |= lose
    written = []
    cut = dedup.cut
    monkeypatch.setattr(dedup, "cut", lambda df: written.append(cut(df)) or written[-1])
    out = dedup.deduplicate_neighbors(df, "g", [("p", "larger")], 0.3, False)
    assert {r.fid for r in out.where("staging_duplicated").collect()} == gone and gone
    assert max(w.count() for w in written) <= 4 * len(rows)


def test_footprints(spark):
    foot = boxes(spark, [("a", 2020, 0.0, 0.0, 10.0, 10.0), ("b", 2021, 10.0, 0.0, 20.0, 10.0)], "filename string, yr int, ")
    rows = [(1, "a", False, 9.0, 1.0, 11.0, 2.0), (2, "a", None, 1.0, 1.0, 2.0, 2.0), (3, "b", True, 15.0, 1.0, 16.0, 2.0), (4, "c", False, 10.0, 1.0, 11.0, 2.0)]
    df = boxes(spark, rows, "fid int, filename string, staging_duplicated boolean, ")
    out = dedup.deduplicate_by_footprint(df, foot, keep_rules=[("yr", "larger")])
    assert {r.fid: r.staging_duplicated for r in out.collect()} == {1: True, 2: False, 3: True, 4: False}
    assert dedup.deduplicate_by_footprint(df, foot.limit(0), keep_rules=[("yr", "larger")]).where("staging_duplicated").count() == 1
    with pytest.raises(KeyError):
        dedup.deduplicate_by_footprint(df.drop("staging_duplicated"), foot)


def test_grid_points(spark):
    grid = Grid((0, 0, 10, 10), 2, 2, 3857)
    pts = spark.createDataFrame([(1.0, 1.0), (9.0, 9.0), (0.0, 5.0), (5.0, 5.0), (10.0, 10.0), (None, 1.0)], "x double, y double")
    got = [(r[ROW], r[COLUMN]) for r in grid.sjoin_points(pts, crs=3857).collect()]
    assert got == [(1, 0), (0, 1), (None, None), (1, 0), (0, 1), (None, None)]
    assert grid.sjoin_points(pts, "right").count() == 6
    assert grid.row_indices == [1, 0] and grid.col_fences == [0, 5, 10] and grid.with_size(20).maxx == 20 and grid.cell_area == 25
    for bad in ((TypeError, {"bounds": (0, 0, 1)}), (TypeError, {"nrows": 1.5}), (ValueError, {"ncols": 0}), (TypeError, {"left_to_right": 1}), (ValueError, {"crs": 1}), (ValueError, {"bounds": (0, 0, 0, 1)})):
        with pytest.raises(bad[0]):
            Grid(**({"bounds": (0, 0, 10, 10), "nrows": 2, "ncols": 2} | bad[1]))
    with pytest.raises(ValueError):
        grid.sjoin_points(pts, how="outer")
    degrees = spark.createDataFrame([(1.0 / 111319.49079327358, 1e-5)], "x double, y double")
    assert [(r[ROW], r[COLUMN]) for r in grid.sjoin_points(degrees, crs=4326).collect()] == [(1, 0)]  # reprojected
    b = boxes(spark, [(0.0, 0.0, 1.0, 1.0)])
    with pytest.raises(ValueError):
        grid.sjoin(b, predicate_="equals")
    with pytest.raises(NotImplementedError):
        grid.overlay(b, "difference")
    with pytest.raises(ValueError):
        grid.overlay(b, "other")


def test_overlay_areas(spark):
    grid = Grid((0, 0, 10, 10), 4, 5)
    rng = np.random.default_rng(4)
    rows = [(k, float(x), float(y), float(x + w), float(y + h)) for k, (x, y, w, h) in enumerate(rng.uniform(0.1, 1, (40, 4)) * [12, 12, 4, 4] - [1, 1, 0, 0])]
    df = boxes(spark, rows, "fid int, ")
    area = lambda how: grid.overlay(df, how).agg(F.sum("area")).first()[0]
    total = df.agg(F.sum(Box().area)).first()[0]
    assert abs(area("identity") - total) < 1e-9
    n = 400
    xs = (np.arange(n) + 0.5) * 10 / n
    free = np.ones((n, n), bool)
    for _, a, b, c, d in rows:
        free &= ~(((xs > a) & (xs < c))[:, None] & ((xs > b) & (xs < d))[None, :])
    left = area("union") - area("identity")
    assert abs(left - free.mean() * 100) < 0.5 and abs(area("symmetric_difference") - left - (area("identity") - area("intersection"))) < 1e-9


def test_tiles(spark):
    (grid,) = tms_grids("WebMercatorQuad", 4, (-1e6, -1e6, 1e6, 1e6))
    assert (grid.first_col_i, grid.ncols, grid.first_row_i, grid.nrows) == (7, 2, 7, 2)
    df = spark.createDataFrame([(0.0, 0.0)], "x double, y double")
    row, col = grid.indices_from_xy(F.col("x"), F.col("y"))
    assert df.select(paths.tile_text(col, row, F.lit(4))).first()[0] == "Tile(x=7, y=8, z=4)"
    assert len(tms_grids("WGS1984Quad", 3, (170, -10, -170, 10))) == 2
    (one,) = tms_grids("WGS1984Quad", 3, (0, 0, 22.5, 22.5))  # exact edges pull no neighbour in
    assert (one.ncols, one.nrows, one.first_col_i, one.first_row_i) == (1, 1, 8, 3)
    with pytest.raises(ValueError):
        level_of("nope", 1)
    t = spark.range(64).selectExpr("id as x", "id % 7 as y").withColumn("c", F.explode(children(F.col("x"), F.col("y"), F.lit(6))))
    px, py, pz = parent(F.col("c.x"), F.col("c.y"), F.col("c.z"))
    assert t.where((px == F.col("x")) & (py == F.col("y")) & (pz == 6)).count() == 256


def test_paths(spark):
    p = paths.TilePaths("WebMercatorQuad", ("style", "tms", "z", "x", "y"))
    p.add_base_dir("staged", "tmp", ".gpkg")
    assert p.get_base_dir("staged") == {"path": "tmp", "ext": ".gpkg"} and p.get_base_dir("other") is None
    for error, args in ((ValueError, ("staged", "x", "y")), (TypeError, (1, "x", "y"))):
        with pytest.raises(error):
            p.add_base_dir(*args)
    row = spark.range(1).select(p.path(F.lit(10), F.lit(12), F.lit(5), "/tmp/a/", "vec", ".gpkg").alias("path"))
    assert row.first().path == "/tmp/a/vec/WebMercatorQuad/5/10/12.gpkg"
    back = row.select(*[v.alias(k) for k, v in p.parse(F.col("path")).items()], p.tile_of(F.col("path")).alias("t")).first().asDict()
    assert back.pop("t").asDict() == {"x": 10, "y": 12, "z": 5}
    assert back == {"base_dir": "/tmp/a", "style": "vec", "tms": "WebMercatorQuad", "z": 5, "x": 10, "y": 12, "ext": ".gpkg"}
    assert spark.range(1).select(p.tile_of(F.lit("Tile(x=1, y=2, z=3)"))).first()[0].asDict() == {"x": 1, "y": 2, "z": 3}
    assert spark.range(1).select(p.path(F.lit(1), F.lit(2), F.lit(3))).first()[0] == "WebMercatorQuad/3/1/2"
    for error, args in ((ValueError, ("x",)), (TypeError, (1,)), (ValueError, ("WGS1984Quad", ("z", "x"))), (ValueError, ("WGS1984Quad", ("x", "z", "x", "y"))), (TypeError, ("WGS1984Quad", "zxy")), (ValueError, ("WGS1984Quad", ("q", "z", "x", "y")))):
        with pytest.raises(error):
            paths.TilePaths(*args)


def test_preparation_text(spark):
    r = spark.range(1).select(prep.base_name(F.lit("/a/b/c_d_e_f.tar.gz")), prep.id_of_path(F.lit("/a/b/c_d_e_f.tar.gz")), prep.date_of_id(F.lit("c_2020_e")), prep.subdir_of_footprint(F.lit("x/foot_a.shp"), "foot_", "_iwp")).first()
    assert tuple(r) == ("c_d_e_f", "c_d", "2020", "a_iwp")


def test_projections(spark):
    """Against published and independently known values, and there and back."""
    df = spark.createDataFrame([(-150.0, 70.0), (0.0, 0.0), (10.0, -45.5), (179.0, 80.0)], "x double, y double").coalesce(1)
    codes = [*[c for c in crs.CODES if c not in crs.UTM], 32601, 32633, 32760]
    pairs = [F.struct(*[v.alias(n) for n, v in zip("xy", crs.reproject(*crs.reproject(F.col("x"), F.col("y"), 4326, c), f"EPSG:{c}", 4326), strict=True)]).alias(f"c{c}") for c in codes]
    for r in df.select("x", "y", *pairs).collect():
        for c in codes:
            polar, utm = crs.POLAR.get(c), c in crs.UTM
            if (polar and (r.y <= 0) == (polar[0] > 0)) or (utm and abs((r.x - (c % 100 * 6 - 183) + 180) % 360 - 180) > 30):
                continue
            got = r[f"c{c}"]
            assert abs((got.x - r.x + 180) % 360 - 180) < 1e-7 and abs(got.y - r.y) < 1e-7, (c, r, got)
    at = lambda x, y, code: df.limit(1).select(*crs.reproject(F.lit(x), F.lit(y), 4326, code)).first()
    assert abs(at(180.0, 0.0, 6933)[0] - 17367530.445) < 0.01 and abs(at(0.0, 85.0445664, 6933)[1] - 7314540.83) < 2
    assert abs(at(180.0, 0.0, 3857)[0] - 20037508.342789) < 1e-5
    assert abs(at(-45.0, 70.0, 3413)[1] + 2187000) < 50000
    assert np.allclose(at(15.0, 60.0, 32633), (500000, 6651411.190), atol=0.01) and np.allclose(at(15.0, 0.0, 32733), (500000, 1e7), atol=0.01)
    assert np.allclose(at(0.0, 90.0, 5041), (2e6, 2e6), atol=1e-3) and np.allclose(at(0.0, -90.0, 5042), (2e6, 2e6), atol=1e-3)
    for code, lat in ((3413, 70.0), (3995, 71.0), (3031, -71.0), (3976, -70.0)):  # true to scale there
        (ax, ay), (bx, by) = (at(x, lat, code) for x in (20.0, 20.001))
        parallel = np.radians(0.001) * crs.RADIUS * np.cos(np.radians(lat)) / np.sqrt(1 - crs.E2 * np.sin(np.radians(lat)) ** 2)
        assert abs(np.hypot(bx - ax, by - ay) / parallel - 1) < 1e-6
    assert at(90.0, 80.0, 3995)[0] > 1e6 and at(90.0, -80.0, 3031)[0] > 1e6 and at(0.0, -80.0, 3031)[1] > 1e6 > 0 > at(0.0, 80.0, 3995)[1]
    with pytest.raises(ValueError):
        crs.code("EPSG:9999")


def test_rings(spark):
    rng = np.random.default_rng(3)
    for _ in range(30):
        a, b = ([np.array([(x, y), (x + w, y), (x + w, y + h), (x + w / 2, y + h / 2), (x, y + h), (x, y)])] for x, y, w, h in rng.uniform(0, 1, (2, 4)) + [0, 0, 0.2, 0.2])
        xs = (np.arange(600) + 0.5) * 2.5 / 600
        inside = lambda r: np.array([[_in((x, y), r[0]) for x in xs[::6]] for y in xs[::6]])  # noqa: E731, B023
        assert abs(rings.overlap_area(a, b) - (inside(a) & inside(b)).mean() * 6.25) < 0.02
    hole = [np.array([(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], float), np.array([(1, 1), (1, 2), (2, 2), (2, 1), (1, 1)], float)]
    as_rows = [[{"x": float(x), "y": float(y)} for x, y in r] for r in hole]
    df = spark.createDataFrame([(as_rows, bytearray(rings.to_wkb(hole)))], f"rings {rings.RINGS}, wkb binary")
    r = df.select(rings.area(F.col("rings")), *rings.centroid(F.col("rings")), rings.geometry_type(F.col("wkb")), rings.wkb_rings(F.col("wkb")), rings.area_in_box(F.col("rings"), *map(F.lit, (0.0, 0.0, 2.0, 2.0))), rings.shared_area(F.col("rings"), F.col("rings"))).first()
    assert r[0] == 15 and abs(r[1] - (32 - 1.5) / 15) < 1e-12 and r[3] == "Polygon" and r[4][0] == [[(p["x"], p["y"]) for p in q] for q in as_rows]
    assert r[5] == 3 and abs(r[6] - 15) < 1e-9
    line = np.array([(0, 0), (1, 0.01), (2, 0), (2, 2), (0, 2), (0, 0)], float)
    assert len(rings.simplify_ring(line, 0.1)) == 5 and len(rings.simplify_ring(line, 10)) == 6


def _in(p, r):
    x, y = r[:-1, 0], r[:-1, 1]
    x2, y2 = r[1:, 0], r[1:, 1]
    c = (y > p[1]) != (y2 > p[1])
    return np.count_nonzero(c & (p[0] < x + (p[1] - y) / np.where(y2 == y, 1, y2 - y) * (x2 - x))) % 2 == 1


def test_cells(spark):
    h = cells.PlanarHex(1.0)
    rng = np.random.default_rng(1)
    pts = spark.createDataFrame([tuple(map(float, p)) for p in rng.uniform(-9, 9, (300, 2))], "x double, y double")
    q, r = h.cell_of_point(F.col("x"), F.col("y"))
    far = [np.hypot(p.x - p.cx, p.y - p.cy) for p in pts.select("x", "y", *[v.alias(n) for v, n in zip(h.centre(q, r), ("cx", "cy"), strict=True)]).collect()]
    assert max(far) <= 1 + 1e-9
    b = boxes(spark, [(1, -3.0, -2.0, 4.0, 5.0), (2, 0.1, 0.1, 0.2, 0.2)], "fid int, ")
    out = cells.hex_summary(b, h, ["fid"], ["fid"], True, 1.0)
    assert out.where("_count = 2").count() == 1 and out.agg(F.sum("area_km2")).first()[0] <= 49.01
    with pytest.raises(ValueError):
        cells.valid_resolution("0")
    assert cells.valid_resolution("15") == 15


def test_staging(spark, tmp_path):
    b = boxes(spark, [(1, "f", 9.0, 0.5, 0.5, 1.0, 1.0), (2, "g", 5.0, 0.6, 0.6, 1.1, 1.1), (3, "g", 1.0, 40.0, 40.0, 41.0, 41.0)], "fid int, file string, price double, ")
    config = staging.StagingConfig(z=5, dedup_method="neighbor", keep_rules=(("price", "larger"),), overlap_tolerance=0.1)
    rows = staging.stage(b, config, F.col("file"), identifier=F.col("fid").cast("string"))
    path = f"file://{tmp_path}"
    staging.save_tiles(rows.where("fid <> 2"), path, config, batch_id="1")
    staging.save_tiles(rows.where("fid = 2"), path, config, batch_id="2")
    tiles = spark.read.parquet(f"{path}/tiles")
    assert sorted(r.fid for r in tiles.collect()) == [1, 3]
    staging.save_tiles(rows.where("fid = 3"), path, staging.StagingConfig(z=5), batch_id="3")
    assert spark.read.parquet(f"{path}/tiles").where("fid = 3").count() == 2 and spark.read.parquet(f"{path}/summary").select("batch_id").distinct().count() == 3
    assert staging.archive(rows).count() == 3
    with pytest.raises(ValueError):
        staging.check_names(rows.withColumnRenamed("staging_area", "Staging_AREA"), config)
    for bad in ({"dedup_method": "x"}, {"tms_id": "x"}, {"unknown": 1}):
        with pytest.raises(ValueError):
            staging.StagingConfig.load(bad)
    with pytest.raises(ValueError):
        staging.to_tms_crs(b, None, config)
    with pytest.raises(KeyError):
        staging.without(b, ["nope"])
