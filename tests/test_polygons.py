"""Polygons against plain loops over points and edges, and the operators that take them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.functions import paths, rings
from tilewright.functions import polygons as p
from tilewright.functions.box import PREDICATES
from tilewright.operators import cells, dedup
from tilewright.operators.grid import COLUMN, ROW, Grid, tms_grids
from tilewright.plans import prep, staging

SCHEMA = f"fid long, grp string, price double, polygons {p.POLYGONS}"


def star(rng, n=9, at=(0.0, 0.0), r=1.0):
    """A simple polygon: corners at rising angles."""
    turn = (np.arange(n) + rng.uniform(0, 0.9, n)) * 2 * np.pi / n
    far = rng.uniform(0.3, 1, n)[:, None] * r
    out = np.stack([np.cos(turn), np.sin(turn)], 1) * far + at
    return np.concatenate([out, out[:1]])


def row(fid, grp, price, *polygons):
    return (fid, grp, price, [[[(float(x), float(y)) for x, y in ring] for ring in rings_] for rings_ in polygons])


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns(p.bounds(F.col("polygons")))


def holds(polygons, xy):
    """Which points are in: by the crossings of each ring."""
    inside = np.zeros(len(xy), bool)
    for ring in (np.array([(q[0], q[1]) for q in r]) for rings_ in polygons for r in rings_):
        for (ax, ay), (bx, by) in zip(ring[:-1], ring[1:], strict=True):
            over = (ay > xy[:, 1]) != (by > xy[:, 1])
            at = ax + (xy[:, 1] - ay) / (by - ay if by != ay else 1) * (bx - ax)
            inside ^= over & (at > xy[:, 0])
    return inside


def test_relations():
    rng = np.random.default_rng(2)
    a, b = ([[[star(rng, 9, rng.uniform(-0.7, 0.7, 2)).tolist()]] if k % 9 else [[star(rng, 5, (-1, 0), 0.9).tolist()], [star(rng, 5, (1, 0), 0.9).tolist()]] for k in range(60)] for _ in range(2))
    hole = [[star(rng, 30, r=3).tolist(), [(0.1, 0.1), (0.1, -0.1), (-0.1, -0.1), (-0.1, 0.1), (0.1, 0.1)]]]
    a, b = [*a, hole, None, hole], [*b, [[[(0.05, 0.05), (-0.05, 0.05), (0, -0.05), (0.05, 0.05)]]], a[0], None]
    xy = np.stack(np.meshgrid(*[(np.arange(300) + 0.5) / 300 * 4 - 2] * 2), -1).reshape(-1, 2)
    meets, _, shared = p.related(p._Flat(p.arrow(a)), p._Flat(p.arrow(b)))
    for k in range(60):
        both = (holds(a[k], xy) & holds(b[k], xy)).mean() * 16
        assert abs(shared[k] - both) < 0.02 and (meets[k] or both == 0)
    assert (meets[60:], shared[60:].tolist()) == (pytest.approx([False, False, False]), [0, 0, 0])
    for k in range(60):
        plain = sum(rings.overlap_area([np.array(r) for r in x], [np.array(r) for r in y]) for x in a[k] for y in b[k])
        assert abs(plain - shared[k]) < 1e-9
        parts = p.slabs(p._Flat(p.arrow([a[k], b[k]])), -2, -2, 7, 2)
        assert abs(sum((r - l) * (h - w).sum() / 2 for (l, r, w, h), d in parts if d == 2) - shared[k]) < 1e-9


def test_measures_and_boxes(spark):
    """Area, centroid, bounds, clipping and the tests against cells, on a grid of points."""
    rng = np.random.default_rng(3)
    rows = [row(k, "g", 1.0, [star(rng, 8, rng.uniform(-2, 2, 2), 1.5)]) for k in range(25)]
    rows += [row(50, "g", 1.0, [[(-3, -3), (3, -3), (3, 3), (-3, 3), (-3, -3)], [(-1, -1), (-1, 1), (1, 1), (1, -1), (-1, -1)]]), row(51, "g", 1.0, [[(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]], [[(2, 2), (3, 2), (3, 3), (2, 2)]])]
    df = frame(spark, rows).cache()
    grid = Grid((-4, -4, 4, 4), 8, 8, top_to_bottom=False)
    xy = np.stack(np.meshgrid(*[(np.arange(800) + 0.5) / 100 - 4] * 2), -1).reshape(-1, 2)
    inside = {r[0]: holds(r[3], xy) for r in rows}
    cell = np.floor(xy[:, 1] + 4).astype(int) * 8 + np.floor(xy[:, 0] + 4).astype(int)
    m = p.measures(F.col("polygons"))
    for r in df.select("fid", m.alias("m"), *[v.alias(c) for c, v in zip("xy", p.representative_point(F.col("polygons")), strict=True)]).collect():
        got = xy[inside[r.fid]]
        assert abs(r.m.area - len(got) / 10_000) < 0.05 and np.allclose([r.m.x, r.m.y], got.mean(0), atol=0.02)
        assert holds(rows[[x[0] for x in rows].index(r.fid)][3], np.array([[r.x, r.y]])).all()
    share = {f: np.bincount(cell[i], minlength=64) / 10_000 for f, i in inside.items()}
    parts = {(r.fid, r[ROW] * 8 + r[COLUMN]): r.area for r in grid.overlay(df).collect()}
    for f, s in share.items():
        for c in range(64):
            assert abs(parts.get((f, c), 0) - s[c]) < 0.03
    pairs = {name: {(r.fid, r[ROW] * 8 + r[COLUMN]) for r in grid.sjoin(df, "inner", name).collect()} for name in PREDICATES}
    for f, s in share.items():
        own = inside[f]
        for c in range(64):
            hit = {name for name in PREDICATES if (f, c) in pairs[name]}
            if s[c] > 0.002:
                assert "intersects" in hit and "touches" not in hit
            if s[c] == 1:
                assert "contains" in hit and "overlaps" not in hit or f < 50
            if s[c] < 0.99:
                assert "contains" not in hit
            if "within" in hit:
                assert own.sum() == own[cell == c].sum()
            assert len(hit & {"touches", "overlaps", "contains"}) <= 1 or hit >= {"contains", "within"}
    whole = grid.overlay(df, "identity").groupBy("fid").agg(F.sum("area").alias("a")).collect()
    real = {r.fid: r.a for r in df.select("fid", m["area"].alias("a")).collect()}
    assert all(abs(r.a - real[r.fid]) < 1e-9 for r in whole)
    left = grid.overlay(df, "symmetric_difference").where("fid is null")
    free = ~np.any(list(inside.values()), 0)
    assert abs(left.agg(F.sum("area")).first()[0] - free.sum() / 10_000) < 0.1
    assert left.where(F.abs(p.measures(F.col("polygons"))["area"] - F.col("area")) > 1e-9).isEmpty()
    assert grid.overlay(df, "union").where("fid is null").agg(F.sum("area")).first() == left.agg(F.sum("area")).first()
    assert grid.overlay(df, as_index=True).columns[:2] == [ROW, COLUMN]
    points = spark.createDataFrame([(0.5, 0.5, 1)], "x double, y double, k int")
    assert grid.sjoin_points(points, as_index=True).columns == [ROW, COLUMN, "x", "y", "k"] and grid.sjoin_points(points, as_tile=3).columns[-1] == "tile"


def test_tiles_of_polygons(spark):
    """An L-shape isn't in the tile of its missing quarter; the boxes of the same bounds are."""
    shape = [[(0, 0), (30, 0), (30, 5), (5, 5), (5, 30), (0, 30), (0, 0)]]
    df = frame(spark, [row(1, "f", 1.0, shape), row(2, "f", 1.0)]).withColumn("layer", F.lit("l"))
    config = staging.StagingConfig(z=4)
    out = staging.stage(df, config, F.col("grp"))
    tiles = {r.staging_tile for r in out.collect()}
    of_boxes = {r.staging_tile for r in staging.stage(df.drop("polygons").where("fid = 1"), config, F.col("grp")).collect()}
    assert tiles < of_boxes and "Tile(x=18, y=5, z=4)" in of_boxes - tiles
    r = out.first()
    assert r.staging_area == 275 and r.staging_centroid_tile not in tiles or r.staging_centroid_tile in of_boxes
    (grid,) = tms_grids("WGS1984Quad", 4, (0, 0, 30, 30))
    assert set(grid.sjoin(df.where("fid = 1"), "inner", as_tile=4).select("tile").toPandas().tile) == tiles
    assert "tile" in grid.overlay(df.where("fid = 1"), as_tile=4).columns
    named = df.withColumn("attributes", F.create_map(F.lit("Staging_Tile"), F.lit("x")))
    with pytest.raises(ValueError):
        staging.stage(named, config, F.col("grp"))
    with pytest.raises(ValueError):
        staging.stage(df, staging.StagingConfig(z=4, clip_to_footprint=True, dedup_method="footprints"), F.col("grp"))
    with pytest.raises(ValueError):
        staging.dedup_method(staging.StagingConfig(dedup_method="footprints"))


def test_deduplication_of_polygons(spark):
    """Against all pairs by the plain overlap, with groups in turn, and a polygon a thousand times larger than the rest."""
    rng = np.random.default_rng(5)
    rows = [row(k, f"g{k % 4}", float(rng.integers(0, 30)), [star(rng, 7, rng.uniform(0, 9, 2), 1.2)]) for k in range(90)]
    rows.append(row(900, "g1", 99.0, [[(-2000, -2000), (4000, -2000), (4000, 4000), (-2000, 4000), (-2000, -2000)], [(4, 4), (4, 2000), (2000, 2000), (2000, 4), (4, 4)]]))
    df = frame(spark, rows).repartition(4)
    shape = {r[0]: [np.array(x) for x in r[3][0]] for r in rows}
    area = {f: rings.overlap_area(s, s) for f, s in shape.items()}
    info = {r[0]: (r[1], r[2]) for r in rows}
    pairs = []
    for a in sorted(info):
        for b in sorted(info):
            if info[a][0] < info[b][0]:
                both = rings.overlap_area(shape[a], shape[b])
                if both > 0.3 * area[a] or both > 0.3 * area[b]:
                    pairs.append(((info[a][0], info[b][0]), a, b, a if info[b][1] > info[a][1] else b))
    for n in (2, 4):
        gone: set = set()
        for turn in sorted({t for t, *_ in pairs}):
            gone |= {loser for t, a, b, loser in pairs if t == turn and t[1] < f"g{n}" and a not in gone and b not in gone}
        some = df.where(F.col("grp") < f"g{n}")
        got = dedup.deduplicate_neighbors(some, "grp", [("price", "larger")], 0.3, False)
        assert {r.fid for r in got.where("staging_duplicated").collect()} == gone and got.count() == some.count()
    zone = frame(spark, [row(0, "g0", 2.0, [[(0, 0), (6, 0), (0, 6), (0, 0)]]), row(0, "g1", 1.0, [[(0, 0), (6, 0), (6, 6), (0, 0)]])])
    got = dedup.deduplicate_by_footprint(df.withColumn("staging_duplicated", F.lit(False)), zone, "grp", [("price", "larger")])
    common = [np.array([(0, 0), (6, 0), (3, 3), (0, 0)], float)]
    want = {f for f, s in shape.items() if info[f][0] == "g1" and rings.overlap_area(s, common) > 1e-9}
    assert {r.fid for r in got.where("staging_duplicated").collect()} == want
    for method in ("intersects", "within", "contains", "touches", "overlaps", "covers", "contains_properly", "crosses"):
        got = {r.fid for r in dedup.clip_to_boundary(df, zone.limit(1), method).where("not staging_duplicated").collect()}
        tri = [np.array([(0, 0), (6, 0), (0, 6), (0, 0)], float)]
        both = {f: rings.overlap_area(s, tri) for f, s in shape.items()}
        want = {
            "intersects": {f for f in shape if both[f] > 1e-9}, "within": {f for f in shape if both[f] > area[f] - 1e-9}, "overlaps": {f for f in shape if 1e-9 < both[f] < min(area[f], 18) - 1e-9},
        }.get(method, set())
        if method in ("contains", "covers", "contains_properly"):
            want = {900} if abs(both[900] - 18) < 1e-9 else set()
        assert got == want, method
    assert dedup.clip_to_boundary(df, zone.select("x0", "y0", "x1", "y1").limit(1), "within").where("not staging_duplicated").count() > 0


def test_wkb_and_cells(spark):
    rng = np.random.default_rng(8)
    df = frame(spark, [row(1, "g", 1.0, [star(rng, 12, r=5)]), row(2, "g", 1.0, [[(9, 9), (9.1, 9), (9.1, 9.1), (9, 9)]], [[(9.5, 9), (9.6, 9), (9.6, 9.1), (9.5, 9)]])])
    back = df.select("polygons", p.from_wkb(p.to_wkb(F.col("polygons"))).alias("back"), p.is_empty(F.col("polygons")).alias("empty")).collect()
    assert all(r.back == r.polygons and not r.empty for r in back)
    h = cells.PlanarHex(0.7)
    out = h.cells_of_box(df).select("fid", "q", "r", h.shared_area(F.col("q"), F.col("r"), F.col("polygons")).alias("a"), *[v.alias(c) for c, v in zip("xy", h.centre(F.col("q"), F.col("r")), strict=True)]).collect()
    shape = [[np.array([(q.x, q.y) for q in x]) for x in pol] for pol in back[0].polygons]
    assert all(holds([[list(map(tuple, x)) for x in s] for s in shape], np.array([[r.x, r.y]])).all() for r in out if r.fid == 1)
    assert [0 < r.a <= 0.01 for r in out if r.fid == 2] == [True] and sum(r.a for r in out if r.fid == 1) <= df.select(p.measures(F.col("polygons"))["area"]).first()[0]
    measured = df.select(F.array_sort(F.transform(F.get("polygons", 0), F.size)))
    assert measured.count() == 2


def test_plot():
    class Axes:
        def __init__(self):
            self.lines = []

        def vlines(self, *a, **how):
            self.lines.append(a)

        hlines = vlines

    ax = Grid((0, 0, 4, 2), 2, 2).plot(Axes(), color="k")
    assert ax.lines == [([0, 2, 4], 0, 2), ([0, 1, 2], 0, 4)]


def test_path_helpers(spark):
    t = paths.TilePaths("WGS1984Quad")
    r = spark.range(1).select(t.parent_path(F.lit("/a/vec/WGS1984Quad/5/10/13.gpkg")), t.child_paths(F.lit("/a/vec/WGS1984Quad/5/10/13.gpkg")), t.parent_path(F.lit("/a/vec/WGS1984Quad/0/1/0.gpkg"))).first()
    assert r[0] == "/a/vec/WGS1984Quad/4/5/6.gpkg" and r[2] is None
    assert r[1] == [f"/a/vec/WGS1984Quad/6/{x}/{y}.gpkg" for x in (20, 21) for y in (26, 27)]
    r = spark.range(1).select(prep.footprint_path(F.lit("/in/a/b.shp"), "/in", "/foot/", "fp_"), prep.dir_to_filename(F.lit("/in/x_iwp/"), "fp_", "_iwp"), prep.id_to_name(F.lit("a"), "_c"), prep.id_to_name(F.lit("a_c"), "_c")).first()
    assert tuple(r) == ("/foot/a/fp_b.shp", "fp_x.shp", "a_c", "a_c")
    main = spark.createDataFrame([("/m/1.shp",), ("/m/2.shp",)], "path string")
    preferred = spark.createDataFrame([("/p/2.shp",), ("/p/3.shp",)], "path string")
    report = prep.replacement_report(prep.preferred_paths(main, preferred), preferred).first()
    assert report.asDict() == {"n_main": 2, "n_replaced": 1, "n_preferred": 2, "n_unused": 1}


@pytest.mark.parametrize("both", [False, True])
def test_polygons_that_lie_on_one_another_are_seldom_tested(spark, monkeypatch, both):
    """Against all pairs, without the column that tests every pair."""
    rng = np.random.default_rng(11)
    rows = [row(k, f"g{k % 2}", float(rng.integers(0, 500)), [star(rng, 7, rng.uniform(0, 1, 2), 1.2)]) for k in range(60)]
    shape = {r[0]: [np.array(x) for x in r[3][0]] for r in rows}
    area = {f: rings.overlap_area(s, s) for f, s in shape.items()}
    gone = set()
    for a in rows[::2]:
        for b in rows[1::2]:
            common = rings.overlap_area(shape[a[0]], shape[b[0]])
            if common > 0.3 * (max if both else min)(area[a[0]], area[b[0]]):
                gone.add(a[0] if b[2] > a[2] else b[0])
    monkeypatch.setattr(dedup, "DEPTH", 8, raising=False)
    monkeypatch.setattr(dedup.polygons_, "shared_area", lambda *a: pytest.fail("every pair is tested"))
    got = dedup.deduplicate_neighbors(frame(spark, rows), "grp", [("price", "larger")], 0.3, both)
    assert {r.fid for r in got.where("staging_duplicated").collect()} == gone and gone


def ell(x, y, w, h):
    """The ring of a box less its upper right quarter."""
    return [(x, y), (x + w, y), (x + w, y + h / 2), (x + w / 2, y + h / 2), (x + w / 2, y + h), (x, y + h), (x, y)]


@pytest.mark.parametrize("depth,both", [(2, False), (2, True), (8, False)])
def test_few_pairs_are_left_to_polygons_that_lie_on_one_another(spark, monkeypatch, depth, both):
    """Against all pairs; what bounds leave to be tested on polygons is counted. Some shapes lie apart, where none of the best are."""
    rng = np.random.default_rng(23)
    rows = []
    for k in range(400):
        x, y = rng.uniform(0, 3, 2) + (4 if k % 20 == 0 else 0)
        rows.append((k, None if k % 97 == 96 else f"g{k % 2}", None if k % 89 == 88 else float(rng.integers(0, 150)) - (200 if k % 20 == 0 else 0), f"n{rng.integers(0, 3)}", ell(*map(float, (x, y, *rng.uniform(0.5, 2, 2))))))
    gone, able = set(), [r for r in rows if None not in r]
    for a in (r for r in able if r[1] == "g0"):
        for b in (r for r in able if r[1] == "g1"):
            # Of each shape the lower half of its box, and the left quarter above it.
            parts = [[(*r[4][0], *r[4][2]), (*r[4][5][:1], r[4][3][1], *r[4][4])] for r in (a, b)]
            common = sum(max(min(q[2], t[2]) - max(q[0], t[0]), 0) * max(min(q[3], t[3]) - max(q[1], t[1]), 0) for q in parts[0] for t in parts[1])
            areas = [sum((q[2] - q[0]) * (q[3] - q[1]) for q in part) for part in parts]
            if common > 0.3 * (max if both else min)(areas):
                gone.add(a[0] if (b[2], a[3]) > (a[2], b[3]) else b[0])
    df = spark.createDataFrame([(f, g, p, n, [[s]]) for f, g, p, n, s in rows], SCHEMA.replace("polygons", "name string, polygons"))
    df = df.withColumns(p.bounds(F.col("polygons")))
    joined, box_join = [], dedup.box_join
    monkeypatch.setattr(dedup, "DEPTH", depth)
    monkeypatch.setattr(dedup, "box_join", lambda *a, **k: joined.append(box_join(*a, **k)) or joined[-1])
    got = dedup.deduplicate_neighbors(df, "grp", [("price", "larger"), ("name", "smaller")], 0.3, both)
    assert {r.fid for r in got.where("staging_duplicated").collect()} == gone and got.count() == len(rows) and gone
    assert sum(pairs.count() for pairs in joined) <= 4 * len(rows)


def test_measured_polygons(spark):
    """As the measures by column expressions, to the last digit; boxes lie inside and apart."""
    rng = np.random.default_rng(3)
    hole = [(0.1, 0.1), (0.1, -0.1), (-0.1, -0.1), (-0.1, 0.1), (0.1, 0.1)]
    shapes = [[[star(rng, rng.integers(4, 30), rng.uniform(-300, 300, 2)).tolist()]] for _ in range(60)]
    shapes += [[[star(rng, 30, r=3).tolist()[::-1], hole]], [[star(rng, 7, (-2, 0)).tolist()], [star(rng, 5, (2, 0)).tolist()]], [[ell(0.0, 0.0, 4.0, 2.0)]], [[[(0.0, 0.0), (0.0, 1.0), (0.0, 0.0)]]]]
    known = len(shapes)
    shapes += [None, [], [[]], [[[]]], [[[(0.0, 0.0)]]], [[], [hole]], [[hole], []], [None, [hole]], [[None, hole]], [[[None, (1.0, 1.0), (0.0, 1.0)]]], [[[(None, 0.0), (1.0, 1.0), (0.0, 1.0)]]], [[hole, [(0.0, 0.0)]]]]
    df = spark.createDataFrame([(k, s) for k, s in enumerate(shapes)], f"k int, polygons {p.POLYGONS}").coalesce(1)
    rows = df.select("k", p.measured(F.col("polygons")).alias("m"), p.measures(F.col("polygons")).alias("n")).orderBy("k").collect()
    for r in rows:
        assert (r.m.area, r.m.x, r.m.y) == ((r.n.area, r.n.x, r.n.y) if r.n else (None, None, None)), shapes[r.k]
    found = 0
    for r in rows[:known]:
        sides = [[r.m[f"p{k}_{c}"] for c in ("x0", "y0", "x1", "y1")] for k in range(p.PARTS)]
        boxes = p.arrow([[[[(a, b), (c, b), (c, d), (a, d), (a, b)]]] for a, b, c, d in sides])
        shared = p.related(p._Flat(boxes), p._Flat(p.arrow([shapes[r.k]] * p.PARTS)))[2]
        assert shared == pytest.approx([(c - a) * (d - b) for a, b, c, d in sides], abs=1e-9)
        assert min(d for *_, d in sides) <= max(b for _, b, *_ in sides)
        found += shared.sum() > 0.2 * r.m.area
    assert found > 0.9 * known and sides == [[0] * 4] * 2 and [rows[known - 2].m[f"p{k}_x1"] for k in range(2)] == [4, 2]
