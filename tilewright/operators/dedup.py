"""Duplicate features from overlapping source files: labels by boundary, by neighbours and by footprints.

Features are boxes (x0, y0, x1, y1) with attributes or, with a column ``polygons``, polygons with these bounds;
labels are one boolean column. Spatial joins go over bins: each box is posted in the bins it meets, bins are
joined by equality, and a pair counts only in the bin that holds the low corner of what the two have in
common, so that nothing is found twice. Boxes far larger than the mean go into coarser bins, in which the
smaller ones are posted, too; a pair meets in the bins of the larger one. So no box is posted in more than
four bins of a size. Nothing is grouped by bin behind the join, so Spark can split a dense one. What boxes
leave is tested on the polygons.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import crs as crs_
from ..functions import polygons as polygons_
from ..functions.box import CLIP_PREDICATES, Box, intersection, intersection_area, meets, predicate, shares_area
from ..runtime import cut, stored

DUPLICATED = "staging_duplicated"
Rules = Sequence[tuple[str, str]]
#: A rule's name for the area that is computed here.
AREA = "area_"


def keep_rules_to_sort_order(rules: Rules) -> tuple[list[str], list[bool]]:
    """Names, and whether the smaller value wins; anything but "smaller" means the larger one does."""
    return [name for name, _ in rules], [which == "smaller" for _, which in rules]


def order_by_rules(rules: Rules) -> list[Column]:
    """The best first; nulls last either way."""
    return [F.col(n).asc_nulls_last() if up else F.col(n).desc_nulls_last() for n, up in zip(*keep_rules_to_sort_order(rules), strict=True)]


def normal(label: Column) -> Column:
    """True stays; null and false are false."""
    return F.coalesce(label.cast("boolean"), F.lit(False))


#: How much coarser bins of the next size are.
COARSER = 8.0


def bins_of(left: DataFrame, right: DataFrame) -> tuple[float, list[int]]:
    """Size of the finest bins, twice the mean extent of ``left`` or a little more, and which coarser ones there are: a small
    aggregation of each side, and one more of their sizes if any box is far larger than the finest bins."""
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    found = [df.agg(F.avg(w), F.avg(h), F.max(F.greatest(w, h))).first() for df in ([left] if left is right else [left, right])]
    size = 2 * max(found[0][0] or 0.0, found[0][1] or 0.0) or 1.0
    top = max(f[2] or 0.0 for f in found)
    if top <= 2 * size:
        return max(size, top), [0]
    sizes = [df.select(_level(size).alias("lv")) for df in (left, right)]
    return size, sorted(r.lv for r in sizes[0].unionByName(sizes[1]).where("lv is not null").distinct().collect())  # a few numbers


def _level(size: float) -> Column:
    """0 for boxes up to a bin's size, 1 for those up to that of the next coarser bins, and so on."""
    extent = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    return F.greatest(F.ceil(F.log(F.greatest(extent / size, F.lit(1e-300))) / F.log(F.lit(COARSER)) - 1e-9), F.lit(0)).cast("int")


def binned(boxes: DataFrame, size: float, levels: Sequence[int] = (0,), centre: bool = False) -> DataFrame:
    """Boxes once for each bin (lv, bx, by) that they meet, of their own size ``own_lv`` and of all coarser ones in ``levels``;
    with ``centre`` only for those that hold their centres."""
    if len(levels) > 1:
        out = boxes.withColumn("own_lv", _level(size))
        out = out.withColumn("lv", F.explode(F.filter(F.array(*map(F.lit, levels)), lambda v: v >= F.col("own_lv"))))
    else:
        out = boxes
    at = lambda c: F.floor((F.col(c) if isinstance(c, str) else c) / _width(size, levels, "lv"))
    if centre:
        x, y = Box().centroid
        return out.withColumns({"bx": at(x), "by": at(y)})
    return out.withColumn("bx", F.explode(F.sequence(at("x0"), at("x1")))).withColumn("by", F.explode(F.sequence(at("y0"), at("y1"))))


def _width(size: float, levels: Sequence[int], level: str) -> Column:
    return F.lit(size) * F.pow(F.lit(COARSER), F.col(level)) if len(levels) > 1 else F.lit(size * COARSER ** levels[0])


def box_join(left: DataFrame, right: DataFrame, test: Callable[[Box, Box], Column], on: Sequence[str] = (), extra: Column | None = None, bins: tuple[float, list[int]] | None = None, few: str | None = None) -> DataFrame:
    """Inner join of ``left`` (columns a.*) and ``right`` (b.*) on meeting boxes that pass ``test``; ``bins``: where they are known;
    ``few``: the side ("a" or "b") whose bins are few enough to be sent everywhere, so that what else the other side has isn't dealt out."""
    a, b = Box("a."), Box("b.")
    c = intersection(a, b)
    size, levels = bins or bins_of(left, right)
    several = len(levels) > 1
    width = _width(size, levels, "a.lv")
    once = (F.col("a.bx") == F.floor(c["x0"] / width)) & (F.col("a.by") == F.floor(c["y0"] / width))
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in ("bx", "by", *(["lv"] if several else []), *on)]
    own = [F.col("a.lv") == F.greatest("a.own_lv", "b.own_lv")] if several else []
    # Cheap tests come first. Sides that are small enough to be broadcast are dealt out by bins all the same: a broadcast
    # would leave all pairs to the tasks that read the other side, which may be few.
    every = [*same, meets(a, b), *own, once, test(a, b), *([extra] if extra is not None else [])]
    sides = {"a": binned(left, size, levels), "b": binned(right, size, levels)}
    if few:
        at, other = ["bx", "by", *(["lv"] if several else [])], "ab".replace(few, "")
        sides[other] = sides[other].join(F.broadcast(sides[few].select(*at).distinct()), at, "left_semi")
    return sides["a"].alias("a").hint("merge").join(sides["b"].alias("b"), reduce(lambda x, y: x & y, every))


def geometry(df: DataFrame) -> list[str]:
    """The columns of a frame's shapes."""
    return ["x0", "y0", "x1", "y1", *([polygons_.COLUMN] if polygons_.is_polygons(df) else [])]


def _shape(df: DataFrame, prefix: str) -> Column:
    return F.col(f"{prefix}{polygons_.COLUMN}") if polygons_.is_polygons(df) else polygons_.of_box(Box(prefix))


def shape_join(left: DataFrame, right: DataFrame, method: str, on: Sequence[str] = ()) -> DataFrame:
    """Pairs ``left METHOD right`` as a.* and b.*: by boxes, and by polygons where either side has them."""
    if not polygons_.is_polygons(left) and not polygons_.is_polygons(right):
        return box_join(left, right, lambda a, b: predicate(method, a, b), on)
    pairs = box_join(left, right, meets, on)
    return pairs.where(polygons_.related_by(method, polygons_.relation(_shape(left, "a."), _shape(right, "b."))))


def clip_to_boundary(features: DataFrame, boundary: DataFrame, method: str = "intersects", label: str = DUPLICATED, key: str = "fid", dedupe_matches: bool = True) -> DataFrame:
    """Labels features true that no boundary shape meets by ``feature METHOD boundary``.

    ``key``: unique. With ``dedupe_matches`` false, a feature that matches k boundary shapes is returned k times.
    """
    if method not in CLIP_PREDICATES:
        raise ValueError(f"method must be one of {CLIP_PREDICATES}")
    pairs = shape_join(features.select(key, *geometry(features)), boundary.select(*geometry(boundary)), method)
    hits = pairs.select(F.col(f"a.{key}").alias(key)).withColumn("hit", F.lit(True))
    hits = hits.distinct() if dedupe_matches else hits
    return features.join(hits, key, "left").select(*[c for c in features.columns if c != label], F.col("hit").isNull().alias(label))


def clip_to_footprint(features: DataFrame, boundary: DataFrame | None, clip: bool = False, dedup: str | None = None, label: str = DUPLICATED, **more) -> DataFrame:
    """``clip_to_boundary`` if clipping is asked for and a deduplication method is set; else the features as they are."""
    return clip_to_boundary(features, boundary, "intersects", label, **more) if clip and dedup and boundary is not None else features


def _loses(rules: Rules) -> Column:
    """Of a pair whose rules' values are known: whether they decide against b; ties do."""
    out = F.lit(True)
    for name, up in reversed(list(zip(*keep_rules_to_sort_order(rules), strict=True))):
        a, b = F.col(f"a.{name}"), F.col(f"b.{name}")
        better, worse = (a < b, a > b) if up else (a > b, a < b)
        out = F.when(better, True).when(worse, False).otherwise(out)
    return out


def deduplicate_neighbors(
    features: DataFrame, split_by: str | None, keep_rules: Rules, overlap_tolerance: float | None = 0.5, overlap_both: bool = True, centroid_tolerance: float | None = None,
    distance_crs: int | str | None = 3857, crs: int | str | None = 4326, label: str = DUPLICATED, key: str = "fid", partition_by: Sequence[str] = (),
) -> DataFrame:
    """Labels the losers among features of different groups (``split_by``) that overlap.

    A pair counts if it shares an area; if ``overlap_tolerance`` is set, the share must exceed it of both areas
    (of either, without ``overlap_both``); if ``centroid_tolerance`` is set, the centroids must lie within it in
    ``distance_crs``. The loser is decided by ``keep_rules``, in order; ties go to the group with the smaller
    name. Pairs of groups act in the order of their names, and what an earlier one removed takes part in no
    later one; all pairs of one pair of groups act at once. Features without a group are never compared, and
    a null rule value removes nobody. ``key`` is unique, or unique within ``partition_by`` (the tile, say).
    """
    if split_by is None:
        raise ValueError("split_by is needed")
    if not keep_rules:
        raise ValueError("keep_rules are needed")
    if crs is None:
        raise ValueError("the features' CRS is needed")
    box, exact = Box(), polygons_.is_polygons(features)
    names = [n for n, _ in keep_rules if n != AREA]
    working = features.where(F.col(split_by).isNotNull()).select(*dict.fromkeys([*partition_by, split_by, key, *geometry(features), *names]))
    if exact:
        # Measures are costly, so they are written once, without the polygons, which only tests on them take along.
        parts = [f"{p}{c}" for p in PARTS for c in ("x0", "y0", "x1", "y1")]
        taken = {AREA: "area", **({} if centroid_tolerance is None else {"cx_": "x", "cy_": "y"}), **{c: c for c in parts}}
        working = working.withColumn("m_", polygons_.measured(F.col(polygons_.COLUMN))).withColumns({k: F.col(f"m_.{v}") for k, v in taken.items()})
        working = stored(working.drop("m_", polygons_.COLUMN))
    else:
        working = working.withColumn(AREA, box.area)
    # The last group is never the earlier one of a pair, nor the first one the later: of two groups each is on one side only.
    group = F.col(split_by)
    low, high = working.agg(F.min(group), F.max(group)).first()
    known = reduce(lambda x, y: x & y, [F.col(n).isNotNull() for n, _ in keep_rules])
    able = working.where(known)  # a null rule value decides nothing
    common = intersection_area(Box("a."), Box("b."))

    def enough(common: Column) -> Column:
        ia, ib = (common > F.lit(overlap_tolerance) * F.col(f"{side}.{AREA}") for side in "ab")
        return ia & ib if overlap_both else ia | ib

    tests, near = [F.col(f"a.{split_by}") < F.col(f"b.{split_by}")], []
    if overlap_tolerance is not None:
        tests.append(enough(common))  # polygons share no more than their bounds do
    if centroid_tolerance is not None:
        target = crs if distance_crs is None else distance_crs
        centre = lambda p: (F.col(f"{p}cx_"), F.col(f"{p}cy_")) if exact else Box(p).centroid
        (ax, ay), (bx, by) = (crs_.reproject(*centre(p), crs, target) for p in ("a.", "b."))
        near = [F.hypot(ax - bx, ay - by) <= centroid_tolerance]
        tests += near
    b_loses = _loses(keep_rules)
    keys = [*partition_by, key]

    def shaped(df: DataFrame) -> DataFrame:
        """With the polygons, null-safe by all keys."""
        same = reduce(lambda x, y: x & y, [F.col(f"f.{c}").eqNullSafe(F.col(f"p.{c}")) for c in keys])
        shapes = features.where(F.col(split_by).isNotNull()).select(*keys, polygons_.COLUMN)
        return df.alias("f").join(shapes.alias("p"), same).select("f.*", f"p.{polygons_.COLUMN}")

    # What a pair has to share more than.
    need = polygons_.TOLERANCE * F.least(f"a.{AREA}", f"b.{AREA}")
    if overlap_tolerance is not None:
        need = F.greatest(need, F.lit(overlap_tolerance) * (F.greatest if overlap_both else F.least)(f"a.{AREA}", f"b.{AREA}"))

    def joined(a: DataFrame, b: DataFrame, *more: Column, first_of: Column | None = None, few: str | None = None) -> DataFrame:
        """Pairs that count, of ``a`` and ``b``, for which ``more`` holds; with ``first_of`` one or more for each of its values that has any."""
        test = reduce(lambda x, y: x & y, [*tests, *more])
        if not exact:
            return box_join(a, b, shares_area, partition_by, test, few=few)
        pairs = box_join(shaped(a), shaped(b), shares_area, partition_by, test, bins_of(a, b), few)
        shapes = [F.col(f"{s}.{polygons_.COLUMN}") for s in "ab"]
        if first_of is None:
            return pairs.withColumns({"shared_": polygons_.shared_area(*shapes), "need_": need}).where("shared_ > need_")
        return pairs.withColumn("shares_", polygons_.any_shares(*shapes, need, F.try_divide(common, need), first_of)).where("shares_")

    # Within a partition a key is a feature, and across partitions it is several.
    of = lambda side: F.struct(*[F.col(f"{side}.{c}").alias(c) for c in keys]) if partition_by else F.col(f"{side}.{key}")
    part = lambda c: F.col(f"r.loser.{c}") if partition_by else F.col("r.loser")
    # Null-safe, as a plain equality would have the loser tested for null first of all in the joins above.
    own = reduce(lambda x, y: x & y, [F.col(f"f.{c}").eqNullSafe(part(c)) for c in keys])

    def losing(x: DataFrame, y: DataFrame, *columns: Column | tuple[str, str], low=low, high=high, first: bool = False, few: bool = False) -> DataFrame:
        """(loser, winner, columns) of pairs with the loser in ``x`` and the winner in ``y``; a column ("l" or "w", name) is the
        loser's or the winner's. With ``first``, pairs of a loser that is known by one of them already may be missing; with
        ``few``, bins of ``x`` are sent everywhere."""
        text = (lambda s: F.to_json(of(s))) if partition_by else of
        one = lambda s: {"first_of": text(s) if first else None, "few": s if few else None}

        def pick(pairs: DataFrame, side: Callable[[Callable[[str], Column]], tuple[Column, Column]]) -> DataFrame:
            value = lambda c: side(lambda s: F.col(f"{s}.{c[1]}"))["lw".index(c[0])].alias("_".join(c)) if isinstance(c, tuple) else c
            loser, winner = side(of)
            return pairs.select(loser.alias("loser"), winner.alias("winner"), *map(value, columns))

        if x is y:
            either = lambda f: (F.when(b_loses, f("b")).otherwise(f("a")), F.when(b_loses, f("a")).otherwise(f("b")))
            return pick(joined(x.where(group < high), x.where(group > low)), either)
        a = pick(joined(x.where(group < high), y.where(group > low), ~b_loses, **one("a")), lambda f: (f("a"), f("b")))
        return a.unionByName(pick(joined(y.where(group < high), x.where(group > low), b_loses, **one("b")), lambda f: (f("b"), f("a"))))

    less = lambda df, gone: df.alias("f").join(gone.alias("r"), own, "left_anti")

    def tested(x: DataFrame, y: DataFrame, low, high, few: bool) -> DataFrame:
        """The losers (loser) in ``x`` to winners in ``y``, for polygons: pairs are written, and polygons are read for these only."""
        bins, found = bins_of(y, y), []
        for side, other, loses in (("a", "b", ~b_loses), ("b", "a", b_loses)):
            frame = {side: x, other: y}
            test = reduce(lambda x, y: x & y, [*tests, loses])
            pairs = box_join(frame["a"].where(group < high), frame["b"].where(group > low), shares_area, partition_by, test, bins, side if few else None)
            found.append(pairs.select(*[F.struct(*[F.col(f"{s}.{c}") for c in keys]).alias(s) for s in "ab"], of(side).alias("loser"), need.alias("need_"), F.try_divide(common, need).alias("likely_")))
        pairs = cut(found[0].unionByName(found[1]))
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("k")).select("k.*").distinct()
        wanted = F.broadcast(wanted) if wanted.count() <= SENT else wanted
        alike = lambda s: reduce(lambda x, y: x & y, [F.col(f"p.{c}").eqNullSafe(F.col(f"{s}{c}")) for c in keys])
        shapes = cut(features.where(F.col(split_by).isNotNull()).alias("p").join(wanted.alias("k"), alike("k."), "left_semi").select(*keys, polygons_.COLUMN))
        for s in "ab":
            pairs = pairs.alias("q").join(shapes.alias("p"), alike(f"q.{s}.")).select("q.*", F.col(f"p.{polygons_.COLUMN}").alias(f"{s}_"))
        first_of = F.to_json("loser") if partition_by else F.col("loser")
        return pairs.where(polygons_.any_shares(F.col("a_"), F.col("b_"), F.col("need_"), F.col("likely_"), first_of)).select("loser").distinct()

    def at_once(df: DataFrame, low, high) -> DataFrame:
        """The losers among two groups, whose pairs all act at once.

        Where shapes lie on one another many times, nearly all lose to one of those that the rules like best. So all
        meet these first, in a join that stops at a feature's first pair of which boxes inside the polygons tell that
        it counts. What is left meets them by its polygons; then only those that the rules like less, and that still
        are there, have to meet the others.
        """
        cover = F.try_divide(F.sum(box.area), (F.max("x1") - F.min("x0")) * (F.max("y1") - F.min("y0")))
        many, n = df.agg(cover, F.count("*")).first()
        if (many or 0.0) <= DEPTH / 2:
            return losing(df, df, low=low, high=high).select("loser").distinct()
        depth, left, bins = DEPTH, df, bins_of(df, df)
        while True:  # more of them, as long as many features are left
            best = _foremost(df, keep_rules, keys, n, depth / many)
            left = cut(_not_surely_lost(left, df.where(best), group, low, high, near, b_loses, need, partition_by, PARTS if exact else [""], bins))
            if left.count() * DEPTH <= n or depth >= many:
                break
            depth *= 8

        def lost(x: DataFrame, y: DataFrame) -> DataFrame:
            size = x.count()
            few = size * 8 <= SENT  # a feature lies in a few bins
            if exact and size * DEPTH <= n:
                return tested(x, y, low, high, few)
            return losing(x, y, low=low, high=high, first=True, few=few).select("loser").distinct()

        gone = cut(lost(left, df.where(best)))
        rest = cut(less(left.where(~best), gone))
        if not rest.isEmpty():
            gone = gone.unionByName(lost(rest, df.where(~best)))
        return less(df, cut(less(left, gone).select(of("f").alias("loser")))).select(of("f").alias("loser"))

    between = working.where((group > low) & (group < high)).select(group.alias("g")).distinct().limit(FEW_GROUPS - 1)
    between = sorted(r.g for r in between.collect())
    if not between:
        removed = at_once(able, low, high) if exact else losing(able, able).select("loser").distinct()
    elif len(between) <= FEW_GROUPS - 2:
        removed = None
        for g1, g2 in combinations([low, *between, high], 2):
            two = able.where(group.isin(g1, g2))
            gone = at_once(two if removed is None else less(two, removed), g1, g2)
            removed = cut(gone if removed is None else removed.unionByName(gone))
    else:
        removed = _settled(able, group, losing, lambda df, state: df.alias("f").join(state.alias("r"), own, "left"))
    removed = removed.select("loser", F.lit(True).alias("gone"))
    out = features.alias("f").join(removed.alias("r"), own, "left")
    return out.select(*[F.col(f"f.{c}") for c in features.columns if c != label], F.coalesce("r.gone", F.lit(False)).alias(label))


#: So many shapes of those that the rules like best lie on one another, on the mean, when all meet them first. Where fewer
#: than half as many do of all shapes, all pairs are gone over at once.
DEPTH = 32
#: So many rows at most tell which ones the rules like best.
JUDGES = 256
#: So many bins or keys at most are sent everywhere, so that what they don't need isn't dealt out.
SENT = 500_000
#: Prefixes of the boxes inside a feature's polygons.
PARTS = [f"p{k}_" for k in range(polygons_.PARTS)]


def _foremost(df: DataFrame, rules: Rules, keys: Sequence[str], n: int, share: float) -> Column:
    """Whether the rules like a row as much as a certain one, which is such that about ``share`` of all ``n`` rows are liked as much.

    Some rows, by the hash of their keys, tell that one; all that any row of those that pass loses to by the rules passes, too.
    """
    names = list(dict.fromkeys(name for name, _ in rules))
    step = max(int(n * share / JUDGES), 1)
    some = df.where(F.pmod(F.xxhash64(*keys), F.lit(step)) == 0).select(*names).orderBy(*order_by_rules(rules))
    rows = some.limit(max(min(int(n * share / step), JUDGES), 1)).collect()
    out = F.lit(True)
    for name, up in reversed(list(zip(*keep_rules_to_sort_order(rules), strict=True)) if rows and share < 1 else []):
        a, b = F.col(name), F.lit(rows[-1][name])
        better, worse = (a < b, a > b) if up else (a > b, a < b)
        out = F.when(better, True).when(worse, False).otherwise(out)
    return out


def _not_surely_lost(able: DataFrame, winners: DataFrame, group: Column, low, high, near: Sequence[Column], b_loses: Column, need: Column, on: Sequence[str], parts: Sequence[str], bins: tuple[float, list[int]]) -> DataFrame:
    """Rows of two groups without those that lose a pair to ``winners`` of which boxes inside of both tell that it counts.

    Two share what the boxes do, at least (``parts``: their prefixes). The join stops at a feature's first such pair, and
    looks for it only in the bin of the feature's centre: what it misses has to be tested like any other.
    """
    least = reduce(lambda x, y: x + y, [intersection_area(Box(f"a.{p}"), Box(f"b.{q}")) for p in parts for q in parts])
    # One comparison, as what is compiled for a pair has to stay small.
    every = [shares_area(Box("a."), Box("b.")), *near, least > need + 2 * polygons_.TOLERANCE * (F.col(f"a.{AREA}") + F.col(f"b.{AREA}"))]
    size, levels = bins
    out = []
    for side, other, loses in (("a", "b", ~b_loses), ("b", "a", b_loses)):
        mine, theirs = (df.where(group < high) if s == "a" else df.where(group > low) for s, df in ((side, able), (other, winners)))
        same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in ("bx", "by", *(["lv"] if len(levels) > 1 else []), *on)]
        test = reduce(lambda x, y: x & y, [*same, loses, *every])
        found = binned(mine, size, levels, centre=True).alias(side).hint("merge").join(binned(theirs, size, levels).alias(other), test, "left_anti")
        out.append(found.select(*able.columns))
    return out[0].unionByName(out[1])


#: So many groups at most take their turns one by one: what the first turns remove is in no later join.
FEW_GROUPS = 4
#: Above all turns.
_NEVER = (1 << 63) - 1
#: Pairs that wait for others are written once there are no more than so many for each feature.
KEPT = 4


def _settled(able: DataFrame, group: Column, losing: Callable[..., DataFrame], known: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """The losers (loser) of pairs of many groups, whose pairs act in turn (``_in_turn``), found without a table of all pairs.

    Each feature has bounds ``low_`` and ``high_`` of the turn in which it goes. A round goes over the pairs whose loser
    isn't settled and whose winner isn't known to have gone before, and counts rather than writes them: the first turn of
    any bounds the loser's from below, the first turn of one whose winner is there for sure bounds it from above. In
    each round at least all that the first open turn decides is settled. Pairs are written and settled by
    ``_in_turn`` as soon as there are few for a feature.
    """
    name = able.select(group.alias("name_")).distinct()
    numbers = name.withColumn("g_", F.row_number().over(Window.orderBy("name_")).cast("long"))  # one row for each source file
    able = cut(able.join(numbers, group == F.col("name_")).drop("name_"))
    turn = (F.col("a.g_") * (1 << 32) + F.col("b.g_")).alias("turn")
    # The first turn of a group is the one with the first group, and that of the first group the one with the second.
    first = F.lit(1 << 32) + F.greatest("g_", F.lit(2))
    x = y = able.withColumns({"low_": first, "high_": F.lit(_NEVER)})
    most, state = KEPT * able.count(), None
    while True:
        pairs = losing(x, y, turn, ("l", "high_"), ("w", "low_"), ("w", "high_")).where("turn <= l_high_ and turn <= w_high_")
        if state is not None and waiting <= most:
            return state.where(f"low_ = high_ and low_ < {_NEVER}").select("loser").unionByName(_in_turn(pairs.select("loser", "winner", "turn")))
        found = pairs.groupBy("loser").agg(F.min("turn").alias("any"), F.min(F.when(F.col("w_low_") >= F.col("turn"), F.col("turn"))).alias("sure"), F.count("*").alias("n_"))
        if state is None:
            state = cut(found.select("loser", F.col("any").alias("low_"), F.coalesce("sure", F.lit(_NEVER)).alias("high_"), "n_"))
        else:
            is_open = F.col("low_") < F.col("high_")
            bounds = {"high_": F.least("high_", "sure"), "low_": F.when(is_open, F.least("any", "high_", "sure")).otherwise(F.col("low_"))}
            new = state.drop("n_").alias("s").join(found.alias("t"), F.col("s.loser").eqNullSafe(F.col("t.loser")), "left")
            state = cut(new.select("s.loser", *[v.alias(k) for k, v in bounds.items()], F.coalesce("n_", F.lit(0)).alias("n_")))
        open_, waiting = state.where("low_ < high_").agg(F.min("low_"), F.sum("n_")).first()
        if open_ is None:
            return state.where(f"low_ < {_NEVER}").select("loser")
        now = known(able, state).select("f.*", F.coalesce("r.low_", F.lit(_NEVER)).alias("low_"), F.coalesce("r.high_", F.lit(_NEVER)).alias("high_"))
        x, y = now.where("low_ < high_"), now.where(F.col("high_") >= open_)


def _in_turn(pairs: DataFrame) -> DataFrame:
    """The losers (loser) of pairs (loser, winner, turn) that act in order of ``turn``, each only if neither side has been removed before.

    A loser goes in the first turn in which it has a winner that is still there. A winner that no pair of an
    earlier turn could remove is there for sure, which bounds the loser's turn; only pairs of earlier turns
    whose winners aren't certain stay. In each round all that is certain by now is settled, so that the number
    of rounds follows the longest chain of such pairs, and only what is left of them is written again.
    """
    pairs = cut(pairs)
    could = pairs.groupBy("loser").agg(F.min("turn").alias("t")).select(F.col("loser").alias("winner"), "t")
    marked = cut(pairs.join(could, "winner", "left").select("loser", "winner", "turn", F.coalesce(F.col("t") < F.col("turn"), F.lit(False)).alias("waits")))
    goes = marked.where("not waits").groupBy("loser").agg(F.min("turn").alias("high"))
    goes = cut(goes)
    rest = marked.where("waits").drop("waits")
    while True:
        # Pairs that come after their loser's turn tell nothing.
        rest = cut(rest.join(goes, "loser", "left").where("high is null or turn < high").drop("high"))
        if rest.isEmpty():
            return goes.select("loser")
        open_ = rest.groupBy("loser").agg(F.min("turn").alias("m"))
        state = goes.join(open_, "loser", "full").select(F.col("loser").alias("winner"), F.least("m", "high").alias("low"), F.col("high"))
        marked = rest.join(state, "winner", "left").where("high is null or low < high or high >= turn")  # else the winner has gone before
        waits = F.coalesce(F.col("low") < F.col("turn"), F.lit(False))
        marked = cut(marked.select("loser", "winner", "turn", waits.alias("waits")))
        acts = marked.where("not waits").groupBy("loser").agg(F.min("turn").alias("high"))
        goes = cut(goes.unionByName(acts).groupBy("loser").agg(F.min("high").alias("high")))
        rest = marked.where("waits").drop("waits")


def footprint_rank(footprints: DataFrame, rules: Rules, name: str = "filename") -> DataFrame:
    """(name, rank): each file's first place among all footprints in order of ``rules``, ties by name; 1 is preferred most."""
    order = Window.orderBy(*order_by_rules(rules), F.col(name))  # one row for each source file
    return footprints.select(name, *{n for n, _ in rules}).withColumn("rank", F.row_number().over(order)).groupBy(name).agg(F.min("rank").cast("long").alias("rank"))


def deduplicate_by_footprint(features: DataFrame, footprints: DataFrame, split_by: str = "filename", keep_rules: Rules = (), label: str = DUPLICATED, key: str = "fid") -> DataFrame:
    """Labels features of the less preferred file that meet the overlap of two files' footprints (closed).

    Only files that occur in the features count; files without a footprint remove nothing. Labels that are
    true already stay. Footprints: boxes or polygons, several a file at will, with the columns of the rules;
    every two of different files count, as all do of one.
    """
    if label not in features.columns:
        raise KeyError(label)
    ranks = footprint_rank(footprints, keep_rules, split_by)
    shape = geometry(footprints)
    used = footprints.join(features.select(split_by).distinct(), split_by, "left_semi").join(ranks, split_by).select(split_by, "rank", *shape)
    both = box_join(used, used, meets, extra=F.col("a.rank") < F.col("b.rank"))
    if polygons_.is_polygons(footprints):
        both = both.select(F.col(f"b.{split_by}").alias(split_by), F.explode(polygons_.common_parts(F.col(f"a.{polygons_.COLUMN}"), F.col(f"b.{polygons_.COLUMN}"))).alias("part"))
        both = both.select(split_by, F.array("part").alias(polygons_.COLUMN))
        zones = cut(both.select(split_by, polygons_.COLUMN, *[v.alias(k) for k, v in polygons_.bounds(F.col(polygons_.COLUMN)).items()]))
    else:
        zones = cut(both.select(F.col(f"b.{split_by}").alias(split_by), *[v.alias(k) for k, v in intersection(Box("a."), Box("b.")).items()]).distinct())
    hit = shape_join(features.select(split_by, key, *geometry(features)), zones, "intersects", [split_by])
    hit = hit.select(F.col(f"a.{key}").alias(key)).distinct().withColumn("hit", F.lit(True))
    return features.join(hit, key, "left").select(*[c for c in features.columns if c != label], (normal(F.col(label)) | F.col("hit").isNotNull()).alias(label))


def label_duplicates(to_keep: DataFrame, to_remove: DataFrame, label: str = DUPLICATED) -> DataFrame:
    """One frame: removed rows are true, kept ones what they were, with null as false."""
    kept = to_keep.withColumn(label, normal(F.col(label)) if label in to_keep.columns else F.lit(False))
    return kept.unionByName(to_remove.withColumn(label, F.lit(True)), allowMissingColumns=True)


def combine_and_deduplicate(existing: DataFrame, new: DataFrame, dedup: Callable[[DataFrame], DataFrame], deduplicate_at: str = "staging", label: str = DUPLICATED) -> DataFrame:
    """New and existing rows, deduplicated together; at "staging" the duplicates are dropped."""
    both = new.unionByName(existing, allowMissingColumns=True)
    if label in both.columns:
        both = both.withColumn(label, normal(F.col(label)))
    out = dedup(both)
    return out.where(~F.col(label)) if deduplicate_at == "staging" else out
