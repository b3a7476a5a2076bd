import math
import random
import sys

import pytest
from pyspark.sql import functions as F

from perilgrid.functions.geometry import polygon
from perilgrid.operators import keyed_join, segments
from perilgrid.operators.spatial_join import TILE_KEYS, polygon_tiles, spatial_join
from perilgrid.plans import inputs
from tests.conftest import SF_DIR, plan_of

RINGS = "array<array<struct<x:double,y:double>>>"


def star(cx, cy, r, n, rng):
    ring = []
    for k in range(n):
        a, d = 2 * math.pi * k / n, r * (0.4 + 0.6 * rng.random())
        ring.append((cx + d * math.cos(a), cy + d * math.sin(a)))
    return [*ring, ring[0]]


def square(x, y, s):
    return [(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]


def make_shapes(seed=7):
    """Many sizes, from point-like to country-like, some with holes, some on tile borders."""
    rng = random.Random(seed)
    shapes = []
    for r in (1e-5, 0.01, 0.3, 2.0, 15.0):
        for _ in range(4):
            shapes.append([star(rng.uniform(-20, 20), rng.uniform(-20, 20), r, rng.choice([3, 5, 12, 60]), rng)])
    shapes += [
        [square(0, 0, 4), square(1, 1, 2)],  # hole
        [square(-8, -8, 16), square(-4, -4, 8), square(-2, -2, 4)],  # island in the hole
        [square(0.25, 0.25, 0.25)],
        [square(-16, -16, 32)],
        [[(0, 0), (1, 0), (2, 0), (0, 0)]],  # no area
    ]
    return shapes


def make_points(shapes, seed=11):
    rng = random.Random(seed)
    points = [(rng.uniform(-22, 22), rng.uniform(-22, 22)) for _ in range(400)]
    for rings in shapes:  # vertices, edge midpoints, and near misses
        for ring in rings:
            (x0, y0), (x1, y1) = ring[0], ring[1]
            points += [(x0, y0), ((x0 + x1) / 2, (y0 + y1) / 2), (x0 + 1e-9, y0), (x0, y0 - 1e-9)]
    points += [(float(i), float(j)) for i in range(-8, 9, 2) for j in range(-8, 9, 2)]
    return points


def brute_force(points, shapes, predicate):
    pairs = set()
    for i, (x, y) in enumerate(points):
        for j, rings in enumerate(shapes):
            inside = on_edge = False
            for ring in rings:
                for (x0, y0), (x1, y1) in zip(ring, ring[1:]):
                    if (x1 - x0) * (y - y0) - (y1 - y0) * (x - x0) == 0 and min(x0, x1) <= x <= max(x0, x1) and min(y0, y1) <= y <= max(y0, y1):
                        on_edge = True
                    if (y0 > y) != (y1 > y) and x < (x1 - x0) * (y - y0) / (y1 - y0) + x0:
                        inside = not inside
            if (inside or on_edge) if predicate == "intersects" else (inside and not on_edge):
                pairs.add((f"p{i}", j))
    return pairs


@pytest.fixture(scope="module")
def world(spark):
    shapes = make_shapes()
    points = make_points(shapes)
    polygons = spark.createDataFrame(
        [(j, [[(float(x), float(y)) for x, y in ring] for ring in rings]) for j, rings in enumerate(shapes)],
        f"OBJECTID bigint, rings {RINGS}",
    ).select("OBJECTID", polygon("rings").alias("geometry"))
    sites = spark.createDataFrame(
        [(f"p{i}", float(x), float(y)) for i, (x, y) in enumerate(points)], "__fid__ string, x double, y double"
    ).select("__fid__", F.struct("x", "y").alias("geom"))
    truth = {p: brute_force(points, shapes, p) for p in ("intersects", "contains")}
    assert len(truth["intersects"]) > len(truth["contains"]) > 300
    return sites.cache(), polygons.cache(), truth


def pairs_of(df):
    rows = [(r["__fid__"], r["OBJECTID"]) for r in df.select("__fid__", "OBJECTID").collect()]
    assert len(rows) == len(set(rows)), "a pair was returned twice"
    return set(rows)


@pytest.mark.parametrize("tiles_per_unit, refinements", [(1, 0), (1, 3), (4, 0), (4, 2), (8, 1)])
@pytest.mark.parametrize("predicate", ["intersects", "contains"])
def test_matches_brute_force(world, predicate, tiles_per_unit, refinements):
    sites, polygons, truth = world
    joined = spatial_join(sites, polygons, predicate, tiles_per_unit=tiles_per_unit, refinements=refinements)
    assert pairs_of(joined) == truth[predicate]


@pytest.mark.parametrize("rows", [(10**9, 10**9), (7, 10**9), (10**9, 3), (5, 3)])
def test_shuffled_and_split_joins_match_too(world, rows):
    sites, polygons, truth = world
    options = {"broadcast_bytes": 0, "left_rows": rows[0], "right_rows": rows[1]}
    assert pairs_of(spatial_join(sites, polygons, "contains", **options)) == truth["contains"]
    found = spatial_join(sites, polygons, "contains", "left_semi", **options)
    assert sorted(r["__fid__"] for r in found.collect()) == sorted({p for p, _ in truth["contains"]})
    assert found.columns == sites.columns


@pytest.mark.parametrize("predicate", ["intersects", "contains"])
def test_semi_join_returns_each_point_once(world, predicate):
    sites, polygons, truth = world
    found = [r["__fid__"] for r in spatial_join(sites, polygons, predicate, "left_semi").collect()]
    assert sorted(found) == sorted({p for p, _ in truth[predicate]})


def test_tiles_per_polygon_are_bounded(world):
    _, polygons, _ = world
    worst = polygon_tiles(polygons, refinements=0).groupBy("OBJECTID").count().agg(F.max("count")).first()[0]
    assert worst <= 17 * 17


def test_refined_tiles_do_not_overlap_and_hold_few_segments(world):
    _, polygons, _ = world
    once = polygon_tiles(polygons, refinements=0).agg(F.max(F.size("_edges"))).first()[0]
    tiles = polygon_tiles(polygons, refinements=3)
    assert tiles.agg(F.max(F.size("_edges"))).first()[0] < once / 2
    levels = tiles.selectExpr("OBJECTID", "_level", "_tx", "_ty")
    coarse = levels.selectExpr("OBJECTID", "_level AS l", "_tx AS x", "_ty AS y")
    inside = levels.join(coarse, "OBJECTID").where(
        "l > _level AND x = floor(_tx / pow(4D, l - _level)) AND y = floor(_ty / pow(4D, l - _level))"
    )
    assert inside.count() == 0


def test_empty_null_and_missing_polygons(spark, world):
    sites, _, _ = world
    odd = spark.sql(f"SELECT 1 AS OBJECTID, CAST(NULL AS {RINGS}) AS rings UNION ALL SELECT 2, CAST(array() AS {RINGS})")
    odd = odd.select("OBJECTID", polygon("rings").alias("geometry"))
    joined = spatial_join(sites, odd)
    assert joined.columns == ["__fid__", "geom", "OBJECTID"] and joined.count() == 0
    assert spatial_join(sites, odd, how="left_semi").count() == 0


def test_points_that_match_nothing(spark, world):
    _, polygons, _ = world
    sites = spark.sql(
        """SELECT * FROM VALUES ('a', NULL), ('b', named_struct('x', double('NaN'), 'y', 0D)),
           ('c', named_struct('x', CAST(NULL AS DOUBLE), 'y', CAST(NULL AS DOUBLE))),
           ('d', named_struct('x', 1e300D, 'y', 0D)) t(__fid__, geom)"""
    )
    assert spatial_join(sites, polygons).count() == 0


def test_arguments_are_checked(world):
    sites, polygons, _ = world
    with pytest.raises(ValueError, match="predicate"):
        spatial_join(sites, polygons, "touches")
    with pytest.raises(ValueError, match="join type"):
        spatial_join(sites, polygons, how="left")
    with pytest.raises(ValueError, match="power of two"):
        spatial_join(sites, polygons, tiles_per_unit=3)
    with pytest.raises(ValueError, match="both sides"):
        spatial_join(sites, polygons.withColumn("__fid__", F.lit("x")))


@pytest.mark.parametrize("broadcast_bytes, expected", [(1 << 30, "BroadcastHashJoin"), (0, "SortMergeJoin")])
def test_plan_is_an_equi_join(spark, world, broadcast_bytes, expected):
    sites, polygons, _ = world
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(spatial_join(sites, polygons, broadcast_bytes=broadcast_bytes))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert expected in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_hot_keys_are_measured(spark):
    df = spark.range(1000).selectExpr("CASE WHEN id < 400 THEN 7 ELSE id END AS k")
    assert [tuple(r) for r in keyed_join.hot_keys(df, ["k"], 100).collect()] == [(7, 4)]
    assert keyed_join.hot_keys(df, ["k"], 400) is None


def test_any_number_of_hot_keys_is_split(spark):
    df = spark.range(30_000).selectExpr("id % 6000 AS k", "id AS v")
    assert keyed_join.hot_keys(df, ["k"], 2).count() == 6000
    right = spark.range(6000).selectExpr("id AS k", "id AS r")
    assert keyed_join.split_join(df, right, ["k"], None, left_rows=2).count() == 30_000


@pytest.mark.parametrize("broadcast_bytes", [1 << 30, 0])
@pytest.mark.parametrize("sizes", [1, 2, 5])
def test_semi_join_keeps_repeated_rows(spark, broadcast_bytes, sizes):
    """Every copy of a row inside a polygon is returned, whatever tile sizes are in use."""
    squares = [(k, [[(float(x), float(y)) for x, y in square(0, 0, 4.0**k)]]) for k in range(sizes)]
    polygons = spark.createDataFrame(squares, f"OBJECTID bigint, rings {RINGS}").select("OBJECTID", polygon("rings").alias("geometry"))
    points = spark.createDataFrame([("a", 0.5, 0.5)] * 3 + [("b", 0.5, 0.5), ("c", -1.0, 0.5)], "__fid__ string, x double, y double")
    points = points.select("__fid__", F.struct("x", "y").alias("geom"))
    found = spatial_join(points, polygons, "contains", "left_semi", broadcast_bytes=broadcast_bytes, left_rows=2, right_rows=2)
    assert sorted(r["__fid__"] for r in found.collect()) == ["a", "a", "a", "b"]


def test_shuffled_places_are_thin(spark, world, monkeypatch):
    """What meets the tiles, and is written once before the rows are joined back, has places only."""
    sites, polygons, _ = world
    wide = sites.withColumn("payload", F.lit("p"))
    module, plans = sys.modules[spatial_join.__module__], []
    plain = module._written
    monkeypatch.setattr(module, "_written", lambda df, label: plans.append(plan_of(df)) or plain(df, label))
    assert "Generate" not in plan_of(spatial_join(wide, polygons, broadcast_bytes=0))
    generated = [line for line in plans[0].split("\n\n") if "Generate" in line and "_level" in line]
    assert len(plans) == 1 and generated and all("payload" not in line for line in generated)


@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_split_join_equals_plain_join(spark, how):
    left = spark.range(600).selectExpr("concat('f', id) AS __fid__", "CASE WHEN id % 3 = 0 THEN 1 ELSE id % 50 END AS k")
    right = spark.range(120).selectExpr("CASE WHEN id % 3 = 0 THEN 1 ELSE id % 40 END AS k", "id AS r")
    plain = left.join(right, "k", how)
    split = keyed_join.split_join(left, right, ["k"], None, how, left_rows=30, right_rows=9)
    assert sorted(plain.select(sorted(plain.columns)).collect()) == sorted(split.select(sorted(plain.columns)).collect())


def test_exact_copies_of_a_row_are_spread(spark):
    """Copies share every value, so the part also depends on the map task they come from."""
    left = spark.range(0, 800, 1, 8).selectExpr("'same' AS __fid__", "1L AS k")
    right = spark.sql("SELECT 1L AS k, 'r' AS r")
    joined = keyed_join.split_join(left, right, ["k"], None, left_rows=100)
    assert joined.count() == 800


def test_row_bytes_grows_with_strings_and_arrays(spark):
    df = spark.sql("SELECT repeat('x', 1000) AS s, array_repeat(named_struct('x', 1D, 'y', 2D), 50) AS a, map('k', 1L) AS m, array('ab', 'cd') AS t")
    size = df.select(keyed_join.row_bytes(df)).first()[0]
    assert 1000 + 50 * 16 < size < 1000 + 50 * 48 + 400


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0, "left_rows": 50, "right_rows": 20}])
def test_weights_add_up_to_the_polygons_of_a_point(spark, world, options):
    """Whole tiles at one place are one row with their number, in place of one pair each."""
    sites, polygons, truth = world
    many = polygons.crossJoin(spark.range(3)).select("geometry")
    counted = spatial_join(sites, many, "contains", weight="n", **options)
    want = {}
    for p, _ in truth["contains"]:
        want[p] = want.get(p, 0) + 3
    assert {r[0]: r[1] for r in counted.groupBy("__fid__").agg(F.sum("n")).collect()} == want
    assert counted.count() < sum(want.values())
    with pytest.raises(ValueError, match="weights"):
        spatial_join(sites, polygons, weight="n")


def _copies(spark, n):
    squares = [(k, [[(float(x), float(y)) for x, y in square(k / 1000, 0, 4)]]) for k in range(n)]
    made = spark.createDataFrame(squares, f"OBJECTID bigint, rings {RINGS}")
    return made.select("OBJECTID", polygon("rings").alias("geometry"))


def test_semi_join_needs_few_tiles_however_many_polygons_cover_a_place(spark):
    module = sys.modules[spatial_join.__module__]
    left = []
    for n in (10, 60):
        spread = module.separate_parts(_copies(spark, n).select("geometry"), "geometry")
        tiles, facts = module._measured_tiles(spread, "geometry")
        reduced = module._uncovered(tiles, [level for level, _ in facts["levels"]])
        left.append(reduced.where("_whole").count())
        assert left[-1] < facts["tiles"] / 5
    assert left[0] == left[1]


def test_pairs_are_not_written(spark, world, monkeypatch):
    sites, polygons, _ = world
    module, stored = sys.modules[spatial_join.__module__], []
    plain = module._written
    monkeypatch.setattr(module, "_written", lambda df, label: stored.append(df) or plain(df, label))
    spatial_join(sites, _copies(spark, 200), broadcast_bytes=0).columns
    assert "OBJECTID" not in stored[0].columns
    places = sites.select("geom").distinct().count()
    assert stored[0].count() <= 2 * places


def test_tiles_are_cut_again_for_many_points(spark):
    module = sys.modules[spatial_join.__module__]
    spread = module.separate_parts(_copies(spark, 60).select("geometry"), "geometry")
    _, facts = module._measured_tiles(spread, "geometry")
    assert module._cuts(10, facts) == 0 < module._cuts(10**6, facts) <= module._cuts(10**9, facts) <= module.MAX_CUTS
    finer = module._measured_tiles(spread, "geometry", refinements=1, max_segments=0)[1]
    assert finer["undecided_area"] < facts["undecided_area"] / 2


def test_first_sites_hold_the_first_pairs(world):
    from perilgrid.plans import reports

    sites, polygons, truth = world
    few = reports.first_sites(sites, polygons, 10)
    assert few.count() < sites.count()
    got = spatial_join(few, polygons, "contains").orderBy("__fid__", "OBJECTID").limit(10)
    assert [(r["__fid__"], r["OBJECTID"]) for r in got.collect()] == sorted(truth["contains"])[:10]


def test_tile_test_checks_no_nulls(spark, tmp_path):
    """Stored tiles lose that their columns are never null; the join gets them flat and without nulls, the test is the same."""
    fires = inputs.footprints(spark, SF_DIR).limit(40).select("geometry")
    at = str(tmp_path / "tiles")
    polygon_tiles(fires, max_segments=2).write.parquet(at)
    tiles = spark.read.parquet(at).select(*TILE_KEYS, "_side", *segments.COLUMNS)
    flat = segments.plain(tiles)
    assert "_box" not in flat.columns
    assert [f.name for f in flat.schema if f.nullable and f.name.startswith(("_x", "_y", "_whole", "_base"))] == []
    steps = spark.range(5).selectExpr("id / 4D AS _u").crossJoin(spark.range(5).selectExpr("id / 4D AS _v"))
    for predicate in ("intersects", "contains"):
        want, got = (
            rows.crossJoin(steps).selectExpr("*", "(_tx + _u) * _side AS px", "(_ty + _v) * _side AS py")
            .withColumn("hit", segments.matches("px", "py", predicate, True, flat=is_flat))
            for rows, is_flat in ((tiles, False), (flat, True))
        )
        count = lambda df: {tuple(r) for r in df.groupBy(*TILE_KEYS, "px", "py", "hit").count().collect()}
        assert count(want) == count(got) and {h for *_, h, _ in count(want)} == {True, False}
