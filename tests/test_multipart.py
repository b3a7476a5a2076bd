"""Polygons of several parts, and polygons against polygons, against plain Python."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from perilgrid.functions.geometry import multi_polygon, st_contains, st_intersects
from perilgrid.functions.sql import create_feature_view, register
from perilgrid.operators.polygon_join import polygon_join
from perilgrid.operators.spatial_join import spatial_join
from tests.conftest import plan_of

PARTS = "ARRAY<ARRAY<ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>>>"


def square(x, y, side):
    return [(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]


def position(x, y, rings):
    """0 outside, 1 inside, 2 on the boundary, exactly."""
    x, y, odd = Fraction(x), Fraction(y), False
    for ring in rings:
        for (x0, y0), (x1, y1) in zip(ring, ring[1:]):
            x0, y0, x1, y1 = map(Fraction, (x0, y0, x1, y1))
            if (x1 - x0) * (y - y0) == (y1 - y0) * (x - x0) and min(x0, x1) <= x <= max(x0, x1) and min(y0, y1) <= y <= max(y0, y1):
                return 2
            if (y0 > y) != (y1 > y) and x < (x1 - x0) * (y - y0) / (y1 - y0) + x0:
                odd = not odd
    return int(odd)


def meet(s, t):
    def side(a, b, p):
        v = (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
        return (v > 0) - (v < 0)

    def on(a, b, p):
        return side(a, b, p) == 0 and min(a[0], b[0]) <= p[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= p[1] <= max(a[1], b[1])

    (a, b), (c, d) = s, t
    if side(a, b, c) * side(a, b, d) < 0 and side(c, d, a) * side(c, d, b) < 0:
        return True
    return on(a, b, c) or on(a, b, d) or on(c, d, a) or on(c, d, b)


def overlap(p, q):
    segments = [[s for rings in parts for ring in rings for s in zip(ring, ring[1:])] for parts in (p, q)]
    if any(meet(s, t) for s in segments[0] for t in segments[1]):
        return True
    return any(position(*rings[0][0], other) for a, b in ((p, q), (q, p)) for rings in a for other in b)


def shapes(rng):
    """Squares with holes in several parts, on quarter coordinates so that many touch; some far larger."""
    out = []
    for _ in range(60):
        parts = []
        for _ in range(rng.choice([1, 1, 2, 3])):
            side = rng.choice([0.25, 0.5, 1.0, 2.0, 9.0])
            x, y = rng.randrange(0, 40) / 4, rng.randrange(0, 40) / 4
            rings = [square(x, y, side)]
            if side >= 1 and rng.random() < 0.5:
                rings.append(square(x + side / 4, y + side / 4, side / 2))
            parts.append(rings)
        out.append(parts)
    return out


def frame(spark, parts, key="OBJECTID"):
    rows = [(k, [[[(float(x), float(y)) for x, y in ring] for ring in rings] for rings in p]) for k, p in enumerate(parts)]
    return spark.createDataFrame(rows, f"{key} bigint, parts {PARTS}").select(key, multi_polygon("parts").alias("geometry"))


@pytest.fixture(scope="module")
def made(spark):
    rng = random.Random(11)
    parts = shapes(rng)
    points = [(rng.randrange(0, 100) / 8, rng.randrange(0, 100) / 8) for _ in range(400)]
    points += [v for p in parts for rings in p for ring in rings for v in ring][:200]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "pid bigint, x double, y double")
    df = df.select("pid", F.struct("x", "y").alias("geom"))
    return parts, points, frame(spark, parts), df


@pytest.mark.parametrize("predicate", ["intersects", "contains"])
@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0, "left_rows": 50, "right_rows": 20}])
def test_points_in_parts(made, predicate, options):
    parts, points, polygons, df = made
    held = {1, 2} if predicate == "intersects" else {1}
    want = sorted((i, k) for i, (x, y) in enumerate(points) for k, p in enumerate(parts) if any(position(x, y, r) in held for r in p))
    joined = spatial_join(df, polygons, predicate, **options)
    assert sorted((r.pid, r.OBJECTID) for r in joined.collect()) == want
    semi = spatial_join(df, polygons, predicate, "left_semi", **options)
    assert sorted(r.pid for r in semi.collect()) == sorted({i for i, _ in want})


def test_row_predicates(made):
    parts, points, polygons, df = made
    both = df.where("pid < 60").crossJoin(polygons).select("pid", "OBJECTID", st_intersects("geom", "geometry").alias("i"), st_contains("geometry", "geom").alias("c"))
    for r in both.collect():
        at = [position(*points[r.pid], rings) for rings in parts[r.OBJECTID]]
        assert (r.i, r.c) == (any(at), 1 in at)


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0, "left_rows": 30, "right_rows": 10}])
def test_polygons_against_polygons(spark, made, options):
    parts, _, polygons, _ = made
    others = shapes(random.Random(12))
    want = sorted((i, j) for i, p in enumerate(parts) for j, q in enumerate(others) if overlap(p, q))
    joined = polygon_join(polygons, frame(spark, others, "other"), **options)
    assert sorted((r.OBJECTID, r.other) for r in joined.collect()) == want


def test_nothing_overlaps_null_and_empty(spark, made):
    odd = spark.sql(f"SELECT 1 AS other, CAST(NULL AS {PARTS}) AS parts UNION ALL SELECT 2, CAST(array() AS {PARTS})")
    odd = odd.select("other", multi_polygon("parts").alias("geometry"))
    assert polygon_join(made[2], odd).count() == 0
    assert polygon_join(odd, made[2]).count() == 0
    assert spatial_join(made[3], odd).count() == 0


def test_sql_predicates(spark, made):
    parts, _, polygons, _ = made
    register(spark)
    create_feature_view(polygons, "shapes")
    box = (3.0, 3.0, 5.5, 4.75)
    ring = [(box[0], box[1]), (box[2], box[1]), (box[2], box[3]), (box[0], box[3]), (box[0], box[1])]
    corners = ", ".join(f"{v}D" for v in box)
    got = spark.sql(f"SELECT OBJECTID FROM shapes WHERE st_intersects(geometry, st_makeBBOX({corners}))")
    assert sorted(r[0] for r in got.collect()) == [k for k, p in enumerate(parts) if overlap(p, [[ring]])]
    inside = [k for k, p in enumerate(parts) if all(3 <= x <= 5.5 and 3 <= y <= 4.75 for rings in p for r in rings for x, y in r)]
    got = spark.sql(f"SELECT OBJECTID FROM shapes WHERE st_contains(st_makeBBOX({corners}), geometry)")
    assert sorted(r[0] for r in got.collect()) == inside
    pairs = spark.sql("SELECT a.OBJECTID AS a, b.OBJECTID AS b FROM shapes a JOIN shapes b ON st_intersects(a.geometry, b.geometry)")
    assert sorted(map(tuple, pairs.where("a < 12 AND b < 12").collect())) == sorted((i, j) for i in range(12) for j in range(12) if overlap(parts[i], parts[j]))


def test_cells_make_an_equi_join(spark, made):
    parts, points, polygons, df = made
    register(spark)
    create_feature_view(df, "places")
    create_feature_view(polygons, "shapes")
    sql = """SELECT pid, OBJECTID FROM (SELECT pid, geom, c.* FROM places, LATERAL st_point_cells(geom, -2, 5) c)
             JOIN (SELECT OBJECTID, geometry, c.* FROM shapes, LATERAL st_cells(geometry, -2, {}) c) USING (level, cx, cy)
             WHERE st_intersects(geom, geometry)"""
    joined = spark.sql(sql.format(5))
    assert "NestedLoop" not in plan_of(joined) and "Cartesian" not in plan_of(joined)
    want = sorted((i, k) for i, (x, y) in enumerate(points) for k, p in enumerate(parts) if any(position(x, y, r) for r in p))
    assert sorted(map(tuple, joined.collect())) == want
    with pytest.raises(Exception, match="wider than the cells"):
        spark.sql(sql.format(1)).collect()
