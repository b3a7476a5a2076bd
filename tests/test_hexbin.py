import pytest
from pyspark.sql import functions as F

from perilgrid.operators import hexbin

# (bearing, odd row): expected (row step, column step)
STEPS = {
    (350.0, True): (1, 0),
    (350.0, False): (1, -1),
    (300.0, True): (0, -1),  # sector borders belong to the lower sector
    (270.0, True): (0, -1),
    (270.0, False): (0, -1),
    (200.0, True): (-1, -1),
    (200.0, False): (-1, 0),
    (150.0, True): (-1, 1),
    (150.0, False): (-1, 0),
    (90.0, True): (0, 1),
    (90.0, False): (0, 1),
    (30.0, True): (1, 1),
    (30.0, False): (1, 0),
    (0.0, True): (1, 0),
    (0.0, False): (1, 0),
}


@pytest.mark.parametrize("odd_value", [1, -1])
def test_every_sector_and_parity(spark, odd_value):
    rows = [(b, odd_value if odd else 0, 10, 20, False) for b, odd in STEPS]
    rows.append((90.0, odd_value, 10, 20, True))
    df = spark.createDataFrame(rows, "azimuth double, mod2_row bigint, quad_row bigint, quad_col bigint, is_inside boolean")
    got = [(r.arow - 10, r.acol - 20) for r in hexbin.assign(df).collect()]
    assert got == [*STEPS.values(), (0, 0)]


def point_df(spark, rows):
    df = spark.createDataFrame(rows, "portfolio_id bigint, account_id string, site_id string, x double, y double")
    return df.select("portfolio_id", "account_id", "site_id", F.struct("x", "y").alias("geom"))


def test_known_cell_at_the_coarsest_level(spark):
    points = point_df(spark, [(51325, "a", "s", -97.2, 31.5)])
    zooms = spark.createDataFrame([(0, 1565430)], "zoom_id bigint, zoom_value bigint")
    row = hexbin.hex_steps(points, zooms, hexbin.azimuth).first()
    assert (row.quad_row, row.quad_col, row.mod2_row) == (-9, -8, -1)
    assert row.azimuth == pytest.approx(14.39, abs=0.01)


def test_empty_points_drop_out_and_null_points_too(spark):
    points = point_df(spark, [(1, "a", "s", -97.2, 31.5), (1, "a", "t", None, None)])
    points = points.unionByName(points.where("site_id = 's'").withColumn("geom", F.lit(None).cast(points.schema["geom"].dataType)))
    zooms = spark.createDataFrame([(0, 100), (1, 50)], "zoom_id bigint, zoom_value bigint")
    assert hexbin.site_zoom(points, zooms).count() == 2


def test_long_zoom_table_matches_short_ones(spark):
    points = point_df(spark, [(1, "a", str(i), -97.0 - i, 31.0 + i) for i in range(5)])
    levels = [(i, 1_000_000 - 1000 * i) for i in range(200)]
    schema = "zoom_id bigint, zoom_value bigint"
    whole = hexbin.hex_bin(points, spark.createDataFrame(levels, schema)).collect()
    parts = []
    for start in range(0, 200, 50):
        parts += hexbin.hex_bin(points, spark.createDataFrame(levels[start : start + 50], schema)).collect()
    assert len(whole) == 1000
    assert sorted(whole) == sorted(parts)


def test_no_zoom_levels(spark):
    points = point_df(spark, [(1, "a", "s", -97.2, 31.5)])
    zooms = spark.createDataFrame([], "zoom_id bigint, zoom_value bigint")
    assert hexbin.hex_bin(points, zooms).count() == 0


def test_limit_is_optional(spark):
    points = point_df(spark, [(1, "a", str(i), -97.0, 31.0) for i in range(5)])
    zooms = spark.createDataFrame([(0, 100)], "zoom_id bigint, zoom_value bigint")
    assert hexbin.hex_bin(points, zooms, limit=2).count() == 2


def test_points_are_not_shuffled(spark):
    from tests.conftest import plan_of

    points = point_df(spark, [(1, "a", "s", -97.2, 31.5)])
    for n in (2, 65):
        zooms = spark.createDataFrame([(i, 100 + i) for i in range(n)], "zoom_id bigint, zoom_value bigint")
        plan = plan_of(hexbin.hex_bin(points, zooms))
        assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan
        assert hexbin.hex_bin(points, zooms).count() == n


def test_projection(spark):
    """Metres of the web map: the whole width is that of its square, latitudes beyond it are clipped."""
    rows = [(0, 0.0, 0.0), (1, 180.0, 85.05112877980659), (2, -180.0, -90.0), (3, 10.0, 89.9), (4, None, None)]
    df = spark.createDataFrame(rows, "i int, x double, y double").selectExpr("i", "named_struct('x', x, 'y', y) AS geom")
    got = {r.i: r.p for r in df.select("i", hexbin.web_mercator("geom").alias("p")).collect()}
    edge = 20037508.342789244
    assert abs(got[0].x) < 1e-6 and abs(got[0].y) < 1e-6
    assert abs(got[1].x - edge) < 1e-6 and abs(got[1].y - edge) < 1e-6
    assert abs(got[2].x + edge) < 1e-6 and abs(got[2].y + edge) < 1e-6
    assert abs(got[3].y - edge) < 1e-6 and tuple(got[4]) == (None, None)
