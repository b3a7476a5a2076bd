import importlib

import duckdb
import pytest
from pyspark.sql import functions as F

from perilgrid.functions.sql import create_feature_view, create_spatial_join_view, register
from perilgrid.operators.rollup import loss_rollup
from perilgrid.plans import inputs, reports
from perilgrid.plans.catalog import QUERIES
from perilgrid.plans.oracles import ORACLES
from tests.conftest import SF_DIR, plan_of

entry = importlib.import_module("__spark_entry__")
TABLES = "region nation customer supplier part orders lineitem".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF_DIR).toPandas()
    want = duck.execute(entry.oracle_sql()[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    got, want = (d[columns].sort_values(columns).reset_index(drop=True) for d in (got, want))
    assert len(got) == len(want)
    for c in columns:
        assert ((got[c] == want[c]) | (got[c].isna() & want[c].isna())).all(), c


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("by", ["portfolio_id", "site_id"])
def test_rollup_equals_the_fanned_out_join(spark, by):
    sites = spark.sql(
        """SELECT * FROM VALUES (1, 'a', 10D), (1, 'a', 20D), (2, 'a', 5D), (2, 'b', NULL), (2, 'c', 7D),
           (3, 'd', NULL), (3, NULL, 4D), (NULL, 'a', 1D) t(portfolio_id, site_id, s_udf_met1)"""
    )
    losses = spark.sql(
        "SELECT * FROM VALUES ('a', 1D), ('a', 2D), ('a', NULL), ('b', 3D), ('c', NULL), ('z', 9D), (NULL, 8D) t(site_id, gross_loss)"
    )
    joined = sites.join(losses, "site_id", "left").groupBy(by)
    plain = joined.agg(F.sum("s_udf_met1"), F.avg("s_udf_met1"), F.sum("gross_loss"))
    key = lambda r: str(r[0])
    assert sorted(map(tuple, loss_rollup(sites, losses, by).collect()), key=key) == sorted(map(tuple, plain.collect()), key=key)


def test_rollup_joins_reduced_rows_only(spark):
    sites = spark.range(30000).selectExpr("id % 3 AS portfolio_id", "'hot' AS site_id", "1D AS s_udf_met1")
    losses = spark.range(30000).selectExpr("'hot' AS site_id", "2D AS gross_loss")
    rows = {r.portfolio_id: r for r in loss_rollup(sites, losses, "portfolio_id").collect()}
    assert rows[0].sum_s_udf_met1 == 10000.0 * 30000 and rows[0].sum_gross_loss == 2.0 * 10000 * 30000
    assert rows[0].avg_s_udf_met1 == 1.0


def test_histogram_filter_moves_below_the_aggregate(spark):
    from perilgrid.session import new_dir
    from perilgrid.sources.feature_table import read_feature_table, write_feature_table

    root = new_dir(spark, "hist")
    write_feature_table(inputs.sites(spark, SF_DIR), root, "siteexposure_event")
    df = reports.coverage_histogram(read_feature_table(spark, root, "siteexposure_event"), portfolio_id=51326, n=100)
    plan = plan_of(df)
    assert "EqualTo(portfolio_id,51326)" in plan and "TakeOrderedAndProject" in plan
    assert [r.BIN for r in df.collect()] == [1]  # the default range is far wider than the values


def test_grid_match_ignores_keys_that_are_not_numbers(spark):
    sites = inputs.sites(spark, SF_DIR)
    odd = sites.withColumn("nz_grid_id", F.when(F.col("portfolio_id") == 51325, F.lit("12a")).otherwise(F.col("nz_grid_id")))
    grid = inputs.grid(spark, SF_DIR)
    assert reports.grid_match(odd, grid).where("portfolio_id = 51325").count() == 0
    assert reports.grid_count(sites, grid).first()[0] == 5082
    split = reports.grid_match(sites, grid, broadcast_bytes=0, left_rows=20, right_rows=1)
    assert split.count() == 5082


def test_histogram_keeps_every_bin(spark):
    """99 buckets, both outer ones: 101 bins, the largest values among them."""
    sites = spark.range(-1, 101).selectExpr(
        "1L AS portfolio_id", "CAST(id AS STRING) AS site_id", "CAST(id AS DOUBLE) + 0.5D AS cov1val",
        "0D AS cov2val", "0D AS cov3val", "0D AS cov4val",
    )
    bins = [r.BIN for r in reports.coverage_histogram(sites, 0.0, 99.0, 99).collect()]
    assert bins == list(range(101))


def test_spatial_functions_in_sql(spark):
    register(spark)
    create_feature_view(inputs.sites(spark, SF_DIR), "places")
    create_feature_view(inputs.footprints(spark, SF_DIR), "burnt")
    count = lambda text: spark.sql(f"SELECT count(*) FROM {text}").first()[0]
    for test in ("st_intersects(p.geom, b.geometry)", "st_intersects(b.geometry, p.geom)", "st_contains(b.geometry, p.geom)"):
        assert count(f"burnt AS b JOIN places AS p ON {test}") == 349
    assert count("places WHERE st_intersects(geom, st_makeBBOX(-96, 29, -94, 31))") == 272
    assert count("places WHERE st_contains(st_makeBBOX(-96, 29, -94, 31), geom)") <= 272
    assert count("places WHERE NOT st_isempty(geom) AND st_y(geom) > 27 AND st_x(geom) < -90") > 5900


def test_spatial_join_view(spark):
    """The scalable join under a name that SQL can use."""
    register(spark)
    sites, fires = inputs.sites(spark, SF_DIR), inputs.footprints(spark, SF_DIR)
    sites.createOrReplaceTempView("site_rows")
    fires.select("OBJECTID", "geometry").createOrReplaceTempView("fire_rows")
    create_spatial_join_view(spark, "site_fire", "site_rows", "fire_rows", "contains")
    df = spark.sql("SELECT portfolio_id, count(OBJECTID) AS n FROM site_fire GROUP BY portfolio_id")
    assert sum(r.n for r in df.collect()) == 349
    assert "BroadcastNestedLoopJoin" not in plan_of(df) and "CartesianProduct" not in plan_of(df)


@pytest.mark.parametrize("few", [-1, 100])
def test_footprints_at_site(spark, monkeypatch, few):
    """Direct tests and tiles agree, for one site, many rows of a site, and none."""
    monkeypatch.setattr(reports, "FEW_POINTS", few)
    sites, fires = inputs.sites(spark, SF_DIR), inputs.footprints(spark, SF_DIR)
    one_site = sites.withColumn("site_id", F.lit("all"))
    assert reports.footprints_at_site(one_site, fires, "all").count() == 349
    assert reports.footprints_at_site(sites, fires, "no such site").count() == 0
