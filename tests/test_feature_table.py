import re

import pytest
from pyspark.sql import functions as F

from perilgrid.functions.geometry import Box
from perilgrid.functions.sql import create_feature_view, register
from perilgrid.plans import inputs, reports
from perilgrid.schema import FEATURE_TYPES, FID
from perilgrid.session import new_dir
from perilgrid.sources.feature_table import conform, export_csv, read_feature_table, write_feature_table
from tests.conftest import SF_DIR, plan_of


@pytest.fixture(scope="module")
def stored(spark):
    root = new_dir(spark, "sites")
    write_feature_table(inputs.sites(spark, SF_DIR), root, "siteexposure_event", cluster_tile=2.0, files=6)
    return root


def test_box_scan_is_pushed_down_and_pruned(spark, stored):
    plan = plan_of(reports.box_scan(read_feature_table(spark, stored, "siteexposure_event")))
    pushed = re.search(r"PushedFilters: \[(.*?)\]\n", plan).group(1)
    for part in ("GreaterThanOrEqual(geom.x,-96.0)", "LessThanOrEqual(geom.x,-94.0)", "GreaterThanOrEqual(geom.y,29.0)", "LessThanOrEqual(geom.y,31.0)"):
        assert part in pushed
    schema = re.search(r"ReadSchema: (.*)", plan).group(1)
    assert schema == "struct<portfolio_id:bigint,account_id:string,site_id:string,s_udf_met1:double,geom:struct<x:double,y:double>>"


def test_attribute_filter_is_pushed_down(spark, stored):
    plan = plan_of(reports.portfolio_scan(read_feature_table(spark, stored, "siteexposure_event"), 51325).select("site_id"))
    assert "EqualTo(portfolio_id,51325)" in plan
    assert "ReadSchema: struct<portfolio_id:bigint,site_id:string>" in plan


def test_sql_box_test_is_pushed_down_too(spark, stored):
    register(spark)
    create_feature_view(read_feature_table(spark, stored, "siteexposure_event"), "stored_sites")
    df = spark.sql("SELECT site_id FROM stored_sites WHERE bbox(geom, -94, 31, -96, 29)")
    plan = plan_of(df)
    assert "GreaterThanOrEqual(geom.x,-96.0)" in plan and "LessThanOrEqual(geom.y,31.0)" in plan
    assert df.count() == 272


def test_clustered_files_cover_small_areas(spark, stored):
    area = (F.max("geom.x") - F.min("geom.x")) * (F.max("geom.y") - F.min("geom.y"))
    df = read_feature_table(spark, stored, "siteexposure_event")
    areas = [r[1] for r in df.groupBy(F.input_file_name()).agg(area).collect()]
    assert len(areas) > 3 and max(areas) < 80 / 2
    assert df.count() == 6000


def test_partitioned_directories(spark):
    root = new_dir(spark, "bins")
    rows = spark.range(100).selectExpr("1L AS portfolio_id", "'a' AS account_id", "CAST(id AS STRING) AS site_id", "id % 4 AS lod", "id AS arow", "id AS acol")
    write_feature_table(rows, root, "txmsitehexbinevent", partition_by=["lod"])
    back = read_feature_table(spark, root, "txmsitehexbinevent").where("lod = 2")
    assert back.count() == 25
    assert back.columns == [FID, *FEATURE_TYPES["txmsitehexbinevent"].schema.fieldNames()]
    assert re.search(r"PartitionFilters: \[isnotnull\(lod.*lod.* = 2", plan_of(back))


def test_conform_orders_fills_and_identifies(spark):
    df = spark.sql("SELECT 's' AS site_id, 1 AS portfolio_id")
    out = conform(df, "txmsiteexposureevent")
    assert out.columns == [FID, "portfolio_id", "site_id", "g_country_id", "geo_unit_id"]
    row = out.first()
    assert len(row[FID]) == 32 and row.portfolio_id == 1 and row.geo_unit_id is None
    with pytest.raises(ValueError, match="not in feature type"):
        conform(df.withColumn("other", F.lit(1)), "txmsiteexposureevent")
    with pytest.raises(ValueError, match="unknown feature type"):
        conform(df, "nothing")


def test_append_and_overwrite(spark):
    root = new_dir(spark, "modes")
    df = spark.sql("SELECT 1L AS zoom_id, 10L AS zoom_value")
    for mode, n in (("append", 1), ("append", 2), ("overwrite", 1)):
        write_feature_table(df, root, "hexzoomevent", mode=mode)
        assert read_feature_table(spark, root, "hexzoomevent").count() == n
    with pytest.raises(ValueError, match="no geometry"):
        write_feature_table(df, root, "hexzoomevent", cluster_tile=1.0)


def test_csv_export_refuses_nested_columns(spark):
    with pytest.raises(ValueError, match="geom"):
        export_csv(inputs.sites(spark, SF_DIR), new_dir(spark, "csv"))


def test_box_scan_equals_filter(spark, stored):
    df = read_feature_table(spark, stored, "siteexposure_event")
    inside = df.where("geom.x > -96 AND geom.x < -94 AND geom.y > 29 AND geom.y < 31").count()
    assert df.where(Box(-94, 31, -96, 29).contains(F.col("geom"))).count() == inside


def test_saved_reports_have_unique_ids(spark):
    from perilgrid.plans.catalog import QUERIES

    for name in ("grid_enrich_saved", "hex_bin_saved"):
        saved = QUERIES[name](spark, SF_DIR)
        assert saved.select(FID).distinct().count() == saved.count() > 0
