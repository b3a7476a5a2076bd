import random

import pytest
from pyspark.sql import functions as F

from perilgrid.functions.curve import WORLD, hilbert_key
from perilgrid.functions.geometry import Box
from perilgrid.plans import inputs
from perilgrid.session import new_dir
from perilgrid.sources.feature_table import read_feature_table, write_feature_table
from tests.conftest import SF_DIR

SITE = "siteexposure_event"


def keys(spark, cells, bits):
    rows = spark.createDataFrame(cells, "x double, y double")
    extent = (0.0, 0.0, float(1 << bits), float(1 << bits))
    return {(r.x, r.y): r.k for r in rows.select("*", hilbert_key("x", "y", bits, extent).alias("k")).collect()}


@pytest.mark.parametrize("bits", [1, 2, 5])
def test_curve_visits_every_cell_and_steps_to_neighbours(spark, bits):
    n = 1 << bits
    got = keys(spark, [(float(x), float(y)) for x in range(n) for y in range(n)], bits)
    walk = sorted(got, key=got.get)
    assert sorted(got.values()) == list(range(n * n)) and walk[0] == (0.0, 0.0)
    assert all(abs(ax - bx) + abs(ay - by) == 1 for (ax, ay), (bx, by) in zip(walk, walk[1:], strict=False))


def test_quarters_nest(spark):
    """A coarser key is the head of a finer one up to the turn of the whole curve."""
    rng = random.Random(1)
    cells = [(rng.uniform(0, 64), rng.uniform(0, 64)) for _ in range(500)]
    rows = spark.createDataFrame(cells, "x double, y double")
    extent = (0.0, 0.0, 64.0, 64.0)
    pairs = rows.select(*[hilbert_key("x", "y", b, extent).alias(f"k{b}") for b in (6, 8)]).collect()
    assert all(r.k6 == r.k8 >> 4 for r in pairs)


def test_border_null_and_nan(spark):
    rows = spark.sql(
        """SELECT * FROM VALUES (1, -500D, -500D), (2, -180D, -90D), (3, 500D, 0D), (4, 180D, 0D), (5, NULL, 1D),
           (6, double('NaN'), 1D), (7, double('Infinity'), 0D) t(id, x, y)"""
    )
    got = {r.id: r.k for r in rows.select("id", hilbert_key("x", "y").alias("k")).collect()}
    assert got[1] == got[2] == 0 and got[3] == got[4] == got[7] and got[5] is None and got[6] is None
    with pytest.raises(ValueError):
        hilbert_key("x", "y", 32, WORLD)


def rows_scanned(df):
    """Rows that the Parquet scan of a query hands on: those of the row groups that its filter leaves."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    nodes, total = [plan], 0
    while nodes:
        node = nodes.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            nodes.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return total


def test_box_reads_fewer_rows_than_with_tiles(spark):
    sites = inputs.sites(spark, SF_DIR)
    layouts = {}
    for name, how in (("tiles", {"cluster_tile": 0.25}), ("curve", {"cluster_curve": True})):
        root = new_dir(spark, name)
        write_feature_table(sites, root, SITE, files=64, **how)
        layouts[name] = read_feature_table(spark, root, SITE)
    e = sites.selectExpr("min(geom.x) AS x0", "max(geom.x) AS x1", "min(geom.y) AS y0", "max(geom.y) AS y1").first()
    rng, scanned = random.Random(2), dict.fromkeys(layouts, 0)
    for _ in range(6):
        w, h = (e.x1 - e.x0) / 8, (e.y1 - e.y0) / 8
        x, y = rng.uniform(e.x0, e.x1 - w), rng.uniform(e.y0, e.y1 - h)
        box = Box(x, y, x + w, y + h)
        found = {}
        for name, table in layouts.items():
            df = table.where(box.intersects(F.col("geom"))).select("__fid__")
            scanned[name] += rows_scanned(df)
            found[name] = sorted(r[0] for r in df.collect())
        assert found["tiles"] == found["curve"]
    assert scanned["curve"] < 0.7 * scanned["tiles"], scanned


def test_polygons_and_rows_without_a_place(spark):
    root = new_dir(spark, "curve")
    fires = inputs.footprints(spark, SF_DIR).limit(40)
    write_feature_table(fires, root, "wildfireevent", cluster_curve=True)
    assert read_feature_table(spark, root, "wildfireevent").count() == fires.count()
    sites = inputs.sites(spark, SF_DIR).limit(20).withColumn("geom", F.lit(None).cast("struct<x:double,y:double>"))
    write_feature_table(sites, root, SITE, cluster_curve=True)
    assert read_feature_table(spark, root, SITE).where("geom IS NULL").count() == 20
    with pytest.raises(ValueError, match="not both"):
        write_feature_table(sites, root, SITE, cluster_curve=True, cluster_tile=1.0)
