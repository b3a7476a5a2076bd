"""Work that grows with the input and not faster: rows compared, bytes written and shuffled, expressions compiled."""

import os
import random
import uuid

from pyspark.sql import functions as F

from perilgrid.functions.curve import hilbert_key
from perilgrid.functions.exact import carried, limb_sums
from perilgrid.functions.geometry import multi_polygon
from perilgrid.functions.sql import create_feature_view, register
from perilgrid.operators.polygon_join import polygon_join
from perilgrid.schema import FID
from perilgrid.session import new_dir
from perilgrid.sources import catalog_tables, feature_table
from perilgrid.sources.catalog_tables import create_bucketed_table
from perilgrid.sources.delimited import read_fields, write_delimited
from perilgrid.sources.feature_table import read_feature_table, upsert_feature_table
from tests.conftest import plan_of

PLACED = [549755813888, 549786346499, 550071564952, 553855638772]


def test_cells_leave_out_what_a_polygon_cannot_touch(spark):
    register(spark)
    triangle = "array(array(named_struct('x', {0}, 'y', 0D), named_struct('x', {1}, 'y', 0D), named_struct('x', {0}, 'y', {2}), named_struct('x', {0}, 'y', 0D)))"
    two = f"array({triangle.format('0D', '4D', '4D')}, {triangle.format('5D', '6D', '1D')})"
    create_feature_view(spark.range(1).select(multi_polygon(two).alias("geometry")), "triangles")
    cells = spark.sql("SELECT c.* FROM triangles, LATERAL st_cells(geometry, -2, 5) c").collect()
    assert {r.level for r in cells} == {0} and len({(r.cx, r.cy) for r in cells}) == len(cells)
    assert {(5, 0), (0, 0), (0, 3), (3, 0), (1, 1)} <= {(r.cx, r.cy) for r in cells}
    assert not {(3, 3), (2, 3), (6, 3)} & {(r.cx, r.cy) for r in cells}
    rng = random.Random(4)
    points = [(i, rng.uniform(-1, 7), rng.uniform(-1, 5)) for i in range(500)]
    places = spark.createDataFrame(points, "pid long, x double, y double").selectExpr("pid", "named_struct('x', x, 'y', y) AS geom")
    create_feature_view(places, "triangle_places")
    joined = spark.sql(
        """SELECT pid FROM (SELECT pid, geom, c.* FROM triangle_places, LATERAL st_point_cells(geom, -2, 5) c)
           JOIN (SELECT geometry, c.* FROM triangles, LATERAL st_cells(geometry, -2, 5) c) USING (level, cx, cy)
           WHERE st_intersects(geom, geometry)"""
    )
    condition = [line for line in plan_of(joined).splitlines() if line.startswith("Join condition")][-1]
    assert "cast(geometry" not in condition  # no copy of the segments for each pair
    want = [i for i, x, y in points if (x >= 0 and y >= 0 and x + y <= 4) or (x >= 5 and y >= 0 and x - 5 + y <= 1)]
    assert sorted(r.pid for r in joined.collect()) == want


def test_hilbert_key_compiles(spark):
    rows = spark.range(10).selectExpr("CAST(id AS DOUBLE) AS x", "CAST(id * id AS DOUBLE) AS y")
    keyed = rows.select(hilbert_key("x", "y").alias("k"))
    assert "lambda" not in plan_of(keyed) and keyed.where("k IS NULL").count() == 0
    # numbers as the loop over single bits gave them
    assert [r.k for r in keyed.limit(4).collect()] == PLACED


def test_reload_shuffles_no_whole_rows(spark):
    """A load that replaces rows, adds some and holds copies, large enough to be written without a shuffle."""
    root = new_dir(spark, "wide")
    rows = spark.range(3000).selectExpr(f"sha2(CAST(id AS STRING), 256) AS {FID}", "id AS zoom_id", "id * 10 AS zoom_value")
    plain = feature_table.BROADCAST_BYTES
    try:
        for limit in (plain, 0):  # hashes broadcast or shuffled, files rebalanced or not
            feature_table.BROADCAST_BYTES = limit
            path = f"{root}/{limit}"
            upsert_feature_table(rows.where("zoom_id < 2000"), path, "hexzoomevent", buckets=4)
            later = rows.where("zoom_id >= 1000").withColumn("zoom_value", F.col("zoom_value") + 1)
            upsert_feature_table(later.unionByName(later.where("zoom_id % 3 = 0")), path, "hexzoomevent", buckets=4)
            got = {r.zoom_id: r.zoom_value for r in read_feature_table(spark, path, "hexzoomevent").collect()}
            assert got == {i: 10 * i + (i >= 1000) for i in range(3000)}
            assert read_feature_table(spark, path, "hexzoomevent").count() == 3000
    finally:
        feature_table.BROADCAST_BYTES = plain


def test_text_files_are_compressed_and_bounded(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 2).selectExpr("id", "repeat('NULL', 50) AS a")
    for header in (True, False):
        path = write_delimited(rows, str(tmp_path / f"text-{header}"), header, rows_per_file=200)
        files = [f for f in os.listdir(path) if f.startswith("part-")]
        assert len(files) == 6 and all(f.endswith(".gz") for f in files)
        assert sum(os.path.getsize(os.path.join(path, f)) for f in files) < 20_000
        fields = read_fields(spark, path, header).selectExpr("CAST(fields[0] AS BIGINT) AS id")
        assert sorted(r.id for r in fields.collect()) == list(range(1000))


def test_carried_limbs_compile(spark):
    rows = spark.createDataFrame([(1, 2.0**40), (1, -3.5), (2, -1e-3)], "k long, v double")
    sums = rows.groupBy("k").agg(limb_sums("v").alias("s")).select("k", carried("s").alias("s"))
    assert "lambda" not in plan_of(sums)
    got = {r.k: r.s.limbs for r in sums.collect()}
    assert all(0 <= limb < 1 << 24 for limbs in got.values() for limb in limbs[:-1])
    assert [got[k][-1] for k in (1, 2)] == [0, -1] and all(len(limbs) == 13 for limbs in got.values())


def test_polygon_pairs_are_dealt_evenly(spark):
    squares = spark.range(30).selectExpr("id AS a", "array(array({})) AS parts".format(
        "array(" + ", ".join(f"named_struct('x', CAST(id AS DOUBLE) + {x}D, 'y', {y}D)" for x, y in ((0, 0), (1.5, 0), (1.5, 1), (0, 1), (0, 0))) + ")"
    )).select("a", multi_polygon("parts").alias("geometry")).coalesce(1)
    pairs = polygon_join(squares, squares.withColumnRenamed("a", "b"))
    assert "RoundRobinPartitioning" in plan_of(pairs)
    assert sorted(map(tuple, pairs.collect())) == [(a, b) for a in range(30) for b in range(30) if abs(a - b) <= 1]
    apart = polygon_join(squares, squares.withColumnRenamed("a", "b"), broadcast_bytes=0, left_rows=3)
    assert sorted(map(tuple, apart.collect())) == sorted(map(tuple, pairs.collect()))


def test_large_buckets_are_several_files(spark, monkeypatch):
    monkeypatch.setattr(catalog_tables, "ROWS_PER_FILE", 100)
    table = f"bucketed_{uuid.uuid4().hex}"
    rows = spark.range(1000).selectExpr(f"CAST(id AS STRING) AS {FID}", "CAST(id % 300 AS STRING) AS site_id", "id AS portfolio_id")
    try:
        stored = create_bucketed_table(rows, "sitelossanalyzevent", table, ["site_id"], 4)
        files = stored.selectExpr("input_file_name() AS f", "site_id").groupBy("f").agg(F.collect_list("site_id").alias("s")).collect()
        assert 4 < len(files) <= 12 and all(list(r.s) == sorted(r.s) for r in files)
        grouped = stored.groupBy("site_id").count()
        assert "hashpartitioning" not in plan_of(grouped)
        assert sorted(r["count"] for r in grouped.collect()) == sorted([4] * 100 + [3] * 200)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
