"""Loads that run again, incremental loads, and the layout of tables written by feature id."""

import os

import pytest
from pyspark.sql import functions as F

from perilgrid.schema import FEATURE_TYPES, FID
from perilgrid.session import new_dir
from perilgrid.sources import ingest
from perilgrid.sources.feature_table import read_feature_table, upsert_feature_table, write_feature_table

ZOOM = "hexzoomevent"


def zooms(spark, rows):
    return spark.createDataFrame(rows, f"{FID} string, zoom_id bigint, zoom_value bigint")


def stored(spark, root):
    return sorted(map(tuple, read_feature_table(spark, root, ZOOM).collect()))


def test_upsert_replaces_by_id(spark):
    root = new_dir(spark, "upsert")
    first = [(str(i), i, 10 * i) for i in range(200)]
    later = [(str(i), i, 11 * i) for i in range(150, 250)]
    for rows in (first, first, later, later):
        upsert_feature_table(zooms(spark, rows), root, ZOOM, buckets=8)
    assert stored(spark, root) == sorted([*first[:150], *later])
    upsert_feature_table(zooms(spark, []), root, ZOOM, buckets=8)
    assert len(stored(spark, root)) == 250


def test_only_touched_directories_are_written(spark):
    root = new_dir(spark, "touched")
    path = upsert_feature_table(zooms(spark, [(str(i), i, i) for i in range(100)]), root, ZOOM, buckets=16)
    before = {f for _, _, files in os.walk(path) for f in files if f.startswith("part-")}
    upsert_feature_table(zooms(spark, [("5", 5, 500)]), root, ZOOM, buckets=16)
    after = {f for _, _, files in os.walk(path) for f in files if f.startswith("part-")}
    assert len(before - after) <= 2 and dict((r[0], r[2]) for r in stored(spark, root))["5"] == 500


def test_copies_and_nulls(spark):
    root = new_dir(spark, "copies")
    rows = [("a", 1, 1), ("a", 1, 2), ("a", 1, 3), ("b", 2, 2), ("b", 2, 2)]
    for _ in range(2):
        upsert_feature_table(zooms(spark, rows).repartition(3), root, ZOOM)
        kept = stored(spark, root)
        assert [r[0] for r in kept] == ["a", "b"] and kept[0] in rows
    with pytest.raises(Exception, match="feature id is null"):
        upsert_feature_table(zooms(spark, [(None, 1, 1)]), root, ZOOM)
    assert stored(spark, root) == kept


def test_failed_load_leaves_no_doubles(spark):
    root = new_dir(spark, "failed")
    rows = [(str(i), i, i) for i in range(50)]
    upsert_feature_table(zooms(spark, rows[:25]), root, ZOOM, buckets=4)
    bad = zooms(spark, rows).withColumn("zoom_value", F.expr("CASE WHEN zoom_id = 40 THEN raise_error('lost') ELSE zoom_value END"))
    with pytest.raises(Exception, match="lost"):
        upsert_feature_table(bad, root, ZOOM, buckets=4)
    assert stored(spark, root) == sorted(rows[:25])
    upsert_feature_table(zooms(spark, rows), root, ZOOM, buckets=4)
    assert stored(spark, root) == sorted(rows)


def test_appended_tables_are_refused(spark):
    root = new_dir(spark, "appended")
    write_feature_table(zooms(spark, [("1", 1, 1)]), root, ZOOM)
    with pytest.raises(ValueError, match="not written by feature id"):
        upsert_feature_table(zooms(spark, [("1", 1, 1)]), root, ZOOM)


def test_load_twice(spark, tmp_path):
    path = tmp_path / "zooms.txt"
    path.write_text("1|10\n2|20\nbad|line|5\n2|20\n")
    root = new_dir(spark, "load-twice")
    for _ in range(2):
        rows = ingest.ingest_text(spark, str(path), ZOOM, ["zoom_id"])
        assert ingest.load(rows, root, ZOOM, quarantine=f"{root}/bad", mode="upsert") == (3, 1)
    assert [r[0] for r in stored(spark, root)] == ["1", "2"]
    assert spark.read.parquet(f"{root}/bad").count() == 1


def drop(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(f"{line}\n" for line in lines))


def test_new_files_are_loaded_once(spark, tmp_path):
    folder, root = tmp_path / "in", new_dir(spark, "incremental")
    again = lambda: ingest.ingest_new_files(spark, str(folder), root, ZOOM, f"{root}/state", files_per_batch=2, key_columns=["zoom_id"], header=False)
    drop(folder, "a.txt", ["1|10", "2|20"])
    drop(folder, "b.txt", ["3|30", "x|y|z", ""])
    drop(folder, "c.txt", [])
    counts = {os.path.basename(r.file): (r.written, r.failed) for r in again().collect()}
    assert counts == {"a.txt": (2, 0), "b.txt": (1, 2)}
    drop(folder, "d e%.txt", ["4|40", "2|21"])
    for _ in range(2):
        counts = {os.path.basename(r.file): (r.written, r.failed) for r in again().collect()}
        assert len(counts) == 3 and counts["d%20e%25.txt"] == (2, 0)
    assert [r[1:] for r in stored(spark, root)] == [(1, 10), (2, 21), (3, 30), (4, 40)]


def test_cut_off_batch_is_done_again(spark, tmp_path, monkeypatch):
    folder, root = tmp_path / "in", new_dir(spark, "restart")
    drop(folder, "a.txt", ["1|10", "2|20"])
    run = lambda: ingest.ingest_new_files(spark, str(folder), root, ZOOM, f"{root}/state", key_columns=["zoom_id"], header=False)
    plain = ingest.drop_dir

    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "drop_dir", lost)  # after the rows are written, before the batch is committed
    with pytest.raises(Exception, match="lost"):
        run()
    monkeypatch.setattr(ingest, "drop_dir", plain)
    assert [(r.written, r.failed) for r in run().collect()] == [(2, 0)]
    assert [r[1:] for r in stored(spark, root)] == [(1, 10), (2, 20)]


def test_stored_columns(spark):
    root = new_dir(spark, "columns")
    upsert_feature_table(zooms(spark, [("1", 1, 1)]), root, ZOOM)
    assert read_feature_table(spark, root, ZOOM).columns == [FID, *FEATURE_TYPES[ZOOM].schema.fieldNames()]
