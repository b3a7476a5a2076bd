import json

import pytest
from pyspark.sql import functions as F

from perilgrid.schema import FEATURE_TYPES, FID
from perilgrid.session import new_dir
from perilgrid.sources import ingest
from perilgrid.sources.delimited import read_fields, write_delimited
from perilgrid.sources.feature_table import read_feature_table

SITE = "siteexposure_event"
N_SITE = 106


def site_line(**values):
    names = FEATURE_TYPES[SITE].schema.fieldNames()[:N_SITE]
    fields = {"portfolio_id": "3", "site_id": "s1", "shape": "POINT(-97.5 31.5)", "site_lat": "31.5", "site_long": "-97.5"}
    fields.update(values)
    return "|".join(fields.get(n, "") for n in names)


@pytest.fixture
def text_file(spark, tmp_path):
    def write(*lines, name="in.txt"):
        path = tmp_path / name
        path.write_text("".join(line + "\n" for line in lines))
        return str(path)

    return write


def test_fields_keep_empties_quotes_and_order(spark, text_file):
    path = text_file("h1|h2|h3", 'a|"b|', "|c|NULL", " x |y|z|more")
    rows = [r.fields for r in read_fields(spark, path, header=True).collect()]
    assert rows == [["a", '"b', ""], ["", "c", "NULL"], [" x ", "y", "z", "more"]]
    assert read_fields(spark, path, header=False).count() == 4


def test_one_header_per_file(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"part{i}.txt").write_text(f"zoom_id|zoom_value\n{i}|{100 * i}\n")
    df = ingest.ingest_text(spark, str(tmp_path), "hexzoomevent", ["zoom_id"], header=True)
    assert sorted((r[FID], r.zoom_value) for r in df.collect()) == [("0", 0), ("1", 100), ("2", 200)]


def test_site_row(spark, text_file):
    path = text_file("header", site_line(cov1val="12.5", premium="NULL", currency="NULL", lob1="", blg_num="x7", s_udf_attr10="tail", site_comments="note"))
    row = ingest.ingest_text(spark, path, SITE, ["portfolio_id", "site_id"]).first()
    assert row[FID] == "1:32:s1" and row["_ok"] and row.geo_valid
    assert tuple(row.geom) == (-97.5, 31.5) and tuple(row.shapegeom) == (-97.5, 31.5)
    assert (row.cov1val, row.premium, row.currency, row.lob1, row.blg_num) == (12.5, None, "NULL", "", None)
    assert (row.s_udf_attr10, row.site_comments) == ("tail", "note")


def test_legacy_drop_tail_leaves_two_fields_out(spark, text_file):
    path = text_file("header", site_line(s_udf_attr9="kept", s_udf_attr10="tail", site_comments="note"))
    row = ingest.ingest_text(spark, path, SITE, ["site_id"], legacy_drop_tail=True).first()
    assert (row.s_udf_attr9, row.s_udf_attr10, row.site_comments) == ("kept", None, None)


def test_unparsable_and_out_of_range_coordinates(spark, text_file):
    path = text_file(
        "header",
        site_line(site_id="a", site_lat="n/a"),
        site_line(site_id="b", site_long=""),
        site_line(site_id="c", site_lat="91.0"),
        site_line(site_id="d", site_long="-180.5"),
    )
    rows = {r.site_id: r for r in ingest.ingest_text(spark, path, SITE, ["site_id"]).collect()}
    assert tuple(rows["a"].geom) == (-97.5, 0.0) and rows["a"].site_lat is None and rows["a"].geo_valid
    assert tuple(rows["b"].geom) == (0.0, 31.5)
    assert not rows["c"].geo_valid and not rows["d"].geo_valid
    assert all(r["_ok"] for r in rows.values())


def test_short_long_and_broken_lines(spark, text_file):
    path = text_file(
        "header",
        site_line(site_id="good"),
        "|".join(site_line(site_id="short").split("|")[:12]),
        "|".join(site_line(site_id="stub").split("|")[:9]),
        site_line(site_id="long") + "|extra",
        site_line(site_id="shape", shape="POINT(-97.5"),
    )
    df = ingest.ingest_text(spark, path, SITE, ["site_id"])
    rows = {r.site_id: r for r in df.collect()}
    assert {k: r["_ok"] for k, r in rows.items()} == {"good": True, "short": True, "stub": False, "long": False, "shape": False}
    assert rows["short"].country_id is None and rows["short"].currency is None
    assert tuple(ingest.quality_counts(df).first()) == (2, 3)


@pytest.mark.parametrize("quarantine", [True, False])
@pytest.mark.parametrize("cluster_tile", [None, 1.0])
def test_load_counts_and_quarantine(spark, text_file, quarantine, cluster_tile):
    path = text_file("header", site_line(site_id="a"), site_line(site_id="b"), site_line(site_id="c", shape="?"))
    root = new_dir(spark, "load")
    aside = f"{root}/aside" if quarantine else None
    df = ingest.ingest_text(spark, path, SITE, ["site_id"])
    assert ingest.load(df, root, SITE, quarantine=aside, cluster_tile=cluster_tile) == (2, 1)
    assert ingest.load(df, root, SITE, quarantine=aside, cluster_tile=cluster_tile) == (2, 1)
    stored = read_feature_table(spark, root, SITE)
    assert sorted(r.site_id for r in stored.collect()) == ["a", "a", "b", "b"]  # loads append
    if quarantine:
        assert [r.shape for r in spark.read.parquet(aside).collect()] == ["?", "?"]


def test_scientific_notation_and_separator(spark, text_file):
    path = text_file("51330,3,s1,a1,3,3,3,7.3004395454316001E-2,7.3E-2,1e2,1,ATC,1,RMS")
    row = ingest.ingest_text(spark, path, "sitelossanalyzevent", sep=",").first()
    assert (row.gross_loss, row.net_loss, row.const_ind, row["_ok"]) == (0.073004395454316001, 100.0, "RMS", True)


def test_grid_polygon_from_text(spark, text_file):
    fields = ["1"] * 20 + ["POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))"]
    path = text_file("header", "|".join(fields), "|".join(fields[:20] + ["POLYGON ((0 0, 1 0"]))
    rows = ingest.ingest_text(spark, path, "nzgrid_event", ["nz_grid_id"]).orderBy(F.desc("_ok")).collect()
    assert tuple(rows[0].SHAPE.bbox) == (0.0, 0.0, 1.0, 1.0) and rows[1].SHAPE is None
    assert [r["_ok"] for r in rows] == [True, False]


def test_line_hash_is_the_default_id(spark, text_file):
    path = text_file("1|10", "2|20", "1|10")
    ids = [r[FID] for r in ingest.ingest_text(spark, path, "hexzoomevent").collect()]
    assert len(set(ids)) == 2 and all(len(i) == 64 for i in ids)


RING = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
HOLE = [[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]


def feature(oid, coordinates=(RING,), kind="Polygon", **properties):
    props = {"OBJECTID": oid, "FIRE_NAME": f"fire {oid}", "SHAPE.STArea": 16.5, **properties}
    return {"type": "Feature", "properties": props, "geometry": {"type": kind, "coordinates": list(coordinates)}}


FEATURES = [
    feature(1, YEAR_=2000),
    feature(2, (RING, HOLE)),
    feature(3, (RING[:-1],)),  # not closed
    feature(4, kind="MultiPoint"),
    {"type": "Feature", "properties": {"OBJECTID": 5}, "geometry": None},
]


def check_features(df):
    rows = {r.OBJECTID: r for r in df.collect()}
    assert {k: r["_ok"] for k, r in rows.items() if k} == {1: True, 2: True, 3: False, 4: False, 5: False}
    assert rows[1]["SHAPE.STArea"] == 16.5 and rows[1].FIRE_NAME == "fire 1" and rows[1].YEAR_ == "2000"
    assert [len(r) for r in rows[2].geometry.rings] == [5, 5]
    assert tuple(rows[2].geometry.bbox) == (0.0, 0.0, 4.0, 4.0)


def test_geojson_collection(spark, text_file):
    path = text_file(json.dumps({"type": "FeatureCollection", "features": FEATURES}, indent=1))
    df = ingest.ingest_geojson(spark, path, layout="collection")
    check_features(df)
    assert tuple(ingest.quality_counts(df).first()) == (2, 3)


def test_geojson_one_feature_per_line(spark, text_file):
    lines = ['{"type": "FeatureCollection", "name": "fires", "features": [']
    lines += [json.dumps(f) + "," for f in FEATURES[:-1]] + [json.dumps(FEATURES[-1]), "]", "}"]
    check_features(ingest.ingest_geojson(spark, text_file(*lines[:-2], "]}"), layout="lines"))
    plain = ingest.ingest_geojson(spark, text_file(*[json.dumps(f) for f in FEATURES], name="nd.json"), key_columns=["OBJECTID"])
    check_features(plain)
    assert sorted(r[FID] for r in plain.collect()) == ["1", "2", "3", "4", "5"]


def test_geojson_common_layout(spark, text_file):
    lines = ["{", '"type": "FeatureCollection",', '"name": "fires",', '"crs": { "type": "name", "properties": { "name": "CRS84" } },', '"features": [']
    lines += [json.dumps(f) + "," for f in FEATURES[:-1]] + [json.dumps(FEATURES[-1]), "]", "}"]
    df = ingest.ingest_geojson(spark, text_file(*lines), layout="lines")
    check_features(df)
    assert tuple(ingest.quality_counts(df).first()) == (2, 3)


def test_geojson_broken_document_is_counted(spark, text_file):
    whole = json.dumps({"type": "FeatureCollection", "features": FEATURES})
    df = ingest.ingest_geojson(spark, text_file(whole[: len(whole) // 2]), layout="collection")
    assert tuple(ingest.quality_counts(df).first())[1] >= 1
    empty = text_file(json.dumps({"type": "FeatureCollection", "features": []}), name="empty.json")
    assert tuple(ingest.quality_counts(ingest.ingest_geojson(spark, empty, layout="collection")).first()) == (0, 0)


def test_control_characters_and_blank_lines(spark, text_file):
    with_header = ingest.ingest_text(spark, text_file("h|v", "2|2\u00010", "3|30"), "hexzoomevent", ["zoom_id"], header=True)
    assert {r.zoom_id: r.zoom_value for r in with_header.collect()} == {2: None, 3: 30}
    plain = ingest.ingest_text(spark, text_file("1|10", "", "  ", "x|5", name="p.txt"), "hexzoomevent", ["zoom_id"])
    assert tuple(ingest.quality_counts(plain).first()) == (1, 3)


def test_key_columns_do_not_collide(spark, text_file):
    lines = [site_line(account_id="a-b", site_id="c"), site_line(account_id="a", site_id="b-c"), site_line(site_id="s")]
    path = text_file("header", *lines, site_line(sitenum="n").replace("|s1|", "||"))
    rows = ingest.ingest_text(spark, path, SITE, ["account_id", "site_id"]).collect()
    assert len({r[FID] for r in rows}) == 4


def test_null_keys_fail(spark, text_file):
    df = ingest.ingest_text(spark, text_file("x|5", "1|5"), "hexzoomevent", ["zoom_id", "zoom_value"])
    assert {(r[FID], r["_ok"]) for r in df.collect()} == {(None, False), ("1:11:5", True)}


def test_separator_of_several_characters(spark, text_file):
    rows = read_fields(spark, text_file("a||b|c", "||"), header=False, sep="||").collect()
    assert [r.fields for r in rows] == [["a", "b|c"], ["", ""]]


def test_geojson_garbage_lines_are_counted(spark, text_file):
    df = ingest.ingest_geojson(spark, text_file(json.dumps(FEATURES[0]), '{"type": "Feature", "prop', "not json"))
    assert tuple(ingest.quality_counts(df).first()) == (1, 2)


def test_geojson_load(spark, text_file):
    root = new_dir(spark, "fires")
    df = ingest.ingest_geojson(spark, text_file(*[json.dumps(f) for f in FEATURES]))
    assert ingest.load(df, root, "wildfireevent", quarantine=f"{root}/bad") == (2, 3)
    stored = read_feature_table(spark, root, "wildfireevent")
    assert stored.where("`SHAPE.STArea` = 16.5").count() == 2


def test_write_and_read_back_text(spark):
    path = new_dir(spark, "text")
    df = spark.sql("SELECT * FROM VALUES (1L, ' padded ', CAST(NULL AS STRING)), (2L, '\"q\"', '') t(a, b, c)")
    write_delimited(df, path, header=True, null_token="NULL")
    rows = sorted(r.fields for r in read_fields(spark, path, header=True).collect())
    assert rows == [["1", " padded ", "NULL"], ["2", '"q"', ""]]


def test_geojson_features_beside_the_frame(spark, text_file):
    crs = {"type": "name", "properties": {"name": "CRS84"}}
    whole = json.dumps({"type": "FeatureCollection", "name": "fires", "crs": crs, "features": FEATURES, "more": [{}]})
    first, second, *rest = (json.dumps(f) for f in FEATURES)
    layouts = [
        [whole],
        ['{"type": "FeatureCollection", "features": [' + first + ",", second + ",", ", ".join(rest) + "]}"],
        ["{", '"type": "FeatureCollection",', '"features": [' + first + ", " + second + ",", *[r + "," for r in rest[:-1]], rest[-1], "]", "}"],
        ["[" + first + ",", *[r + "," for r in (second, *rest[:-1])], rest[-1] + "]"],
    ]
    for k, lines in enumerate(layouts):
        df = ingest.ingest_geojson(spark, text_file(*lines, name=f"{k}.json"), layout="lines")
        check_features(df)
        assert tuple(ingest.quality_counts(df).first()) == (2, 3)


def test_geojson_cut_collections_are_counted(spark, text_file):
    whole = json.dumps({"type": "FeatureCollection", "features": FEATURES})
    feature_lines = ["{", '"type": "Feature",', '"properties": {"OBJECTID": 1},', '"geometry": null', "}"]
    for k, lines in enumerate([[whole[: len(whole) // 2]], feature_lines]):
        df = ingest.ingest_geojson(spark, text_file(*lines, name=f"{k}.json"), layout="lines")
        written, failed = ingest.quality_counts(df).first()
        assert written == 0 and failed >= 1
    empty = text_file(json.dumps({"type": "FeatureCollection", "features": []}), name="empty.json")
    assert tuple(ingest.quality_counts(ingest.ingest_geojson(spark, empty, layout="lines")).first()) == (0, 0)
