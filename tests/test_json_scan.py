import json
import random

import pandas as pd
import pytest

from perilgrid.session import new_dir
from perilgrid.sources import ingest
from perilgrid.sources.feature_table import read_feature_table
from perilgrid.sources.json_scan import Change, Scan, Structure, _states, feature_texts
from tests.test_ingest import FEATURES, HOLE, RING, check_features, feature, text_file  # noqa: F401

ODD = ["a}b", '{["features": [', "\\\\", 'q"}', "}{", "ü}", ""]


def a_feature(rng, i):
    return {
        "type": "Feature",
        "properties": {"OBJECTID": i, "FIRE_NAME": rng.choice(ODD), "features": [{"x": [1]}] if rng.random() < 0.3 else 1},
        "geometry": {"type": "Polygon", "coordinates": [[[rng.random(), 1], [2, 3]]]},
    }


def a_document(rng):
    features = [a_feature(rng, i) for i in range(rng.randrange(0, 6))]
    whole = {"type": "FeatureCollection", "crs": {"a": {"b": ["}"]}}, "features": features, "more": [{"z": {}}]}
    if rng.random() < 0.3:
        whole = {"features": features, **whole}
    indent, end = rng.choice([None, 1, 2]), rng.choice(["", "\n"])
    return rng.choice([
        (json.dumps(whole, indent=indent) + end, features),
        ("\n".join(json.dumps(f, indent=indent) for f in features) + end, features),
        (json.dumps(features, indent=indent) + end, features),
        (json.dumps(whole, indent=indent) + "\n" + json.dumps(whole), features * 2),
    ])


def scanned(data: bytes, rng) -> list[bytes]:
    """Features of a document cut into random ranges, put together as the job does."""
    pieces = data.split(b"}")
    spare = bool(pieces[-1])
    pieces = pieces if spare else pieces[:-1]
    cuts = sorted({0, len(pieces), *[rng.randrange(len(pieces) + 1) for _ in range(rng.randrange(5))]})
    ranges, rows = [], []
    for begin, end in zip(cuts, cuts[1:]):
        inner = sorted({begin, end, rng.randrange(begin, end + 1)})
        blocks = [b"}".join(pieces[a:b]) + b"}" for a, b in zip(inner, inner[1:])]
        both = [Change(in_string=False), Change(in_string=True)]
        for block in blocks:
            both = [c.then(Structure.of(block, c.in_string).change()) for c in both]
        row = {"file": "f", "block": begin, "size": len(data), "bytes": sum(map(len, blocks))}
        for s, c in enumerate(both):
            row |= {f"pops{s}": c.pops, f"pushes{s}": c.pushes, f"ends{s}": c.in_string, f"listed{s}": list(c.listed)}
        ranges.append((begin, blocks))
        rows.append(row)
    whole, parts = [], {}
    for (begin, blocks), state in zip(ranges, _states(pd.DataFrame(rows)).itertuples()):
        scan = Scan(state.stack, state.in_string)
        for k, block in enumerate(blocks):
            for own, text in scan.block(block[:-1] if state.spare and k == len(blocks) - 1 else block):
                whole.append(text) if own else parts.setdefault(state.owner, []).append((begin, text))
        if (rest := scan.rest()) is not None:
            parts.setdefault(state.owner if scan.cut else begin, []).append((begin, rest))
    kept = [sorted(p) for p in parts.values() if all(text is not None for _, text in p)]
    return whole + [b"".join(text for _, text in p) for p in kept]


@pytest.mark.parametrize("seed", range(4))
def test_any_cut_gives_the_same_features(seed):
    rng = random.Random(seed)
    for _ in range(300):
        text, features = a_document(rng)
        if text.strip():
            got = sorted(json.dumps(json.loads(t)) for t in scanned(text.encode(), rng))
            assert got == sorted(json.dumps(f) for f in features), text


@pytest.fixture
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = [spark.conf.get(k, None) for k in keys]
    for key, value in zip(keys, ("257b", "0b", "1")):
        spark.conf.set(key, value)
    yield
    for key, value in zip(keys, before):
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_one_document_is_read_by_many_tasks(spark, text_file, small_splits):  # noqa: F811
    rng = random.Random(7)
    features = [a_feature(rng, i) for i in range(60)]
    whole = {"type": "FeatureCollection", "crs": {"n": {"b": [1]}}, "features": features, "more": [{"z": {}}, 5]}
    for k, indent in enumerate((None, 2)):
        path = text_file(json.dumps(whole, indent=indent), name=f"{k}.json")
        assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 20
        got = [r.text for r in feature_texts(spark, path).collect()]
        assert sorted(json.dumps(json.loads(t)) for t in got) == sorted(json.dumps(f) for f in features)


@pytest.mark.parametrize("indent", [1, 2, 4])
def test_indented_is_found_out(spark, text_file, indent):  # noqa: F811
    df = ingest.ingest_geojson(spark, text_file(*json.dumps({"type": "FeatureCollection", "features": FEATURES}, indent=indent).splitlines()))
    check_features(df)
    assert tuple(ingest.quality_counts(df).first()) == (2, 3)


def test_cut_documents_and_garbage_are_counted(spark, text_file, small_splits):  # noqa: F811
    whole = json.dumps({"type": "FeatureCollection", "features": FEATURES[:2]}, indent=1)
    end = whole.index('"OBJECTID": 2')
    cases = [(whole[:end], (1, 1)), (whole[:-1], (2, 0)), ("", (0, 0)), ("nothing here", (0, 1)), ('{"a": 1}', (0, 1)), ("[]", (0, 0))]
    cases += [(whole.replace('"features": [', '"features": [ null,', 1), (2, 1)), (whole + "\n]}", (2, 0))]
    for k, (text, counts) in enumerate(cases):
        df = ingest.ingest_geojson(spark, text_file(text, name=f"{k}.json"), layout="any")
        assert tuple(ingest.quality_counts(df).first()) == counts, text


def test_several_files_of_several_layouts(spark, text_file):  # noqa: F811
    texts = [json.dumps({"type": "FeatureCollection", "features": FEATURES}, indent=2), json.dumps(FEATURES[0]), json.dumps(FEATURES[:2])]
    paths = [text_file(t, name=f"{k}.json") for k, t in enumerate(texts)]
    df = ingest.ingest_geojson(spark, paths, layout="any")
    assert tuple(ingest.quality_counts(df).first()) == (5, 3)


def test_multi_polygons(spark, text_file):  # noqa: F811
    far = [[[x + 10, y] for x, y in ring] for ring in (RING, HOLE)]
    shapes = [feature(1, [[RING, HOLE], far], "MultiPolygon"), feature(2, [[RING]], "MultiPolygon"), feature(3, [[RING], [RING[:-1]]], "MultiPolygon"), feature(4, [], "MultiPolygon")]
    root = new_dir(spark, "multi")
    for k, layout in enumerate(("lines", "any", "auto")):
        text = [json.dumps(s) for s in shapes] if layout == "lines" else [json.dumps({"type": "FeatureCollection", "features": shapes}, indent=1)]
        df = ingest.ingest_geojson(spark, text_file(*text, name=f"{k}.json"), key_columns=["OBJECTID"], layout=layout)
        assert ingest.load(df, f"{root}/{layout}", "wildfireevent") == (2, 2)
        stored = {r.OBJECTID: r.geometry for r in read_feature_table(spark, f"{root}/{layout}", "wildfireevent").collect()}
        assert stored[1].parts == [2, 2] and len(stored[1].rings) == 4 and tuple(stored[1].bbox) == (0.0, 0.0, 14.0, 4.0)
        assert stored[2].parts is None and len(stored[2].rings) == 1
