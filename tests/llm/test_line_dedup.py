import random

import duckdb
import pytest
from pyspark.sql import functions as F

from perilgrid.llm import line_dedup as module
from perilgrid.llm.line_dedup import line_dedup, strip_lines, within_edits
from tests.conftest import plan_of
from tests.llm.conftest import rows_of

ALPHABET = "abé😀"


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        k = rng.randint(0, len(out))
        kind = rng.choice("ids")
        if kind == "i":
            out.insert(k, rng.choice(ALPHABET))
        elif k < len(out):
            if kind == "d":
                del out[k]
            else:
                out[k] = rng.choice(ALPHABET)
    return "".join(out)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance(spark, edits):
    rng = random.Random(edits)
    pairs = set()
    for _ in range(3000):
        a = "".join(rng.choices(ALPHABET, k=rng.randint(0, 24)))
        pairs.add((a, edited(rng, a, rng.randint(0, 4))))
    df = spark.createDataFrame(sorted(pairs), "a string, b string").where(f"abs(length(a) - length(b)) <= {edits}")
    assert rows_of(within_edits(df, "a", "b", edits)) == rows_of(df.where(f"levenshtein(a, b) <= {edits}"))


def distance(a, b, limit):
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows, edits, shortest, hashes):
    places = {}
    for (doc_id, text), h in zip(rows, hashes, strict=True):
        for k, line in enumerate(text.split("\n") if text is not None else []):
            if line.strip(" \t\r"):
                places.setdefault(line, []).append(((doc_id is not None, doc_id or 0, h, k)))
    first = {line: min(at) for line, at in places.items()}
    gone = {a for a in first for b in first if a != b and min(len(a), len(b)) >= shortest and first[b] < first[a] and distance(a, b, edits) <= edits}
    out = []
    for (doc_id, text), h in zip(rows, hashes, strict=True):
        if text is None:
            out.append((doc_id, 0, 0, None))
            continue
        lines = text.split("\n")
        kept = [
            x
            for k, x in enumerate(lines)
            if not x.strip(" \t\r") or (x not in gone and first[x] == (doc_id is not None, doc_id or 0, h, k))
        ]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def made_rows():
    rng = random.Random(7)
    bases = ["".join(rng.choices("abcdefgh ", k=rng.randint(8, 60))) for _ in range(25)]
    rows = []
    for k in range(80):
        lines = [edited(rng, rng.choice(bases), rng.choice([0, 0, 1, 2, 3])) for _ in range(rng.randint(1, 6))]
        rows.append((k, "\n".join(lines + [""] * rng.randint(0, 1))))
    rows += [(90 + k, line) for k, line in enumerate(["MIT", " ", "MIT", "\tMIT", "MIT\r", "\r", "MIT\n \t\nMIT"])]
    rows += [(None, None), (None, bases[0]), (3, ""), (4, "\n\n"), (5, bases[1]), (5, bases[1]), (5, bases[2]), (200, (bases[3] + "\n") * 3000)]
    return rows


@pytest.mark.parametrize("edits,shortest", [(2, 10), (1, 8), (3, 12)])
def test_small_lines(docs, edits, shortest):
    rows = made_rows()
    df = docs(rows)
    hashes = {tuple(r[:2]): r[2] for r in df.select("doc_id", "text", F.xxhash64("text")).collect()}
    want = brute(rows, edits, shortest, [hashes[r] for r in rows])
    assert rows_of(line_dedup(df, edits, shortest)) == want


def test_shuffled_keys_and_columns(docs, monkeypatch):
    monkeypatch.setattr(module, "BROADCAST_KEYS", 0)
    rows = made_rows()
    df = docs(rows)
    hashes = {tuple(r[:2]): r[2] for r in df.select("doc_id", "text", F.xxhash64("text")).collect()}
    want = brute(rows, 2, 10, [hashes[r] for r in rows])
    out = strip_lines(df, 2, 10)
    assert out.columns == df.columns and [t for _, t in out.dtypes] == [t for _, t in df.dtypes]
    assert rows_of(out.select("doc_id", "text")) == sorted(((d, t) for d, _, _, t in want), key=repr)
    assert out.where("n_chars <> length(text)").count() == 0


def test_key_filter(spark, monkeypatch):
    """Keys too many to broadcast are filtered where the lines are: no line is shuffled by key."""
    monkeypatch.setattr(module, "FILTER_SHARE", 16)
    keys = spark.range(20_000).selectExpr("xxhash64(id) AS key")
    others = spark.range(20_000, 60_000).selectExpr("xxhash64(id) AS key", "CAST(id AS STRING) AS line", "id % 2 = 0 AS own")
    words, rows = module.key_filter(keys, 20_000)
    assert rows == words.count() == 16 and words.where(f"size(_words) <> {module.FILTER_WORDS}").count() == 0
    assert module.in_filter(keys, words, rows).count() == 20_000
    passed = module.in_filter(others, words, rows)
    assert passed.columns == others.columns and passed.count() < 800
    plan = plan_of(passed)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert module.in_filter(keys.limit(0), *module.key_filter(keys.limit(0), 0)).count() == 0


def test_many_keys_stay_off_the_disk(docs, spark, monkeypatch):
    """Where shared keys are too many to broadcast, no shuffle takes a line once for each of its keys."""
    monkeypatch.setattr(module, "BROADCAST_KEYS", 0)
    rng = random.Random(3)
    lines = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=600)) for _ in range(400)]
    df = docs([(k, line) for k, line in enumerate([*lines, lines[0][:-1] + "é"])], extra=False)
    met = []
    monkeypatch.setattr(module, "in_filter", lambda *a, f=module.in_filter: met.append(f(*a)) or met[0])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert line_dedup(df).where("n_removed > 0").count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert 6 <= met[0].count() < 200  # of 12 keys of each line


def test_short_license_lines(docs):
    lines = ["Released under the MIT License.", "All rights reserved.", "Licensed under CC BY-NC 4.0."]
    rows = [(k, f"own text {k}\n{lines[k % 3]}\n\nend {k}") for k in range(9)]
    left = {r.doc_id: r.text for r in strip_lines(docs(rows)).collect()}
    assert [k for k in left if any(line in left[k] for line in lines)] == [0, 1, 2]
    assert left[5] == "own text 5\n\nend 5"


def test_clashing_columns(docs):
    names = ["_removed", "_h_text", "_doc_id", "_lines", "_row", "removed", "line", "row.x"]
    df = docs([(1, "one\ntwo"), (2, "two\nthree")], extra=False)
    for k, name in enumerate(names):
        df = df.withColumn(name, F.lit(k))
    out = strip_lines(df)
    assert out.columns == df.columns
    assert [tuple(r) for r in out.orderBy("doc_id").collect()] == [(1, "one\ntwo", *range(8)), (2, "three", *range(8))]


def test_text_goes_along_once(docs, monkeypatch):
    seen = []
    monkeypatch.setattr(module, "_rebuilt", lambda df, *a, f=module._rebuilt: seen.append(df) or f(df, *a))
    assert strip_lines(docs([(1, "one\ntwo"), (2, "two\nthree")])).count() == 2
    assert "text" in seen[0].columns and "text" not in seen[0].schema["_row"].dataType.fieldNames()


def test_empty_table(docs):
    assert line_dedup(docs([])).count() == 0


def test_query_equals_sql(spark, sf_dir):
    from perilgrid.llm.queries import ORACLES, QUERIES

    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    got = QUERIES["op8_line_dedup"](spark, sf_dir)
    want = connection.sql(f"SELECT {', '.join(got.columns)} FROM ({ORACLES['op8_line_dedup']})").fetchall()
    assert rows_of(got) == sorted(want, key=repr)
