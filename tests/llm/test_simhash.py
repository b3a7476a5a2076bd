import random
import re

import pytest
import xxhash

from perilgrid.llm.components import components
from perilgrid.llm.simhash import fingerprint, keep_one_each, near_links, simhash_groups
from tests.llm.conftest import rows_of


def plain_fingerprint(text, k=3):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("text", ["", " \n", "one", "One TWO", "a b c", "É é a A ß\tx\x0by", "same same " * 300])
def test_fingerprint(text):
    assert fingerprint(text, 3) % (1 << 64) == plain_fingerprint(text)


def test_links_connect_all_close_pairs(spark):
    rng = random.Random(1)
    values = set()
    for _ in range(30):
        base = rng.getrandbits(64)
        for _ in range(8):
            near = base
            for bit in rng.sample(range(64), rng.randint(0, 3)):
                near ^= 1 << bit
            values.add(near)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = near_links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()
    mask = (1 << 64) - 1
    assert all(((r.a & mask) ^ (r.b & mask)).bit_count() <= 2 for r in links)
    close = [(a, b) for a in signed for b in signed if a < b and ((a & mask) ^ (b & mask)).bit_count() <= 2]
    assert roots(signed, [(r.a, r.b) for r in links]) == roots(signed, close)
    assert sorted((r.a, r.b) for r in links) == sorted(close)


def test_tables_give_more_than_links(spark):
    """Values that share a segment and more meet in a table; the distance decides."""
    base = [0, 7 << 11, 1 << 40 | 7 << 11, 3]
    links = near_links(spark.createDataFrame([(v,) for v in base], "fp long"))
    assert {(r.a, r.b) for r in links.collect()} == {(0, 3), (7 << 11, 1 << 40 | 7 << 11)}
    assert len({v >> 32 for v in base}) < len(base)


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(2)
    edges = {
        "chain": [(i, i + 1) for i in range(200)],
        "star": [(0, i) for i in range(1, 200)] + [(5, 5), (0, 7), (7, 0)],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(200)],
        "none": [],
    }[shape]
    got = components(spark.createDataFrame([*edges, (None, 1)], "a long, b long"))
    nodes = {n for a, b in edges for n in (a, b) if a != b}
    assert dict(map(tuple, got.collect())) == roots(nodes, [e for e in edges if e[0] != e[1]])
    assert got.count() == len(nodes)


EDGE = [(None, "lone words of a row without id here"), (None, ""), (5, None), (3, ""), (9, "a b c d"), (9, "a b c d"), (2, "A B c D"), (9, "other text of the same id")]


def expected_groups(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
    root = roots(range(len(rows)), links)
    smallest = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            smallest[root[k]] = min(smallest.get(root[k], doc_id), doc_id)
    return [(d, fps[k], smallest.get(root[k])) for k, (d, _) in enumerate(rows)]


def test_groups(spark, docs, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").where("doc_id >= 20")
    rows = [tuple(r) for r in given.collect()] + EDGE
    df = docs(rows)
    got = [(d, fp % (1 << 64), c) for d, fp, c in rows_of(simhash_groups(df))]
    want = expected_groups(rows)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = keep_one_each(df)
    assert kept.schema == df.schema
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(d) for d, _, c in want if d is None or d == c)


def test_empty_table(docs):
    assert simhash_groups(docs([])).count() == 0
    assert keep_one_each(docs([])).count() == 0


def test_query(spark, sf_dir):
    from perilgrid.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = [(d, format(fp, "016x"), c) for d, fp, c in expected_groups(rows)]
    assert rows_of(QUERIES["op10_simhash"](spark, sf_dir)) == sorted(want, key=repr)
