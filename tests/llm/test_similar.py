import random

from perilgrid.llm.similar import keep_one_similar, similar_groups
from tests.llm.conftest import rows_of
from tests.llm.test_simhash import EDGE, roots


def plain_set(text, k=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} or ({tuple(words)} if words else set())


def expected(rows):
    sets = [plain_set(t) for _, t in rows]
    links = [(i, j) for i, x in enumerate(sets) for j, y in enumerate(sets[:i]) if 5 * len(x & y) >= 4 * len(x | y)]
    root = roots(range(len(rows)), links)
    smallest = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            smallest[root[k]] = min(smallest.get(root[k], doc_id), doc_id)
    return [(d, smallest.get(root[k])) for k, (d, _) in enumerate(rows)]


def made_rows():
    """Chains of texts with some words changed, and a passage that many unlike texts share."""
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(5000)}"
    passage = [word() for _ in range(12)]
    rows = []
    for _ in range(25):
        words = [word() for _ in range(rng.choice([5, 8, 14, 60, 200]))]
        for _ in range(rng.randint(1, 6)):
            for _ in range(rng.randint(0, max(1, len(words) // 45))):
                words[rng.randrange(len(words))] = word()
            rows.append((len(rows), " ".join(words)))
    for _ in range(40):
        rows.append((len(rows), " ".join(passage + [word() for _ in range(rng.randint(3, 30))])))
    return rows + EDGE


def check(df, rows):
    want = expected(rows)
    got = [(r.doc_id, r.component_id) for r in similar_groups(df).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = keep_one_similar(df)
    assert kept.schema == df.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, c in want if d is None or d == c)
    return want


def test_groups_equal_brute_force(docs):
    rows = made_rows()
    check(docs(rows), rows)


def test_stage_equals_brute_force(spark, docs):
    import corpus_pipeline

    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in table.collect()]
    want = sorted(d for d, c in expected(rows) if d == c)
    assert [d for (d,) in rows_of(corpus_pipeline.simhash_stage(spark, table, "").select("doc_id"))] == sorted(want, key=lambda d: repr((d,)))


def test_empty_table(docs):
    assert similar_groups(docs([])).count() == 0
    assert keep_one_similar(docs([])).count() == 0
