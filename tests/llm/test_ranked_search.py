import math
import random
import re
from collections import Counter

import pytest

from perilgrid.llm import ranked_search as module
from perilgrid.llm.ranked_search import ranked_search, terms
from tests.llm.conftest import rows_of


def plain_terms(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def expected(rows, items, k=20):
    found = [(d, Counter(plain_terms(t))) for d, t in rows]
    n_docs, total = sum(1 for _, c in found if c), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in found:
            m = 75 + (25 * sum(c.values()) * n_docs) // max(1, total)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in plain_terms(text) if c[t]
            )
            if score > 0:
                scores.append((-score, d if d is not None else math.inf))
        for rank, (score, d) in enumerate(sorted(scores)[:k], 1):
            out.append((item, rank, d if d != math.inf else None, -score))
    return sorted(out, key=repr)


@pytest.mark.parametrize("text", [None, "", "a", "Été d'ÉTÉ, x_1 A-B\x00c\x7fd", "ß　Ünï 12 3.4", "\n\t"])
def test_terms(text):
    assert [t.decode() for t in terms(text)] == plain_terms(text)


def made(rng, n):
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(rng.randrange(1, 90)))) for i in range(n)]
    rows += [(5000 + i, "w1 w2 same text w9") for i in range(40)] + [(None, "w1 w2 same text w9"), (None, None), (7001, ""), (7002, None)]
    rows += [(3, "w4 another text of one id"), (3, "w4 another text of one id"), (8000, "w7 w8 " * 40_000)]
    return rows


ITEMS = [(1, "w1 w2 w2 same"), (2, ""), (None, "W9 w9"), (4, None), (5, "nowhere at all"), (1, "w1 w2 w2 same"), (6, " ".join(f"w{i}" for i in range(60)))]


@pytest.mark.parametrize("batch_bytes, block_docs", [(4 << 20, 1 << 15), (100, 16)])
def test_against_plain_python(spark, docs, monkeypatch, batch_bytes, block_docs):
    monkeypatch.setattr(module, "BATCH_BYTES", batch_bytes)
    monkeypatch.setattr(module, "BLOCK_DOCS", block_docs)
    rows = made(random.Random(6), 200)
    got = ranked_search(docs(rows), spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert rows_of(got) == expected(rows, ITEMS)


def test_fewer_than_k(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = [(1, "w1"), (2, "w2 w1"), (3, "zz")]
    assert rows_of(ranked_search(docs(rows), items, 2)) == expected(rows, ITEMS, 2)


def test_empty_tables(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranked_search(docs([]), items).count() == 0
    assert ranked_search(docs([(1, None), (2, "")]), items).count() == 0
    assert ranked_search(docs([(1, "w1")]), items.limit(0)).count() == 0


def test_bounds_end_the_visits(monkeypatch):
    """A stratum whose bound lies below the k-th score is not scored."""
    import numpy as np

    scored = []
    plain = module.Stratum.score
    monkeypatch.setattr(module.Stratum, "score", lambda s, b, q: scored.append(s) or plain(s, b, q))
    one = np.zeros(30, np.int64)
    near = module.Stratum(80, np.arange(30), one, one + 9, np.arange(30), 1)
    far = module.Stratum(900, np.arange(30, 60), one, one + 1, np.arange(30), 1)
    top = module._Top(1, 20)
    module._visit([far, near], module._Batch([[0]], np.array([5])), top)
    assert scored == [near] and top.ids[0].tolist() == list(range(20))
