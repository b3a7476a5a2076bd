import collections
import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from perilgrid.llm import suffix_dedup as module
from perilgrid.llm.bwt_merge import Merged, Transforms, repeated_starts
from tests.conftest import plan_of
from tests.llm.conftest import rows_of


def brute(rows, length):
    texts = [(d, (t or "").encode()) for d, t in rows]
    counts = collections.Counter(b[i : i + length] for _, b in texts for i in range(len(b) - length + 1))
    out = []
    for doc_id, data in texts:
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if counts[data[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(data), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted(
        ((r.doc_id, r.n_bytes, len(r.spans) // 2, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in df.collect()),
        key=repr,
    )


STRINGS = st.lists(st.binary(max_size=30) | st.text("ab", max_size=40).map(str.encode), max_size=7)


@settings(max_examples=150, deadline=None)
@given(STRINGS, st.integers(1, 12), st.integers(1, 4))
def test_merged_intervals(strings, length, shards):
    counts = collections.Counter(s[i : i + length] for s in strings for i in range(len(s) - length + 1))
    want = [[i for i in range(len(s) - length + 1) if counts[s[i : i + length]] > 1] for s in strings]
    got = repeated_starts(strings, np.ones(len(strings)), length, np.arange(len(strings)) % shards)
    assert [g.tolist() for g in got] == want
    got = repeated_starts(strings, np.ones(len(strings)), length)
    assert [g.tolist() for g in got] == want


@settings(max_examples=80, deadline=None)
@given(STRINGS)
def test_merged_order_and_prefixes(strings):
    found = Transforms(strings, np.arange(len(strings)) % 2, 1000)
    merged = Merged(found, 1000)
    suffixes = [strings[i][k:] for i, k in zip(found.string, found.offset, strict=True)]
    order = merged.interleave()
    ranked = [suffixes[i] for i in order]
    assert ranked == sorted(suffixes)
    for p in range(1, len(ranked)):
        if merged.lcp[p] >= 0:
            a, b = ranked[p - 1], ranked[p]
            same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert merged.lcp[p] == same


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    base = "".join(rng.choices("abcdé", k=300))
    rows = [(None, None), (0, ""), (1, "a" * 120), (2, base), (2, base), (4, "short"), (5, "abab" * 30)]
    rows.append((3, base[:100] + "X" + base[101:]))
    for i in range(6, 50):
        at = rng.randint(0, 250)
        ends = ["".join(rng.choices("abc ", k=rng.randint(0, 60))) for _ in range(2)]
        rows.append((i, ends[0] + base[at : at + rng.randint(5, 120)] + ends[1]))
    return rows


def test_small_documents(docs, rows):
    assert found(module.suffix_dedup(docs(rows), 24, 8)) == brute(rows, 24)


@pytest.mark.parametrize("most, orders", [(1, module.ORDERS), (3, (2, module.WHOLE)), (2, (module.WHOLE,))])
def test_names_with_many_contexts_get_longer(docs, rows, monkeypatch, most, orders):
    monkeypatch.setattr(module, "NAME_CONTEXTS", most)
    monkeypatch.setattr(module, "ORDERS", orders)
    monkeypatch.setattr(module, "PART_STARTS", 50)
    assert found(module.suffix_dedup(docs(rows), 24, 8)) == brute(rows, 24)


def test_longer_names_follow_the_window_alone():
    """Equal windows get equal names wherever they stand, and two windows of one part are never equal."""
    rng = random.Random(8)
    data = bytes(rng.choices(b"ab", k=400))
    data += data[50:250] + bytes(rng.choices(b"ab", k=40))
    length, gram = 40, 12
    for orders in (2, 8, module.WHOLE):
        seen = {}
        for begin, end, name in module.runs_of(data, length, gram):
            parts = module.longer_names(data, begin, end, name, orders, length, gram)
            assert [p[0] for p in parts] == [begin, *(p[1] for p in parts[:-1])] and parts[-1][1] == end
            for b, e, longer in parts:
                windows = [data[i : i + length] for i in range(b, e)]
                assert len(set(windows)) == len(windows)
                assert all(seen.setdefault(w, longer) == longer for w in windows)


def test_many_groups(docs, rows, monkeypatch):
    monkeypatch.setattr(module, "GROUP_BYTES", 300)
    assert found(module.suffix_dedup(docs(rows), 24, 8)) == brute(rows, 24)


def test_texts_are_shuffled_once(docs, rows, monkeypatch):
    """However many steps look at the texts again, the runs go to them."""
    joined = []

    def join(*args):
        joined.append(with_row_key(*args))
        return joined[-1]

    with_row_key = module._with_row_key
    monkeypatch.setattr(module, "_with_row_key", join)
    monkeypatch.setattr(module, "NAME_CONTEXTS", 1)
    result = module.suffix_dedup(docs(rows), 24, 8)
    assert found(result) == brute(rows, 24)
    assert len(joined) >= 6
    for df in [*joined, result]:
        moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan_of(df))
        assert moved and not [m for m in moved if re.search(r"\btext#", m)]


def test_a_null_id_is_not_zero(docs):
    """Rows of one text with ids null and 0 are two rows; only what each holds is judged."""
    text = "".join(random.Random(6).choices("abcd", k=60))
    for rows in ([(None, text), (0, text)], [(None, text), (0, "x" + text[:20])], [(0, text), (None, None)]):
        assert found(module.suffix_dedup(docs(rows), 24, 8)) == brute(rows, 24)


def test_no_table_stays_in_the_catalog(docs, rows, spark):
    before = spark.catalog.listTables()
    assert found(module.suffix_dedup(docs(rows), 24, 8)) == brute(rows, 24)
    assert spark.catalog.listTables() == before


def test_empty_table(docs):
    assert rows_of(module.suffix_dedup(docs([]), 24, 8)) == []


def test_query(spark, sf_dir):
    from perilgrid.llm.queries import QUERIES

    given_rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op1_suffix_dedup"](spark, sf_dir).select("doc_id", "n_bytes", "n_spans", "kept_sha256")
    assert rows_of(got) == brute(given_rows, 400)
