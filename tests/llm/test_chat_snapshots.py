import random

import duckdb
import pytest

from perilgrid.llm import chat_snapshots
from perilgrid.llm.chat_snapshots import format_chats
from perilgrid.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import rows_of

SCHEMA = "conv_id long, turn long, role string, text string"


def turns(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n", "2 AS place", "3 AS h1", "4 AS piece")


def brute(rows):
    rows = sorted({r for r in rows if r[0] is not None}, key=repr)
    convs = {}
    for c, t, role, text in rows:
        convs.setdefault(c, []).append((t, role, text))
    placed = {}
    for c, turns_ in convs.items():
        numbers = [t for t, _, _ in turns_ if t is not None]
        first = min(numbers) if numbers else 0
        placed[c] = {(-1 if t is None else t - first, role, text) for t, role, text in turns_}
    gone = set()
    for a, x in placed.items():
        last = max(p for p, _, _ in x)
        for b, y in placed.items():
            if a != b and {e for e in y if e[0] <= last} == x and (len(y) > len(x) or b < a):
                gone.add(a)
    out = []
    for c, t, role, text in rows:
        if c not in gone:
            piece = f"<|im_start|>{role or ''}\n{text or ''}<|im_end|>\n"
            out.append((c, len(placed[c]), t, role, role == "assistant", piece))
    return sorted(out, key=repr)


SMALL = [
    (1, 0, "user", "a"), (1, 1, "assistant", "b"),
    (2, 0, "user", "a"), (2, 1, "assistant", "b"), (2, 2, "user", "c"),
    (3, 5, "user", "a"), (3, 6, "assistant", "b"),
    (4, 0, "user", "x"), (5, 0, "user", "x"), (5, 0, "user", "x"),
    (6, None, "user", None), (7, None, "user", ""), (8, None, None, None), (None, 0, "user", "a"),
    (9, 0, None, "a"), (10, 0, "a", None), (11, 0, "user", ""), (12, 0, "user", "w " * 50_000),
]


@pytest.mark.parametrize("block", [256, 2])
def test_small(spark, monkeypatch, block):
    monkeypatch.setattr(chat_snapshots, "BLOCK_TURNS", block)
    assert rows_of(format_chats(turns(spark, SMALL))) == brute(SMALL)


@pytest.mark.parametrize("block", [256, 3])
def test_random(spark, monkeypatch, block):
    monkeypatch.setattr(chat_snapshots, "BLOCK_TURNS", block)
    rng = random.Random(block)
    rows = []
    for c in range(150):
        at = rng.choice([0, 0, 3])
        rows += [(c, at + k, "user" if k % 2 == 0 else "assistant", rng.choice("ab")) for k in range(rng.randint(1, 8))]
    assert rows_of(format_chats(turns(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert format_chats(turns(spark, [])).count() == 0


def test_query_equals_sql(spark, sf_dir):
    path = f"{sf_dir}/conversations.parquet"
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW conversations AS SELECT * FROM '{path}'")
    got = QUERIES["op2_chat_snapshots"](spark, sf_dir)
    want = connection.sql(f"SELECT {', '.join(got.columns)} FROM ({ORACLES['op2_chat_snapshots']})").fetchall()
    assert rows_of(got) == sorted(want, key=repr)
    given = [tuple(r) for r in spark.read.parquet(path).select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(got) == brute(given)
