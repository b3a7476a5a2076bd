import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from perilgrid.llm.quality_rules import measure
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_similar import expected as expected_similar
from tests.llm.test_text_rules import contamination
from tests.llm.test_token_streams import check_pieces


def near_copy(text, step):
    """A copy with one word changed in every ``step``, line by line."""
    words = text.split(" ")
    return " ".join(f"{w}x{i}" if i % step == step // 2 else w for i, w in enumerate(words))


def plain_stages(rows, hashes, items):
    """What each of the first four stages keeps, by plain Python."""
    rows = [(d, t) for d, t in rows if measure(t or "")["kept"]]
    yield rows
    stripped = brute_lines(rows, 2, 40, [hashes[d, t] for d, t in rows])
    rows = sorted(((d, t) for d, _, _, t in stripped), key=repr)
    yield rows
    rows = [r for r, (d, c) in zip(rows, expected_similar(rows), strict=True) if d is None or d == c]
    yield rows
    bad = {(d, t) for (d, t), (*_, hit) in zip(rows, (contamination([r], items, 10)[0] for r in rows), strict=True) if hit}
    yield [r for r in rows if r not in bad]


def test_stages_against_plain_python(spark, sf_dir, tmp_path):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
    long = [(d, t) for d, t in rows if 120 < len(t.split()) < 400 and "\n" not in t[:200]][:12]
    rows += [(5000 + k, near_copy(t, 120)) for k, (_, t) in enumerate(long)]
    rows += [(6000, None), (6001, ""), (6002, rows[0][1]), (6002, rows[1][1]), (None, rows[2][1])]
    (tmp_path / "in").mkdir()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' AS lang", "'s' AS source", "length(text) AS n_chars")
    docs.write.parquet(f"{tmp_path}/in/documents.parquet")
    spark.read.parquet(f"{sf_dir}/benchmark.parquet").write.parquet(f"{tmp_path}/in/benchmark.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    hashes = {tuple(r)[:2]: r[2] for r in docs.select("doc_id", "text", F.xxhash64("text")).collect()}
    sizes = [len(rows)]
    for kept in plain_stages(rows, hashes, items):
        sizes.append(len(kept))
        if len(sizes) == 4:
            gone = 5000 + np.arange(len(long))
            assert sum(d in gone for d, _ in kept if d) < len(long)  # some copies are near enough by the rule
    assert sizes[0] > sizes[1] == sizes[2] > sizes[3] > sizes[4]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = [(d, tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for d, t in kept]
    got = corpus_pipeline.run(spark, f"{tmp_path}/in").collect()
    assert check_pieces(got, ids, 4096) == 0


def test_columns_pass_through(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).schema == docs.schema
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert np.isin(list(entry.oracle_sql()), list(names)).all()
