"""SimHash near-duplicates: fingerprints of word shingles, linked through tables by fingerprint segment."""

from __future__ import annotations

from itertools import repeat

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilgrid.llm.arrow import map_texts
from perilgrid.llm.components import components
from perilgrid.session import new_dir

SEED = 42
BITS = 64
BLOCK = 1 << 16  # shingles whose bits are counted at once


def shingle_hashes(text: str, shingle: int) -> np.ndarray:
    """XXH64 of a text's word shingles in their order; none for a text without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    width = min(shingle, len(words))
    grams = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    return np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, len(words) - width + 1)


def fingerprint(text: str, shingle: int) -> int:
    """Signed 64-bit SimHash of a text's word shingles."""
    return fingerprint_of(shingle_hashes(text, shingle))


def fingerprint_of(hashes: np.ndarray) -> int:
    """Signed 64-bit SimHash of shingle hashes, repeats included."""
    total = len(hashes)
    if not total:
        return 0
    ones = np.zeros(BITS, np.int64)
    for start in range(0, total, BLOCK):
        rows = hashes[start : start + BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, h_text, fp) of every row; ``h_text`` is xxhash64 of its text."""

    def rows(doc_id: list, text: list[str], h_text: list) -> dict:
        return {"doc_id": doc_id, "h_text": h_text, "fp": [fingerprint(t, shingle) for t in text]}

    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("h_text"))
    return map_texts(keyed, "doc_id long, h_text long, fp long", rows)


# A fingerprint has two segments of 32 bits. Two of them at two bits or less have one segment in common,
# or a differing bit in both.
_SEGMENTS = ("shiftrightunsigned(fp, 32)", "(fp & 4294967295L)")
# Rests of the other segment that stand in a key beside the segment: with two bits at most to differ one of
# three is equal, with one bit one of two.
_THIRDS = ((0, 2047), (11, 2047), (22, 1023))
_HALVES = ((0, 65535), (16, 65535))


def _keys(table: int, segment: str, other: str, rests: tuple) -> list[str]:
    return [f"xxhash64({table}, {segment}, {k}, shiftrightunsigned({other}, {at}) & {mask}L)" for k, (at, mask) in enumerate(rests)]


def near_links(distinct: DataFrame) -> DataFrame:
    """Links (a, b), a < b, between the fingerprints ``fp`` at two or fewer differing bits: all of them, each once.

    Multi-index hashing: a fingerprint stands in the tables of its segments, under the value of the segment and
    a part of the rest, and probes the table of its first segment with the ball of radius one around it.
    What the tables give for the probes is verified by the complete distance. A key holds 42 or more bits
    of a fingerprint, so a value that many fingerprints have in one segment does not bring them all together.
    """
    high, low = _SEGMENTS
    equal = [*_keys(0, high, low, _THIRDS), *_keys(1, low, high, _THIRDS)]
    ball = "explode(transform(sequence(0, 31), i -> shiftleft(1L, i))) AS flip"
    probes = distinct.selectExpr("fp", ball).selectExpr(
        "fp", f"explode(array({', '.join(_keys(2, f'({high} ^ flip)', low, _HALVES))})) AS key"
    )
    one_off = distinct.selectExpr("fp AS other", f"explode(array({', '.join(_keys(2, high, low, _HALVES))})) AS key")
    same = distinct.selectExpr("fp", f"explode(array({', '.join(equal)})) AS key")
    met = same.join(same.withColumnRenamed("fp", "other"), "key").where("fp < other AND bit_count(fp ^ other) <= 2")
    near = probes.join(one_off, "key").where("fp < other AND bit_count(fp ^ other) <= 2")
    return met.select("fp", "other").union(near.select("fp", "other")).distinct().toDF("a", "b")


def simhash_groups(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) of every row; component_id is the smallest doc_id reachable.

    Words are runs of characters other than ASCII white space, A-Z in lower case; shingles of
    ``shingle`` words are hashed with XXH64. A text with fewer words is one shingle, one without
    words (null and empty texts) has fingerprint zero and is linked like any other.

    Rows that share a doc_id keep their own rows; a null doc_id never names a component, which is
    null only if all its rows have none. Equal fingerprints are one entry of all joins, so groups
    of copies cost no pairs. An empty table gives no rows; other columns are ignored.
    """
    return _grouped(docs, shingle).drop("h_text")


def _grouped(docs: DataFrame, shingle: int) -> DataFrame:
    spark = docs.sparkSession
    path = new_dir(spark, "fingerprints")
    fingerprints(docs, shingle).write.parquet(path)
    rows = spark.read.parquet(path)
    first = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    stored = new_dir(spark, "distinct-fingerprints")
    first.write.parquet(stored)
    first = spark.read.parquet(stored)
    roots = components(near_links(first)).withColumnRenamed("node", "fp")
    named = first.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = named.select("fp", "root", "first_id")
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_fp = named.join(smallest, "root").select("fp", "component_id")
    return rows.join(of_fp, "fp").select("doc_id", "h_text", "fp", "component_id")


def keep_one_each(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its group, all columns unchanged.

    Rows with a null doc_id always stay. Rows that share a doc_id are judged by their own text.
    """
    dropped = _grouped(docs, shingle).where("doc_id > component_id")
    dropped = dropped.select(F.col("doc_id").alias("_doc_id"), F.col("h_text").alias("_h_text")).distinct()
    same = (docs["doc_id"] == dropped["_doc_id"]) & (F.xxhash64(docs["text"]) == dropped["_h_text"])
    return docs.join(dropped, same, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
