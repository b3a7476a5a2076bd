"""Similar texts: SimHash tables first, then a set similarity join for what lies too far apart in bits."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilgrid.llm.arrow import map_texts
from perilgrid.llm.chosen_path import _set_id, _stored, _whole, minwise_tokens, path_links
from perilgrid.llm.components import components
from perilgrid.llm.simhash import fingerprint_of, near_links, shingle_hashes
from perilgrid.session import drop_dir

SHINGLE = 5
PERCENT = 80


def _described(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, h_text, sid, n, tokens, fp) of every row: set name, set size, minwise tokens, fingerprint."""

    def rows(doc_id: list, text: list[str], h_text: list) -> dict:
        hashes = [shingle_hashes(t, shingle) for t in text]
        sets = [np.unique(h) for h in hashes]
        return {
            "doc_id": doc_id,
            "h_text": h_text,
            "sid": [_set_id(s) for s in sets],
            "n": [len(s) for s in sets],
            "tokens": [minwise_tokens(s).view(np.int64) if len(s) else [] for s in sets],
            "fp": [fingerprint_of(h) for h in hashes],
        }

    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("h_text"))
    return map_texts(keyed, "doc_id long, h_text long, sid long, n long, tokens array<long>, fp long", rows)


def simhash_pairs(rows: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) of set names whose fingerprints differ in two bits at most.

    Of sets with one fingerprint each stands against the first, which stands for all of them in the tables.
    """
    sets = rows.where("n > 0").select("sid", "fp").distinct()
    first = sets.groupBy("fp").agg(F.min("sid").alias("low"))
    alike = sets.join(first, "fp").where("sid <> low").select(F.col("low").alias("a"), F.col("sid").alias("b"))
    links = near_links(first.select("fp"))
    of = first.select(F.col("fp").alias("a"), F.col("low").alias("la"))
    links = links.join(of, "a").join(of.select(F.col("a").alias("b"), F.col("la").alias("lb")), "b")
    return alike.union(links.select("la", "lb"))


def confirmed(docs: DataFrame, rows: DataFrame, pairs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs whose whole sets are similar enough."""
    pairs, at = _stored(pairs, "simhash-pairs")
    ends = pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct()
    items, items_at = _stored(_whole(docs, rows, ends, shingle), "simhash-sets")
    both = pairs.join(items.select(F.col("sid").alias("a"), F.col("items").alias("x")), "a")
    both = both.join(items.select(F.col("sid").alias("b"), F.col("items").alias("y")), "b")
    both = both.select("a", "b", (F.size("x") + F.size("y")).alias("n"), F.size(F.array_intersect("x", "y")).alias("common"))
    links, _ = _stored(both.where(f"100 * common >= {percent} * (n - common)").select("a", "b"), "simhash-links")
    for old in (at, items_at):
        drop_dir(docs.sparkSession, old)
    return links


def similar_groups(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, h_text, component_id) of every row; component_id is the smallest doc_id reachable.

    Two texts are linked if the sets of their shingles of ``shingle`` words have a Jaccard similarity of
    ``percent`` per cent or more. Words are those of `simhash_groups`; a text with fewer words is one
    shingle, texts without words (null and empty ones) are alike. Shingles are compared by 64-bit
    hash and equal sets, named by a 64-bit hash, are one entry of all joins.

    Candidates come from the SimHash tables, and are confirmed on whole sets. Similarity 0.8 can lie ten and more
    bits apart, beyond any radius that tables of 64 bits reach at scale; what they leave is found by
    `path_links`, which leaves out the pairs that are linked by then. A pair at 0.8 is missed with about 3e-5.
    """
    docs = docs.select("doc_id", "text")
    rows, at = _stored(_described(docs, shingle), "similar-rows")
    links = confirmed(docs, rows, simhash_pairs(rows), shingle, percent)
    roots = components(path_links(docs, rows, shingle, percent, links)).withColumnRenamed("node", "sid")
    first = rows.groupBy("sid").agg(F.min("doc_id").alias("first_id"))
    named = first.join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_set = named.join(smallest, "root").select("sid", "component_id")
    out, _ = _stored(rows.select("doc_id", "h_text", "sid").join(of_set, "sid").drop("sid"), "similar-groups")
    drop_dir(docs.sparkSession, at)
    return out


def keep_one_similar(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its group, all columns unchanged.

    Rows with a null doc_id always stay. Rows that share a doc_id are judged by their own text.
    """
    dropped = similar_groups(docs, shingle, percent).where("doc_id > component_id")
    dropped = dropped.select(F.col("doc_id").alias("_doc_id"), F.col("h_text").alias("_h_text")).distinct()
    same = (docs["doc_id"] == dropped["_doc_id"]) & (F.xxhash64(docs["text"]) == dropped["_h_text"])
    return docs.join(dropped, same, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
