"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilgrid.session import drop_dir, new_dir


def _stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write below the shared folder and read again: the lineage ends here."""
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path), path


def _smallest(edges: DataFrame) -> DataFrame:
    """Smallest neighbour of each node; counted per task before the shuffle, so hubs cost one row."""
    return edges.groupBy("a").agg(F.min("b").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node named in ``edges`` (``a``, ``b``).

    Each round links all larger neighbours of a node to its smallest one (large star), then all
    smaller ones (small star); the number of rounds grows with the logarithm of the longest path.
    Each round is written to the shared folder and replaces the one before, so a lost executor costs one
    round at most. Self
    links, repeated links and both directions are allowed; rows with a null are ignored.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges, path = _stored(edges.where("a <> b").distinct(), "links")
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = _smallest(both).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        low = _smallest(large)
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        last = path
        edges, path = _stored(small.union(low.select("a", F.col("m").alias("b"))).distinct(), "links")
        drop_dir(edges.sparkSession, last)
        state = edges.agg(
            F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))
        ).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
