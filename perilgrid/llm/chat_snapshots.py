"""Chat formatting: drop logged conversations that a longer one continues, render the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from perilgrid.session import new_dir

# Turns whose running hash is computed together; longer conversations are chained by blocks.
BLOCK_TURNS = 256
_RUNNING = Window.unboundedPreceding, Window.currentRow


def _hashed(turns: DataFrame) -> DataFrame:
    """(conv_id, place, e1, e2) of each different turn; place counts from the first turn number."""
    parts = [F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(), F.coalesce("text", F.lit(""))]
    thin = turns.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(1), *parts).alias("h2")
    )
    thin = thin.distinct()
    first = thin.groupBy("conv_id").agg(F.min("turn").alias("first"))
    placed = thin.join(first, "conv_id")
    placed = placed.withColumn("place", F.coalesce(F.col("turn") - F.col("first"), F.lit(-1).cast("long")))
    return placed.select(
        "conv_id",
        "place",
        F.xxhash64("place", "h1", "h2").alias("e1"),
        F.xxhash64("h2", "place", "h1").alias("e2"),
    )


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, place, p1, p2, n): rolling 128-bit hash and count of the turns up to each place.

    The hash of a prefix is the exclusive or of the hashes of its placed turns, so it is carried
    from block to block: blocks of turns are summed first, their running sums are added to the
    running sums inside the blocks. A conversation of any length is many groups.
    """
    places = _hashed(turns).groupBy("conv_id", "place").agg(
        F.bit_xor("e1").alias("e1"), F.bit_xor("e2").alias("e2"), F.count("*").alias("k")
    )
    places = places.withColumn("block", F.floor(F.col("place") / BLOCK_TURNS))
    blocks = places.groupBy("conv_id", "block").agg(
        F.bit_xor("e1").alias("b1"), F.bit_xor("e2").alias("b2"), F.sum("k").alias("bk")
    )
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    chained = blocks.select(
        "conv_id",
        "block",
        F.coalesce(F.bit_xor("b1").over(before), F.lit(0).cast("long")).alias("c1"),
        F.coalesce(F.bit_xor("b2").over(before), F.lit(0).cast("long")).alias("c2"),
        F.coalesce(F.sum("bk").over(before), F.lit(0).cast("long")).alias("ck"),
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("place").rowsBetween(*_RUNNING)
    running = places.select(
        "conv_id",
        "block",
        "place",
        F.bit_xor("e1").over(inside).alias("r1"),
        F.bit_xor("e2").over(inside).alias("r2"),
        F.sum("k").over(inside).alias("rk"),
    )
    return running.join(chained, ["conv_id", "block"]).select(
        "conv_id",
        "place",
        F.expr("r1 ^ c1").alias("p1"),
        F.expr("r2 ^ c2").alias("p2"),
        (F.col("rk") + F.col("ck")).alias("n"),
    )


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns) of the conversations that no other one continues or repeats earlier.

    A conversation goes if its whole hash is the hash of a proper prefix of another one; of equal
    conversations the smallest conv_id stays. Both tables are reduced to one row per hash before
    they meet, so a first turn or a whole conversation that very many share costs one row.
    """
    spark = turns.sparkSession
    path = new_dir(spark, "turn-prefixes")
    prefix_hashes(turns).write.parquet(path)
    prefixes = spark.read.parquet(path)
    last = prefixes.groupBy("conv_id").agg(F.max("n").alias("n_turns"))
    marked = prefixes.join(last, "conv_id")
    proper = marked.where("n < n_turns").select("p1", "p2", "n").distinct()
    whole = marked.where("n = n_turns").groupBy("p1", "p2", "n").agg(F.min("conv_id").alias("conv_id"))
    kept = whole.join(proper, ["p1", "p2", "n"], "left_anti")
    return kept.select("conv_id", F.col("n").alias("n_turns"))


def rendered(trained_role: str = "assistant") -> tuple[Column, Column]:
    """Columns ``trained`` and ``piece`` of a turn (``role``, ``text``) in chat markup.

    The pieces of a conversation, in order of turn, are its training text; ``trained`` marks those
    a model learns from. One row per turn, so a long conversation needs no group.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    piece = F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))
    return F.coalesce(F.col("role") == trained_role, F.lit(False)).alias("trained"), piece.alias("piece")


def format_chats(turns: DataFrame) -> DataFrame:
    """Rendered turns (conv_id, n_turns, turn, role, trained, piece) of the maximal conversations.

    ``turns`` has conv_id, turn, role and text; other columns are ignored. Conversations are
    compared turn by turn at equal distance from their first turn number, by role and text (null
    and empty differ); prefixes are recognised by 128-bit hashes. Rows without conv_id belong to
    no conversation and are left out; rows without a turn number come before the first turn;
    fully repeated rows count once; an empty table gives no rows. DataFrame functions only.
    """
    kept = maximal_conversations(turns)
    rows = turns.select("conv_id", "turn", "role", "text").join(kept, "conv_id")
    rows = rows.dropDuplicates(["conv_id", "turn", "role", "text"])
    return rows.select("conv_id", "n_turns", "turn", "role", *rendered())
