"""Phrase collocations: count transducers of sorted shard n-grams, united and summed over prefix ranges."""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from perilgrid.llm.arrow import text_slices
from perilgrid.llm.shipping import ship_package
from perilgrid.session import drop_dir, new_dir

LEAST = 10  # occurrences of a candidate
CONTAINED_PERCENT = 50
TOP = 2000
NO_LANG = "und"
SHARD_WORDS = 3 << 20
FILTER_BITS = 1 << 25

_KEYS = ["lang", "state", "label"]
_ARC = "lang string, state string, label string, weight long"
_SCHEMA = pa.schema([("lang", pa.string()), ("state", pa.string()), ("label", pa.string()), ("weight", pa.int64())])
_BREAK = b"\xff"  # no byte of UTF-8
_FOLD = bytes(0xFF if chr(b) in ".,;:!?\n\x0b\f\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))


class Shard:
    """Words of one language, as numbers, until they are counted."""

    def __init__(self):
        self.numbers: dict[bytes, int] = defaultdict(itertools.count(1).__next__)
        self.numbers[_BREAK] = 0
        self.runs: list[np.ndarray] = []
        self.words = 0

    def add(self, texts: list[str]) -> None:
        joined = _BREAK.join(t.encode("utf-8", "surrogatepass").translate(_FOLD) for t in texts)
        found = (joined + _BREAK).replace(_BREAK, b" " + _BREAK + b" ").split()
        run = np.fromiter(map(self.numbers.__getitem__, found), np.int64, len(found))
        self.runs.append(run)
        self.words += int(np.count_nonzero(run))

    def sorted_words(self) -> tuple[pa.Array, np.ndarray]:
        """The vocabulary in byte order, and the text as places in it; -1 ends a piece."""
        order = sorted(w for w in self.numbers if w != _BREAK)
        place = np.full(len(order) + 1, -1, np.int64)
        place[[self.numbers[w] for w in order]] = np.arange(len(order))
        run = place[np.concatenate(self.runs)] if self.runs else np.empty(0, np.int64)
        return pa.array(order, pa.binary()).cast(pa.string()), run


def transducer(lang: str, shard: Shard, orders: tuple[int, ...], known: np.ndarray | None = None) -> Iterator[pa.Table]:
    """Arcs of the count transducer of a shard's n-grams, in sorted order.

    A state is a prefix, written as its words; an arc leads from it by one more word and weighs the
    occurrences of the whole. N-grams come sorted, so the arcs of a state follow each other and every
    state is complete when the next one begins. The start state has an arc without a label that weighs
    all words. Three-word arcs are left out where ``known``, a filter of two-word arcs, lacks one of
    their halves.
    """
    words, run = shard.sorted_words()
    size = max(1, len(words))
    if 1 in orders:
        label, weight = np.unique(run[run >= 0], return_counts=True)
        yield _arcs(lang, pa.array([""]), pa.array([""]), np.array([shard.words]))
        yield _arcs(lang, pa.repeat(pa.scalar(""), len(label)), words.take(pa.array(label)), weight)
    inside = (run[:-1] >= 0) & (run[1:] >= 0)
    pairs = np.where(inside, run[:-1] * size + run[1:], -1)
    arc, number, weight = np.unique(pairs, return_inverse=True, return_counts=True)
    if 2 in orders:
        real = arc >= 0
        yield _arcs(lang, words.take(pa.array(arc[real] // size)), words.take(pa.array(arc[real] % size)), weight[real])
    if 3 in orders and len(pairs) > 1:
        wanted = arc >= 0 if known is None else _probably(lang, words, arc, size, known)
        follows = wanted[number[:-1]] & wanted[number[1:]]
        triple, weight = np.unique(number[:-1][follows] * size + run[2:][follows], return_counts=True)
        first, last = arc[triple // size], words.take(pa.array(triple % size))
        state = pc.binary_join_element_wise(words.take(pa.array(first // size)), words.take(pa.array(first % size)), " ")
        yield _arcs(lang, state, last, weight)


def _arcs(lang: str, state: pa.Array, label: pa.Array, weight: np.ndarray) -> pa.Table:
    columns = [pa.repeat(pa.scalar(lang), len(weight)), state, label, pa.array(weight, pa.int64())]
    return pa.Table.from_arrays(columns, schema=_SCHEMA)


# Place of an arc in the filter, in SQL and below; words are hashed once each.
_PLACE = f"pmod(xxhash64(lang, state) ^ xxhash64(label, lang), {FILTER_BITS}L)"


def _probably(lang: str, words: pa.Array, arc: np.ndarray, size: int, known: np.ndarray) -> np.ndarray:
    """Which two-word arcs the filter may hold."""
    names = [w.encode("utf-8", "surrogatepass") for w in words.to_pylist()]
    code, h = lang.encode(), xxhash.xxh64_intdigest
    seed = h(code, 42)
    state = np.fromiter((h(w, seed) for w in names), np.uint64, len(names))
    label = np.fromiter((h(code, h(w, 42)) for w in names), np.uint64, len(names))
    real = arc >= 0
    bit = np.zeros(len(arc), np.uint64)
    bit[real] = (state[arc[real] // size] ^ label[arc[real] % size]) % np.uint64(FILTER_BITS)
    return real & ((known[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1)


def shard_arcs(docs: DataFrame, orders: tuple[int, ...], known: np.ndarray | None = None) -> DataFrame:
    """Arcs of the transducers of all shards; a shard is up to SHARD_WORDS words that a task reads."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[str, Shard] = defaultdict(Shard)
        for part in text_slices(batches):
            by_lang = defaultdict(list)
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                by_lang[lang].append(text or "")
            for lang, texts in by_lang.items():
                shards[lang].add(texts)
            if sum(s.words for s in shards.values()) >= SHARD_WORDS:
                for lang in sorted(shards):
                    for table in transducer(lang, shards.pop(lang), orders, shared.value):
                        yield from table.to_batches(max_chunksize=1 << 16)
        for lang in sorted(shards):
            for table in transducer(lang, shards.pop(lang), orders, shared.value):
                yield from table.to_batches(max_chunksize=1 << 16)

    return docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), "text").mapInArrow(run, _ARC)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows with the starts of their runs of equal keys; no run is cut."""
    held: list[pa.RecordBatch] = []

    def cut(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[0] = True
        for k in _KEYS:
            column = table[k].combine_chunks()
            new[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
        return new.nonzero()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch])
        starts = cut(table)
        if len(starts) > 1:
            yield table.slice(0, starts[-1]), starts[:-1]
        held = table.slice(starts[-1]).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, cut(table)


def _by_prefix(df: DataFrame, *more: Column) -> DataFrame:
    return df.repartitionByRange(*_KEYS).sortWithinPartitions(*_KEYS, *more)


def union_arcs(arcs: DataFrame, least: int) -> DataFrame:
    """The united transducer: weights of equal arcs summed, arcs below ``least`` left out.

    Arcs go to ranges of prefixes and come sorted there, so a range is united in one pass that holds one
    arc at a time, whatever the number of arcs of a state or of a language. ``arcs`` is a written table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _runs(batches):
            weight = np.add.reduceat(table["weight"].to_numpy(), starts)
            stays = (weight >= least) | pc.equal(table["label"].combine_chunks().take(pa.array(starts)), "").to_numpy(zero_copy_only=False)
            out = table.take(pa.array(starts[stays]))
            yield from out.set_column(3, "weight", pa.array(weight[stays], pa.int64())).select(_SCHEMA.names).cast(_SCHEMA).to_batches()

    return _by_prefix(arcs).mapInArrow(run, _ARC)


def compose(arcs: DataFrame, parts: DataFrame) -> DataFrame:
    """Weights of the ``parts`` (lang, state, label) by composing them with a united transducer.

    Both are sorted over the same prefix ranges and walked side by side: a part follows the arc of its key.
    """
    both = arcs.select(*_KEYS, "weight").union(parts.select(*_KEYS, F.lit(None).cast("long").alias("weight")).distinct())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _runs(batches):
            met = np.diff(np.append(starts, table.num_rows)) > 1
            yield from table.take(pa.array(starts[met])).select(_SCHEMA.names).cast(_SCHEMA).to_batches()

    return _by_prefix(both, F.desc_nulls_last("weight")).mapInArrow(run, _ARC)


def arc_filter(arcs: DataFrame) -> np.ndarray:
    """A bitmap of FILTER_BITS bits over the arcs, built in Spark; its size does not grow with them."""
    bit = arcs.select(F.expr(_PLACE).alias("bit"))
    cells = bit.groupBy(F.expr("bit div 64").alias("cell")).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 AS int)))").alias("bits"))
    found = cells.toArrow()
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[found["cell"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of two and three words of each language.

    Texts are cut at ``.,;:!?`` and line ends into pieces, pieces at blanks and tabs into words, A-Z in lower
    case. a counts all occurrences of a phrase inside pieces, l and r those of the parts before and after a cut,
    n all words of the language. Of the cuts the lowest score floor(10^6 a a / (l r)) counts, the first among
    equals. Phrases below ``least`` occurrences do not take part; a two-word phrase is dropped if a three-word
    phrase around it has at least half of its occurrences. Ranked by score, a, phrase.

    Words and pairs are counted first; a three-word phrase is counted only where both its pairs may be frequent (a
    phrase is never more frequent than its parts, so nothing is lost). The numbers are exact: counts are 64 bits,
    products decimal(38).

    A null lang is ``und``; null and empty texts have no words; rows may repeat and count each. An empty table gives
    no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = []

    def stored(df: DataFrame, label: str) -> DataFrame:
        scratch.append(new_dir(spark, label))
        df.write.parquet(scratch[-1])
        return spark.read.parquet(scratch[-1])

    def counted(orders: tuple[int, ...], known: np.ndarray | None = None) -> DataFrame:
        arcs = stored(shard_arcs(docs, orders, known), "shard-arcs")
        raw = scratch[-1]
        united = stored(union_arcs(arcs, least), "united-arcs")
        drop_dir(spark, raw)
        return united

    low = counted((1, 2))
    pairs = low.where("state <> '' AND label <> ''")
    triples = counted((3,), arc_filter(pairs))
    totals = low.where("state = '' AND label = ''").select("lang", F.col("weight").alias("n"))
    arcs = low.where("label <> ''").union(triples)
    cuts = pairs.selectExpr("lang", "concat(state, ' ', label) AS phrase", "weight AS a", "1 AS k", "'' AS s1", "state AS l1", "'' AS s2", "label AS l2")
    three = triples.selectExpr("lang", "concat(state, ' ', label) AS phrase", "weight AS a", "split(state, ' ') AS w", "label")
    cuts = cuts.union(three.selectExpr("lang", "phrase", "a", "1", "''", "w[0]", "w[1]", "label"))
    cuts = stored(cuts.union(three.selectExpr("lang", "phrase", "a", "2", "w[0]", "w[1]", "''", "label")), "phrase-cuts")
    parts = cuts.selectExpr("lang", "s1 AS state", "l1 AS label").union(cuts.selectExpr("lang", "s2", "l2"))
    weights = stored(compose(arcs, parts), "part-weights")
    first = weights.selectExpr("lang", "state AS s1", "label AS l1", "weight AS l")
    rest = weights.selectExpr("lang", "state AS s2", "label AS l2", "weight AS r")
    scored = cuts.join(first, ["lang", "s1", "l1"]).join(rest, ["lang", "s2", "l2"])
    exact = "cast((1000000 * cast(a AS decimal(19)) * cast(a AS decimal(19))) div (cast(l AS decimal(19)) * cast(r AS decimal(19))) AS long)"
    scored = scored.withColumn("score", F.expr(exact))
    least_cut = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    around = triples.selectExpr("lang", "explode(array(state, concat(split(state, ' ')[1], ' ', label))) AS phrase", "weight")
    around = around.groupBy("lang", "phrase").agg(F.max("weight").alias("longer"))
    kept = least_cut.join(around, ["lang", "phrase"], "left").where(f"longer IS NULL OR 100 * longer < {CONTAINED_PERCENT} * a")
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    best = best.join(totals, "lang").select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    path = new_dir(spark, "collocations")
    best.write.parquet(path)
    for old in scratch:
        drop_dir(spark, old)
    return spark.read.parquet(path)
