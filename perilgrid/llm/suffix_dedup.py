"""Suffix-array dedup: remove bytes covered by long strings that start anywhere else.

1. Every window of ``length`` bytes is named by the smallest hash of the ``gram``-byte strings in it
   (winnowing). Equal windows have equal names, so a name that stands in one place only rules out
   all its windows, and names can be judged apart. Windows next to each other that one place names
   are a run; the bytes of all its windows are its context.
2. Names whose runs all have the same context are settled: all their windows repeat.
3. The different contexts of the other names meet in groups of bounded size. Their suffixes are
   sorted in shards as Burrows-Wheeler transforms, which are merged by interleave refinement; the
   intervals of the merged order at depth ``length`` say which windows occur again.
4. The windows of names with too many different contexts for one group get longer names, with the
   smallest hashes by more orders of the strings, and are judged by these as before; at last a
   window is named by all its bytes.

Most steps look at the texts again. They are shuffled once, into buckets on disk; each step moves
only its runs to them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilgrid.llm.arrow import text_slices
from perilgrid.llm.bwt_merge import repeated_starts
from perilgrid.llm.shipping import ship_package
from perilgrid.session import drop_dir, new_dir

LENGTH = 400
GRAM = 64
# A text is scanned in parts of this many window starts, which bounds memory for long texts.
PART_STARTS = 2 << 20
# Bytes of different contexts merged at once, and the most contexts one name may bring.
GROUP_BYTES = 1 << 20
NAME_CONTEXTS = 2_000
# Further orders of the strings whose minima the longer names hold, step by step; WHOLE for all bytes.
WHOLE = 0
ORDERS = (2, 8, 32, WHOLE)
# Rows that repeat doc_id and text share their key.
ROW_KEY = ["row", "h_text"]

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return np.random.default_rng(64).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    ups, downs = np.full(n, _BASE), np.full(n, inverse)
    ups[:1] = downs[:1] = 1
    return np.cumprod(ups, dtype=np.uint64), np.cumprod(downs, dtype=np.uint64)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Mixed 64-bit hash of every ``gram`` bytes, by differences of one running sum."""
    n = len(data)
    ups, downs = _powers(1 << max(16, int(n - 1).bit_length()))
    sums = np.zeros(n + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_byte_values()[data] * ups[:n], dtype=np.uint64, out=sums[1:])
        hashes = (sums[gram:] - sums[:-gram]) * downs[: n - gram + 1]
        hashes ^= hashes >> np.uint64(32)
        hashes *= _MIX
        hashes ^= hashes >> np.uint64(29)
    return hashes


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours along the last axis, by doubling."""
    least, reach = values, 1
    while 2 * reach <= width:
        least = np.minimum(least[..., :-reach], least[..., reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(least[..., : least.shape[-1] - rest], least[..., rest:]) if rest else least


def runs_of(data: bytes, length: int, gram: int) -> list[tuple[int, int, int]]:
    """(begin, end, name) of the runs of window starts of one text.

    The windows of a run are named by one place, the first of the smallest hash in each of them, so
    equal windows lie at the same distance from different places of one name.
    """
    width = length - gram + 1
    runs = []
    for base in range(0, max(len(data) - length + 1, 0), PART_STARTS):
        part = np.frombuffer(data[base : base + PART_STARTS + length - 1], np.uint8)
        hashes = gram_hashes(part, gram)
        names = window_minima(hashes, width)
        # a run ends with its name, or where the place that gave the name leaves the windows
        moved = (names[1:] != names[:-1]) | (hashes[: len(names) - 1] == names[:-1])
        cuts = np.nonzero(moved)[0] + 1
        begins = np.concatenate([[0], cuts])
        ends = np.append(cuts, len(names))
        found = names[begins].view(np.int64)
        runs += zip((begins + base).tolist(), (ends + base).tolist(), found.tolist(), strict=True)
    return runs


@lru_cache(maxsize=4)
def _order_factors(orders: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(orders)
    first, second = (rng.integers(0, 1 << 63, (orders, 1), np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
    return first, second


def longer_names(data: bytes, begin: int, end: int, name: int, orders: int, length: int, gram: int) -> list[tuple[int, int, int]]:
    """(begin, end, name) of the parts of a run by the minima of its windows in more orders.

    The windows of a part share the place that named the run, so no two of one part are equal.
    """
    part = data[begin : end + length - 1]
    if orders == WHOLE:
        return [(begin + k, begin + k + 1, _signed(xxhash.xxh64_intdigest(part[k : k + length]))) for k in range(end - begin)]
    first, second = _order_factors(orders)
    with np.errstate(over="ignore"):
        ranked = gram_hashes(np.frombuffer(part, np.uint8), gram) * first
        ranked ^= ranked >> np.uint64(31)
        ranked *= _MIX
        names = (window_minima(ranked, length - gram + 1) * second).sum(axis=0, dtype=np.uint64)
        names = (names ^ np.uint64(name & (1 << 64) - 1)) * _MIX
    begins = np.concatenate([[0], np.nonzero(names[1:] != names[:-1])[0] + 1])
    ends = np.append(begins[1:], len(names))
    found = names[begins].view(np.int64)
    return list(zip((begins + begin).tolist(), (ends + begin).tolist(), found.tolist(), strict=True))


def _utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _scan(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(row, h_text, begin, end, name, context) of every run; ``context`` is a hash of its bytes."""
    schema = pa.schema([(n, pa.int64()) for n in ("row", "h_text", "begin", "end", "name", "context")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for part in text_slices(batches):
            rows = []
            columns = (part.column(c).to_pylist() for c in ("row", "h_text", "text"))
            for row, h_text, text in zip(*columns, strict=True):
                data = _utf8(text)
                if len(data) >= length:
                    view = memoryview(data)
                    rows += [
                        (row, h_text, b, e, name, _signed(digest(view[b : e + length - 1])))
                        for b, e, name in runs_of(data, length, gram)
                    ]
            yield _batch(schema, rows)

    return docs.select("row", "h_text", "text").mapInArrow(run, ", ".join(f"{f.name} long" for f in schema))


def _contexts(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(name, context, copies, bytes): the bytes of the contexts named by their first place.

    Rows that repeat doc_id and text bring the same contexts once each.
    """
    grouped = wanted.groupBy(*ROW_KEY).agg(
        F.collect_list(F.struct("begin", "end", "name", "context", "copies")).alias("runs")
    )
    schema = pa.schema(
        [("name", pa.int64()), ("context", pa.int64()), ("copies", pa.int64()), ("bytes", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            rows = []
            for text, runs in zip(part.column("text").to_pylist(), part.column("runs").to_pylist(), strict=True):
                data = _utf8(text)
                rows += [
                    (r["name"], r["context"], r["copies"], data[r["begin"] : r["end"] + length - 1]) for r in runs
                ]
            yield _batch(schema, rows)

    joined = _with_row_key(docs, grouped, "inner").select("text", "runs")
    return joined.mapInArrow(run, "name long, context long, copies long, bytes binary")


def _stored_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text, row, h_text) of ``docs``, shuffled once into buckets by ROW_KEY on disk.

    The table is entered in the catalog only until it is read: its files lie in the shared folder.
    """
    spark = docs.sparkSession
    # the hash passes over a null doc_id, so it differs from that of the same text with id 0
    keyed = docs.select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(0)).alias("row"), F.xxhash64("doc_id", "text").alias("h_text")
    )
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"suffix_dedup_{uuid.uuid4().hex}"
    writer = keyed.repartition(buckets, *ROW_KEY).write.format("parquet").option("compression", "zstd")
    writer.option("path", new_dir(spark, "texts")).bucketBy(buckets, *ROW_KEY).saveAsTable(table)
    stored = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return stored


def _with_row_key(docs: DataFrame, other: DataFrame, how: str) -> DataFrame:
    """Join rows grouped by ROW_KEY to the stored texts, whose buckets stay where they are."""
    return docs.join(other.hint("shuffle_hash"), ROW_KEY, how)


def _merged_windows(contexts: DataFrame, groups: int, length: int) -> DataFrame:
    """(name, context, firsts, ends): runs of offsets where windows start that occur again."""

    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by([("name", "ascending"), ("context", "ascending")])
        keys = list(zip(table.column("name").to_pylist(), table.column("context").to_pylist(), strict=True))
        table = table.filter(pa.array([k == 0 or key != keys[k - 1] for k, key in enumerate(keys)], pa.bool_()))
        weights = np.array(table.column("copies").to_pylist(), float)
        firsts, ends = [], []
        for starts in repeated_starts(table.column("bytes").to_pylist(), weights, length):
            cuts = np.nonzero(np.diff(starts) != 1)[0] + 1
            firsts.append(starts[np.concatenate([[0], cuts])] if len(starts) else starts)
            ends.append(starts[np.append(cuts, len(starts)) - 1] + 1 if len(starts) else starts)
        kind = pa.list_(pa.int64())
        return pa.table(
            {
                "name": table.column("name"),
                "context": table.column("context"),
                "firsts": pa.array(firsts, kind),
                "ends": pa.array(ends, kind),
            }
        )

    grouped = contexts.withColumn("_group", F.pmod(F.xxhash64("name"), F.lit(groups))).groupBy("_group")
    return grouped.applyInArrow(merge, "name long, context long, firsts array<long>, ends array<long>")


def _rescan(docs: DataFrame, hot: DataFrame, orders: int, length: int, gram: int) -> DataFrame:
    """The windows of hot runs as runs with longer names, in the columns of :func:`_scan`."""
    grouped = hot.groupBy(*ROW_KEY).agg(F.collect_set(F.struct("begin", "end", "name")).alias("runs"))
    schema = pa.schema([(n, pa.int64()) for n in ("row", "h_text", "begin", "end", "name", "context")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            columns = (part.column(c).to_pylist() for c in ("row", "h_text", "text", "runs"))
            for row, h_text, text, runs in zip(*columns, strict=True):
                data = _utf8(text)
                view = memoryview(data)
                rows = [
                    (row, h_text, b, e, name, _signed(xxhash.xxh64_intdigest(view[b : e + length - 1])))
                    for r in runs
                    for b, e, name in longer_names(data, r["begin"], r["end"], r["name"], orders, length, gram)
                ]
                yield _batch(schema, rows)

    joined = _with_row_key(docs, grouped, "inner").select("row", "h_text", "text", "runs")
    return joined.mapInArrow(run, ", ".join(f"{f.name} long" for f in schema))


def _judged(docs: DataFrame, scan: DataFrame, length: int, most: int | None) -> tuple[DataFrame, DataFrame | None]:
    """Spans of the windows of ``scan`` that occur again, and the runs whose names have over ``most`` contexts."""
    spark = docs.sparkSession
    scanned = new_dir(spark, "runs")
    scan.write.option("compression", "zstd").parquet(scanned)
    runs = spark.read.parquet(scanned)
    place = F.struct("row", "h_text", "begin", "end")
    copies = runs.groupBy("name", "context").agg(F.count("*").alias("copies"))
    names = copies.groupBy("name").agg(F.sum("copies").alias("total"), F.count("*").alias("kinds"))
    path = new_dir(spark, "repeated-names")
    names.where("total > 1").select("name", "kinds").write.parquet(path)
    repeated = new_dir(spark, "repeated-runs")
    runs.join(spark.read.parquet(path), "name").write.parquet(repeated)
    drop_dir(spark, scanned)  # all that is needed of it is written
    shared = spark.read.parquet(repeated)
    settled = shared.where("kinds = 1").select("row", "h_text", "begin", (F.col("end") + (length - 1)).alias("end"))
    mixed = shared.where("kinds > 1" if most is None else f"kinds > 1 AND kinds <= {most}")
    first = mixed.groupBy("name", "context").agg(F.min(place).alias("p"), F.count("*").alias("copies"))
    path = new_dir(spark, "contexts")
    first.select("p.*", "name", "context", "copies").write.parquet(path)
    wanted = spark.read.parquet(path)
    total = wanted.agg(F.sum(F.expr(f"end - begin + {length - 1}"))).first()[0] or 0
    groups = max(1, -(-total // GROUP_BYTES))
    path = new_dir(spark, "repeated-windows")
    _merged_windows(_contexts(docs, wanted, length), groups, length).where("size(firsts) > 0").write.parquet(path)
    found = mixed.join(spark.read.parquet(path), ["name", "context"])
    merged = found.select(
        "row", "h_text", F.col("begin").alias("base"), F.explode(F.arrays_zip("firsts", "ends")).alias("run")
    ).select(
        "row",
        "h_text",
        (F.col("base") + F.col("run.firsts")).alias("begin"),
        (F.col("base") + F.col("run.ends") + (length - 1)).alias("end"),
    )
    hot = None if most is None else shared.where(f"kinds > {most}").drop("kinds")
    return settled.unionByName(merged), hot


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(row, h_text, begin, end): byte spans of stored texts covered by windows that occur again, overlapping."""
    spans, hot = _judged(docs, _scan(docs, length, gram), length, NAME_CONTEXTS)
    for orders in ORDERS:
        if hot is None or hot.isEmpty():
            break
        scan = _rescan(docs, hot, orders, length, gram)
        more, hot = _judged(docs, scan, length, None if orders == WHOLE else NAME_CONTEXTS)
        spans = spans.unionByName(more)
    return spans


def _union(begins: list[int], ends: list[int]) -> list[tuple[int, int]]:
    joined: list[tuple[int, int]] = []
    for begin, end in sorted(zip(begins, ends, strict=True)):
        if joined and begin <= joined[-1][1]:
            if end > joined[-1][1]:
                joined[-1] = (joined[-1][0], end)
        else:
            joined.append((begin, end))
    return joined


def suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row of ``docs``.

    A byte of a text (UTF-8) is removed if a string of ``length`` bytes that covers it also starts
    anywhere else, in the same text (overlaps count) or another one. ``spans`` are the maximal
    removed runs as flat [begin, end, ...], ``kept`` the remaining bytes, which may cut a character.

    Null and empty texts have no bytes; texts shorter than ``length`` are kept whole; rows that
    repeat doc_id and text count as texts of their own and lose all windows; a null doc_id is kept
    as it is; an empty table gives no rows; other columns are ignored. Hashes of 128 bits stand for
    contexts that are not compared byte by byte. Tasks hold a slice of texts, or one group of
    contexts of about GROUP_BYTES. The texts are written to the shared folder when called, in
    ``spark.sql.shuffle.partitions`` buckets, and stay there for the result.
    """
    ship_package(docs.sparkSession)
    docs = _stored_texts(docs)
    spans = repeated_spans(docs, length, gram)
    grouped = spans.groupBy(*ROW_KEY).agg(
        F.collect_list("begin").alias("begins"), F.collect_list("end").alias("ends")
    )
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_bytes", pa.int64()),
            ("spans", pa.list_(pa.int64())),
            ("kept", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            rows = []
            columns = (part.column(c).to_pylist() for c in ("doc_id", "text", "begins", "ends"))
            for doc_id, text, begins, ends in zip(*columns, strict=True):
                data = _utf8(text)
                spans = _union(begins or [], ends or [])
                kept, at = [], 0
                for begin, end in spans:
                    kept.append(data[at:begin])
                    at = end
                kept.append(data[at:])
                rows.append((doc_id, len(data), [x for span in spans for x in span], b"".join(kept)))
            yield _batch(schema, rows)

    joined = _with_row_key(docs, grouped, "left").select("doc_id", "text", "begins", "ends")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, spans array<long>, kept binary")
