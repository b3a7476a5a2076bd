"""Packing token streams into fixed windows: bounded-space best fit, leftovers merged at the end."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from perilgrid.llm.arrow import text_slices
from perilgrid.llm.shipping import ship_package
from perilgrid.llm.tokens import encoder
from perilgrid.session import new_dir

OPEN_WINDOWS = 32
_ID = 4  # bytes of a token id
_STRIDE = 33  # bits of a window's number inside its partition

SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
    "offset long, part long, full boolean"
)
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("part", pa.int64()),
        ("full", pa.bool_()),
    ]
)


class Packer:
    """Open windows of one partition; ``done`` collects the pieces of windows that are emitted."""

    def __init__(self, size: int, open_windows: int):
        self.size, self.limit = size, open_windows
        self.open: list[list] = []  # [tokens held, [(document, start, ids)]]
        self.done: list[list[tuple]] = []

    def add(self, document: tuple, ids: bytes) -> None:
        """Place all tokens of a document: whole windows first, the rest by best fit.

        If no open window has room and no more may be opened, the fullest one is filled up with
        the head of the document and emitted, so that nothing is padded before the end.
        """
        total, at = len(ids) // _ID, 0
        while total - at >= self.size:
            self.done.append([(document, at, ids[at * _ID : (at + self.size) * _ID])])
            at += self.size
        while at < total:
            rest = total - at
            room = [w for w in self.open if self.size - w[0] >= rest]
            if room:
                window = max(room, key=lambda w: w[0])
            elif len(self.open) < self.limit:
                window = [0, []]
                self.open.append(window)
            else:
                window = max(self.open, key=lambda w: w[0])
            take = min(rest, self.size - window[0])
            window[1].append((document, at, ids[at * _ID : (at + take) * _ID]))
            window[0] += take
            at += take
            if window[0] == self.size:
                self.done.append(window[1])
                self.open.remove(window)

    def close(self) -> list[tuple]:
        """Merge what the open windows hold; the pieces that do not fill a window are returned."""
        pieces = [piece for window in self.open for piece in window[1]]
        self.open = []
        held, current = 0, []
        for document, start, ids in pieces:
            at, total = 0, len(ids) // _ID
            while at < total:
                take = min(total - at, self.size - held)
                current.append((document, start + at, ids[at * _ID : (at + take) * _ID]))
                held, at = held + take, at + take
                if held == self.size:
                    self.done.append(current)
                    held, current = 0, []
        return current


def _rows(windows: list[list[tuple]], part: int, first: int, full: bool) -> pa.RecordBatch:
    columns: list[list] = [[] for _ in _ARROW]
    for number, pieces in enumerate(windows, first):
        offset = 0
        for (doc_id, total), start, ids in pieces:
            length = len(ids) // _ID
            row = (doc_id, start, length, ids, total, (part << _STRIDE) | number, offset, part, full)
            for column, value in zip(columns, row, strict=True):
                column.append(value)
            offset += length
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, _ARROW, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=_ARROW)


def _pack_partitions(docs: DataFrame, tokenizer: str, end_id: int, size: int, open_windows: int) -> DataFrame:
    ship_package(docs.sparkSession)
    end = end_id.to_bytes(_ID, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode = encoder(tokenizer).encode
        packer, emitted = Packer(size, open_windows), 0
        for batch in text_slices(batches):
            texts = batch.column("text").to_pylist()
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                ids = encode(text) + end if text else end
                packer.add((doc_id, len(ids) // _ID), ids)
            yield _rows(packer.done, part, emitted, True)
            emitted += len(packer.done)
            packer.done = []
        rest = packer.close()
        yield _rows(packer.done, part, emitted, True)
        yield _rows([rest], part, 0, False)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def _merge_leftovers(rest: DataFrame, size: int, last_part: int) -> DataFrame:
    """Join the partitions' leftovers end to end and cut them into windows.

    Only one sum per partition is brought together, to give each its place. What does not fill
    the last window is cut at powers of two, so no sequence needs padding.
    """
    sums = rest.groupBy("part").agg(F.sum("length").alias("held"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    total = sums.agg(F.sum("held")).first()[0] or 0
    tail = total - total % size
    ends, at = [], tail
    for bit in range(size.bit_length(), -1, -1):
        if (total - tail) >> bit & 1:
            at += 1 << bit
            ends.append(at)
    placed = rest.join(bases, "part").withColumn("begin", F.col("base") + F.col("offset"))
    placed = placed.withColumn("finish", F.col("begin") + F.col("length"))
    tail_ends = F.expr(f"array({', '.join(f'{e}L' for e in ends)})") if ends else F.expr("array(0L)")
    placed = placed.withColumn("tail_ends", tail_ends)
    # window borders inside the piece, then the pieces between them
    placed = placed.withColumn(
        "borders",
        F.expr(
            f"""array_distinct(array_sort(concat(
                array(begin, finish),
                filter(array(begin - begin % {size}L + {size}L), b -> b < least(finish, {tail}L + 1L)),
                filter(tail_ends, b -> b > begin AND b < finish))))"""
        ),
    )
    cut = placed.select(
        "*", F.posexplode(F.expr("slice(borders, 1, size(borders) - 1)")).alias("k", "from")
    ).withColumn("to", F.expr("borders[k + 1]"))
    cut = cut.withColumn("in_tail", F.expr(f"size(filter(tail_ends, b -> b <= from AND b > {tail}L))"))
    origin = F.expr(
        f"""CASE WHEN from < {tail}L THEN from - from % {size}L
            ELSE coalesce(array_max(filter(tail_ends, b -> b <= from AND b > {tail}L)), {tail}L) END"""
    )
    window = F.expr(f"CASE WHEN from < {tail}L THEN from div {size}L ELSE {tail // size}L + in_tail END")
    return cut.select(
        "doc_id",
        (F.col("start") + F.col("from") - F.col("begin")).alias("start"),
        (F.col("to") - F.col("from")).alias("length"),
        F.expr(f"substring(ids, CAST({_ID} * (from - begin) + 1 AS INT), CAST({_ID} * (to - from) AS INT))").alias("ids"),
        "doc_tokens",
        (window + F.lit(last_part << _STRIDE).cast("long")).alias("sequence_id"),
        (F.col("from") - origin).alias("offset"),
    )


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    size: int = 4096,
    open_windows: int = OPEN_WINDOWS,
) -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset) of packed sequences.

    Each document is its token ids and ``end_id``. Every partition keeps at most ``open_windows``
    windows of ``size`` ids open; a document goes to the fullest window that has room for all of
    it, and if there is none the fullest window is filled up and emitted. The leftovers of the
    partitions are merged and cut into windows, the last ones at powers of two, so that no
    sequence is padded. ``ids`` are little-endian unsigned 32-bit integers.

    Null and empty texts are the end id alone. Rows are packed one by one, so repeated and null
    doc_ids keep their rows; an empty table gives no rows; other columns are ignored. A task holds
    its open windows and one document, whatever the size of the table; tasks depend on their input
    partition alone, so one that runs again gives the same rows.
    """
    spark = docs.sparkSession
    path = new_dir(spark, "packed")
    packed = _pack_partitions(docs, tokenizer, end_id, size, open_windows)
    packed.write.partitionBy("full").option("compression", "zstd").parquet(path)
    rows = spark.read.schema(SCHEMA).parquet(path)
    last = rows.agg(F.max("part")).first()[0]
    full = rows.where("full").select("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
    return full.unionByName(_merge_leftovers(rows.where("NOT full"), size, (last or 0) + 1))
