"""Benchmark decontamination: Wu-Manber search for benchmark windows in documents."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilgrid.llm.arrow import map_texts, text_slices
from perilgrid.llm.shipping import ship_package
from perilgrid.session import new_dir

WINDOW = 10
BLOCK_WORDS = 2  # words hashed together in the shift table
LANE = 512  # words that one cursor scans; cursors advance side by side
# Benchmark text (bytes of distinct windows) that one broadcast pattern set may hold.
BLOCK_BYTES = 32 << 20

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    """UTF-8 words, A-Z in lower case."""
    return _WORD.findall(text.encode("utf-8", "surrogatepass").lower())


class _Patterns:
    """Shift table and suffix buckets of patterns of one length (in word numbers, from 1)."""

    def __init__(self, rows: np.ndarray, numbers: np.ndarray):
        self.length = rows.shape[1]
        self.block = min(BLOCK_WORDS, self.length)
        blocks = len(rows) * (self.length - self.block + 1)
        self._shift_by = np.uint64(64 - max(10, int(4 * blocks).bit_length()))
        self.shift = np.full(1 << (64 - int(self._shift_by)), self.length - self.block + 1, np.int16)
        for end in range(self.block - 1, self.length):
            hashes = self._hash([rows[:, end - b] for b in range(self.block)])
            np.minimum.at(self.shift, hashes, self.length - 1 - end)
        # a bucket is the run of equal (suffix block, first word); inside it patterns are compared
        keys = self._key(rows[:, -1], rows[:, self.length - self.block], rows[:, 0])
        order = np.argsort(keys, kind="stable")
        self.keys, self.rows, self.numbers = keys[order], rows[order], numbers[order]

    def _hash(self, words: list[np.ndarray]) -> np.ndarray:
        value = np.zeros(len(words[0]), np.uint64)
        with np.errstate(over="ignore"):
            for word in words:
                value = (value + word.astype(np.uint64) + np.uint64(1)) * _MIX
                value ^= value >> np.uint64(29)
            value *= _MIX
        return (value >> self._shift_by).astype(np.int64)

    @staticmethod
    def _key(last: np.ndarray, before: np.ndarray, first: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            value = last.astype(np.uint64) * _MIX + before.astype(np.uint64)
            value ^= value >> np.uint64(31)
            return value * _MIX + first.astype(np.uint64)

    def candidates(self, words: np.ndarray) -> np.ndarray:
        """Ends of windows that the shift table cannot rule out."""
        first = self.length - 1
        at = np.arange(first, len(words), LANE, dtype=np.int64)
        stop = np.minimum(at + LANE, len(words))
        found = [np.zeros(0, np.int64)]
        while len(at):
            shift = self.shift[self._hash([words[at - b] for b in range(self.block)])]
            hit = shift == 0
            if hit.any():
                found.append(at[hit])
            at = at + np.maximum(shift, 1)
            open_ = at < stop
            at, stop = at[open_], stop[open_]
        return np.concatenate(found)

    def search(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, pattern number) of every occurrence."""
        ends = self.candidates(words)
        starts = ends - self.length + 1
        keys = self._key(words[ends], words[ends - self.block + 1], words[starts])
        low = np.searchsorted(self.keys, keys, "left")
        counts = np.searchsorted(self.keys, keys, "right") - low
        rows = np.repeat(np.arange(len(starts)), counts)
        inside = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
        patterns, starts = low[rows] + inside, starts[rows]
        same = np.ones(len(rows), bool)
        for k in range(self.length):  # direct comparison, word by word
            same[same] = words[starts[same] + k] == self.rows[patterns[same], k]
        return starts[same], self.numbers[patterns[same]]


class Matcher:
    """All windows of one block of the benchmark, by length, and the items each belongs to."""

    def __init__(self, windows: list[str], items: list[list[str]]):
        self.items = items
        self.numbers: dict[bytes, int] = {}
        by_length: dict[int, list[tuple[int, list[int]]]] = {}
        for number, window in enumerate(windows):
            words = window.encode("utf-8", "surrogatepass").split(b" ")
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words]
            by_length.setdefault(len(ids), []).append((number, ids))
        self.classes = [
            _Patterns(np.array([ids for _, ids in found], np.int64), np.array([n for n, _ in found]))
            for _, found in sorted(by_length.items())
        ]

    def search(self, documents: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
        """(start, end, window number) of the occurrences in each document, in words."""
        counts = np.array([len(d) for d in documents], np.int64)
        bounds = np.concatenate([[0], np.cumsum(counts + 1)])
        words = np.zeros(int(bounds[-1]), np.int64)  # one unknown word parts the documents
        for begin, document in zip(bounds, documents, strict=False):
            numbers = map(self.numbers.get, document, repeat(0))
            words[begin : begin + len(document)] = np.fromiter(numbers, np.int64, len(document))
        found: list[list[tuple[int, int, int]]] = [[] for _ in documents]
        for patterns in self.classes:
            starts, numbers = patterns.search(words)
            owners = np.searchsorted(bounds, starts, "right") - 1
            for start, number, owner in zip(starts.tolist(), numbers.tolist(), owners.tolist(), strict=True):
                begin = start - int(bounds[owner])
                found[owner].append((begin, begin + patterns.length, number))
        return found


def windows_of(benchmark: DataFrame, window: int) -> DataFrame:
    """(window, item): each distinct window of the items' words, joined by single spaces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            for item, text in zip(part.column("item").to_pylist(), part.column("text").to_pylist(), strict=True):
                words = words_of(text or "")
                width = min(window, len(words))
                grams = {b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()
                rows = [g.decode("utf-8", "surrogatepass") for g in sorted(grams)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows, pa.string()), pa.array([item] * len(rows), pa.string())], names=["window", "item"]
                )

    ship_package(benchmark.sparkSession)
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    return items.mapInArrow(run, "window string, item string").distinct()


def pattern_blocks(benchmark: DataFrame, window: int = WINDOW) -> list:
    """Broadcast matchers that together hold every window of the benchmark.

    The bytes of the windows are summed first; blocks are dealt out by the hash of the window so
    that each stays near BLOCK_BYTES, and only one at a time is on the driver.
    """
    spark = benchmark.sparkSession
    path = new_dir(spark, "benchmark-windows")
    windows_of(benchmark, window).write.parquet(path)
    rows = spark.read.parquet(path)
    size = rows.agg(F.sum(F.octet_length("window") + F.octet_length("item"))).first()[0] or 0
    n_blocks = -(-size // BLOCK_BYTES)
    blocks = []
    for k in range(n_blocks):
        part = rows.where(F.pmod(F.xxhash64("window"), F.lit(n_blocks)) == k)
        found: dict[str, list[str]] = {}
        for row in part.toLocalIterator():
            found.setdefault(row["window"], []).append(row["item"])
        blocks.append(spark.sparkContext.broadcast(Matcher(list(found), list(found.values()))))
    return blocks


def _merge(spans: list[int], occurrences: list[tuple[int, int, int]]) -> list[int]:
    """Union of flat [start, end, ...] spans and occurrences, sorted and disjoint."""
    pairs = sorted([*zip(spans[::2], spans[1::2], strict=True), *((s, e) for s, e, _ in occurrences)])
    merged: list[int] = []
    for start, end in pairs:
        if merged and start <= merged[-1]:
            merged[-1] = max(merged[-1], end)
        else:
            merged += [start, end]
    return merged


_STATE = "doc_id long, text string, n_words long, spans array<long>, items array<string>"


def _scanner(block) -> Callable[..., dict]:
    def rows(doc_id: list, text: list[str], n_words: list, spans: list, items: list) -> dict:
        documents = [words_of(t) for t in text]
        found = block.value.search(documents)
        names = block.value.items
        return {
            "doc_id": doc_id,
            "text": text,
            "n_words": [len(d) for d in documents],
            "spans": [_merge(s, f) for s, f in zip(spans, found, strict=True)],
            "items": [
                sorted({*i, *(name for _, _, n in f for name in names[n])}) if f else i
                for i, f in zip(items, found, strict=True)
            ],
        }

    return rows


def _counter(doc_id: list, text: list[str], n_words: list, spans: list, items: list) -> dict:
    return {"doc_id": doc_id, "text": text, "n_words": [len(words_of(t)) for t in text], "spans": spans, "items": items}


def find_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, spans, items, contaminated) of every row of ``docs``.

    Words are runs of letters, digits and characters outside ASCII, A-Z in lower case. Patterns
    are the windows of ``window`` consecutive words of an item, or the whole item if it is shorter.
    They are searched word-wise by Wu-Manber: the shift table of two-word blocks skips places where
    no window can end, the hash of the last block and the first word selects windows, and these are
    compared word by word. ``spans`` are the words hit as flat [start, end, ...], ``items`` the
    item_ids (as strings, sorted) with an occurrence.

    Null and empty texts have no words; items without words match nothing; a null item_id counts
    as the item ''; equal windows belong to all their items; repeated rows and null doc_ids keep
    their rows; an empty benchmark leaves every document clean; other columns are ignored. The
    documents are read once and not shuffled; a benchmark beyond one block is searched block after
    block in the same pass.
    """
    state = docs.select(
        "doc_id",
        "text",
        F.lit(0).cast("long").alias("n_words"),
        F.expr("CAST(array() AS array<bigint>)").alias("spans"),
        F.expr("CAST(array() AS array<string>)").alias("items"),
    )
    blocks = pattern_blocks(benchmark, window)
    for rows in [_scanner(b) for b in blocks] or [_counter]:
        state = map_texts(state, _STATE, rows)
    n_hit = F.expr("aggregate(sequence(0, size(spans) div 2 - 1), 0L, (n, i) -> n + spans[2 * i + 1] - spans[2 * i])")
    n_hit = F.when(F.size("spans") > 0, n_hit).otherwise(F.lit(0).cast("long"))
    return state.select("doc_id", "n_words", n_hit.alias("n_hit"), "spans", "items", (F.size("spans") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any occurrence, all columns unchanged."""
    for block in pattern_blocks(benchmark, window):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            for part in text_slices(batches):
                documents = [words_of(t or "") for t in part.column("text").to_pylist()]
                clean = [not f for f in block.value.search(documents)]
                yield part.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
