"""GeoJSON of any layout, split over tasks: a structural scan whose chunk states compose.

A file is read in byte ranges, each a run of pieces that end at a closing brace. What a range does to the
scan is a small state change - containers closed, containers left open, inside a string or not - that can be
computed for either start without knowing which holds. The changes of a file, put together in order, give the
state at the start of every range; with it each task finds the features of its own range. Only features that a
range border cuts are put together in a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perilgrid.operators.keyed_join import BROADCAST_BYTES, row_bytes
from perilgrid.session import new_dir, ship_package

# Open containers from the outside in: '{' object, '[' array, 'C' outermost object that has a list of
# features, 'F' that list or an outermost array. Features are the objects right inside of 'F', or outermost.
_LIST = re.compile(rb'"features"\s*:\s*(\[)')
_ESCAPE = re.compile(rb"\\.", re.DOTALL)
_FEATURE_DEPTH = 2  # containers around a feature at most
_BLANK = b" \t\r\n,\xef\xbb\xbf"
BLOCK_BYTES = 8 << 20


@dataclass
class Change:
    """What a stretch of text does to the stack of open containers.

    It closes ``pops`` of those at its start and leaves ``pushes`` open. ``listed`` are the places, counted
    from the innermost container at its start (0) outwards (-1, ...), of objects in which it opens a list of
    features.
    """

    pops: int = 0
    pushes: str = ""
    in_string: bool = False
    listed: tuple[int, ...] = ()

    def after(self, stack: str) -> str:
        if stack and 1 - len(stack) in self.listed and stack[0] == "{":
            stack = "C" + stack[1:]
        return _marked(stack[: max(0, len(stack) - self.pops)] + self.pushes)

    def then(self, later: Change) -> Change:
        kept = list(self.pushes)
        listed = set(self.listed)
        for place in later.listed:
            if -place < len(kept):
                kept[place - 1] = "C"
            else:
                listed.add(place + len(kept) - self.pops)
        pops = self.pops + max(0, later.pops - len(kept))
        return Change(pops, "".join(kept[: max(0, len(kept) - later.pops)]) + later.pushes, later.in_string, tuple(sorted(listed)))


def _marked(stack: str) -> str:
    """Marks of a whole stack: a list of features counts in the outermost object only."""
    marks = [("[" if c == "F" else "{" if c == "C" else c) for c in stack]
    if stack[:1] in ("[", "F"):
        marks[0] = "F"
    elif stack[:1] in ("{", "C"):
        if stack[1:2] == "F":
            marks[:2] = "C", "F"
        elif stack[0] == "C":
            marks[0] = "C"
    return "".join(marks)


@dataclass
class Structure:
    """Structural characters of a text outside of strings, and where strings begin and end."""

    at: np.ndarray
    step: np.ndarray
    kind: list[str] = field(default_factory=list)
    in_string: bool = False

    @classmethod
    def of(cls, text: bytes, in_string: bool) -> Structure:
        plain = _ESCAPE.sub(b"  ", text) if b"\\" in text else text
        data = np.frombuffer(plain, np.uint8)
        quotes = np.cumsum(data == ord('"')) + in_string
        opens = (data == ord("{")) | (data == ord("["))
        closes = (data == ord("}")) | (data == ord("]"))
        at = np.nonzero((opens | closes) & (quotes % 2 == 0))[0]
        kind = [chr(c) for c in data[at].tolist()]
        for m in _LIST.finditer(plain):
            place = np.searchsorted(at, m.start(1))
            if place < len(at) and at[place] == m.start(1):
                kind[place] = "F"
        return cls(at, np.where(opens[at], 1, -1), kind, bool((in_string + int((data == ord('"')).sum())) % 2))

    def change(self) -> Change:
        """Containers closed and left open, whatever stands before."""
        level = np.cumsum(self.step)
        before = level - self.step
        least = np.minimum.accumulate(np.minimum(before, level)) if len(level) else level
        low, end = (min(0, int(least[-1])), int(level[-1])) if len(level) else (0, 0)
        # the last opening to a depth is still open
        begins = [int(np.nonzero((level == depth) & (self.step > 0))[0][-1]) for depth in range(low + 1, end + 1)]
        pushes = [self.kind[i] for i in begins]
        listed = set()
        for i in (i for i, k in enumerate(self.kind) if k == "F"):
            depth = int(before[i])
            if depth > low and depth <= end and begins[depth - low - 1] < i:
                pushes[depth - low - 1] = "C"
            elif depth <= 0 and least[i] >= depth:
                listed.add(depth)
        return Change(-low, "".join(pushes), self.in_string, tuple(sorted(listed)))


def _inside(stack: str) -> bool:
    """The next character belongs to a feature: an element of a list, or an outermost object."""
    return bool(stack) and (stack[0] == "{" or (stack[0] == "F" and len(stack) > 1) or (stack[:2] == "CF" and len(stack) > 2))


def _depth(stack: str) -> int:
    """Open containers around the feature in which ``stack`` is."""
    return 0 if stack[0] == "{" else 1 if stack[0] == "F" else 2


class Scan:
    """Features of one byte range, block by block, from the state at its start."""

    def __init__(self, stack: str, in_string: bool):
        self.stack, self.in_string = stack, in_string
        self.cut = _inside(stack)  # the feature at hand began before this range
        self.held: list[bytes] = []

    def block(self, text: bytes) -> Iterator[tuple[bool, bytes | None]]:
        """(begins here, text) of the features that end in the block; odd text between them is an empty one.

        A text of None takes back what was cut at the border: it was no feature.
        """
        found = Structure.of(text, self.in_string)
        level = len(self.stack) + np.cumsum(found.step)
        before = level - found.step
        near = np.arange(len(level))
        if len(level) and level.min() >= 0:  # else closing brackets without opening ones, which are skipped one by one
            near = np.nonzero(np.minimum(before, level) <= _FEATURE_DEPTH)[0]
        start = 0
        for i in near.tolist():
            at, kind = int(found.at[i]), found.kind[i]
            stack = self.stack[: before[i]] if len(near) < len(level) else self.stack
            if kind in "{[F":
                if not _inside(stack):
                    yield from self._between(text[start:at], stack)
                    start = at
                elif stack == "{" and kind == "F":  # not a feature: an object with a list of them
                    if self.cut:
                        yield False, None
                    self.held, self.cut = [], False
                self.stack = _marked(stack + kind)
                if not _inside(self.stack):
                    start = at + 1
            elif stack:
                self.stack = stack[:-1]
                if not _inside(stack):
                    yield from self._between(text[start:at], stack)
                    start = at + 1
                elif not _inside(self.stack):
                    self.held.append(text[start : at + 1])
                    yield not self.cut, b"".join(self.held)
                    self.held, self.cut, start = [], False, at + 1
            else:
                start = at + 1
        if len(near) < len(level):
            self.stack = self.stack[: level[-1]].ljust(int(level[-1]), "[")
        if _inside(self.stack):
            self.held.append(text[start:])
        else:
            yield from self._between(text[start:], self.stack)
        self.in_string = found.in_string

    def _between(self, text: bytes, stack: str) -> Iterator[tuple[bool, bytes]]:
        """Text between features: only blanks and commas belong there; members of a collection are skipped."""
        if stack in ("", "F", "CF") and text.strip(_BLANK):
            yield True, b""

    def rest(self) -> bytes | None:
        return b"".join(self.held) if _inside(self.stack) else None


# --- Spark side ----------------------------------------------------------------------------


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, size, value): text up to each closing brace, in file order inside a task."""
    return (
        spark.read.option("lineSep", "}")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("_metadata.file_size").alias("size"),
            "value",
        )
    )


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, bytes]]:
    """Blocks of text of a byte range; a block does not go beyond its range."""
    for batch in batches:
        blocks = batch.column("block").to_pylist()
        files = batch.column("file").to_pylist()
        values = batch.column("value").cast(pa.binary()).to_pylist()
        start = held = 0
        for i in range(len(values) + 1):
            ends = i == len(values) or (i > start and (blocks[i], files[i]) != (blocks[start], files[start]))
            if i > start and (ends or held > BLOCK_BYTES):
                yield {k: batch.column(k)[start].as_py() for k in batch.schema.names if k != "value"}, b"}".join(values[start:i]) + b"}"
                start, held = i, 0
            if i < len(values):
                held += len(values[i])


_CHANGES = "file string, block long, size long, bytes long, pops0 long, pushes0 string, ends0 boolean, listed0 array<long>, pops1 long, pushes1 string, ends1 boolean, listed1 array<long>"


def _changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """State changes of the ranges, for a start outside (0) and inside (1) of a string."""
    row, both = None, None

    def out() -> pa.RecordBatch:
        values = {**row}
        for s, change in enumerate(both):
            values |= {f"pops{s}": change.pops, f"pushes{s}": change.pushes, f"ends{s}": change.in_string, f"listed{s}": list(change.listed)}
        return pa.RecordBatch.from_pylist([values], schema=_CHANGE_SCHEMA)

    for at, text in _ranges(batches):
        if row is None or (row["file"], row["block"]) != (at["file"], at["block"]):
            if row is not None:
                yield out()
            row, both = {**at, "bytes": 0}, [Change(in_string=False), Change(in_string=True)]
        row["bytes"] += len(text)
        both = [c.then(Structure.of(text, c.in_string).change()) for c in both]
    if row is not None:
        yield out()


_CHANGE_SCHEMA = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("size", pa.int64()), ("bytes", pa.int64())]
    + [(f"{n}{s}", t) for s in (0, 1) for n, t in (("pops", pa.int64()), ("pushes", pa.string()), ("ends", pa.bool_()), ("listed", pa.list_(pa.int64())))]
)
_STATE = "file string, block long, stack string, in_string boolean, owner long, spare boolean"


def _states(changes: pd.DataFrame) -> pd.DataFrame:
    """State at the start of each range of a file, and the range where the feature at hand began.

    ``spare`` marks the last range if the file does not end with the brace that its last piece was given.
    """
    changes = changes.sort_values("block")
    spare = int(changes["bytes"].sum()) == int(changes["size"].iloc[0]) + 1
    stack, in_string, owner, rows = "", False, -1, []
    for i, r in enumerate(changes.itertuples()):
        rows.append([r.file, r.block, stack, in_string, owner, spare and i == len(changes) - 1])
        s = int(in_string)
        pops, pushes, ends, listed = (getattr(r, f"{n}{s}") for n in ("pops", "pushes", "ends", "listed"))
        after = Change(int(pops), pushes, bool(ends), tuple(listed)).after(stack)
        same = _inside(stack) and _inside(after) and len(stack) - pops > _depth(stack) and _depth(stack) == _depth(after)
        owner = owner if same else int(r.block) if _inside(after) else -1
        stack, in_string = after, bool(ends)
    return pd.DataFrame(rows, columns=["file", "block", "stack", "in_string", "owner", "spare"])


_FOUND = "file string, owner long, block long, closed boolean, text string"
_FOUND_SCHEMA = pa.schema([("file", pa.string()), ("owner", pa.int64()), ("block", pa.int64()), ("closed", pa.bool_()), ("text", pa.string())])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole features (owner -1), and parts of those that a border cuts."""
    row, scan, last = None, None, b""

    def rows(found) -> pa.RecordBatch:
        data = []
        for begins, text in found:
            owner = -1 if begins else row["owner"]
            text = None if text is None else text.decode("utf-8", "replace")
            data.append((row["file"], owner, row["block"], True, text))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*data, strict=True) if data else [[]] * 5, _FOUND_SCHEMA, strict=True)], schema=_FOUND_SCHEMA)

    def end() -> Iterator[pa.RecordBatch]:
        # the last piece of a file was given a closing brace that may not stand there
        yield rows(scan.block(last[:-1] if row["spare"] else last))
        if (rest := scan.rest()) is not None:
            owner = row["owner"] if scan.cut else row["block"]
            yield pa.RecordBatch.from_pylist([{"file": row["file"], "owner": owner, "block": row["block"], "closed": False, "text": rest.decode("utf-8", "replace")}], schema=_FOUND_SCHEMA)

    for at, text in _ranges(batches):
        if row is None or (row["file"], row["block"]) != (at["file"], at["block"]):
            if row is not None:
                yield from end()
            if at["stack"] is None:
                raise RuntimeError(f"the byte ranges of {at['file']} were cut anew while it was read")
            row, scan, last = at, Scan(at["stack"], at["in_string"]), b""
        if last:
            yield rows(scan.block(last))
        last = text
    if row is not None:
        yield from end()


def feature_texts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(text) of every feature of GeoJSON files in any layout; null for one that is cut off.

    Collections, feature sequences, outermost lists and single features; indented, one to a line or all on one
    line. A file of any size is read by as many tasks as it has splits. Text that stands where only features may
    gives a null, objects that are no features come as they are. A broken string or bracket spoils what follows
    it in its file: files of separate lines are better read line by line.
    """
    ship_package(spark)
    pieces = _pieces(spark, path)
    changes = pieces.mapInArrow(_changes, _CHANGES)
    stored = new_dir(spark, "json-ranges")
    changes.groupBy("file").applyInPandas(_states, _STATE).write.parquet(stored)
    states = spark.read.schema(_STATE).parquet(stored)
    size = states.agg(F.sum(row_bytes(states))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        placed = pieces.join(F.broadcast(states), ["file", "block"], "left")
    else:
        numbered = pieces.withColumn("_seq", F.monotonically_increasing_id())
        placed = numbered.join(states, ["file", "block"], "left").repartition("file", "block").sortWithinPartitions("file", "block", "_seq").drop("_seq")
    found_dir = new_dir(spark, "json-features")
    placed.mapInArrow(_features, _FOUND).write.parquet(found_dir)
    found = spark.read.schema(_FOUND).parquet(found_dir)
    cut = found.where("owner >= 0").groupBy("file", "owner").agg(
        F.expr("array_join(transform(sort_array(collect_list(struct(block, text))), p -> p.text), '') AS text"),
        F.bool_or("closed").alias("closed"),
        F.bool_or(F.col("text").isNull()).alias("taken_back"),
    ).where("NOT taken_back")
    whole = found.where("owner < 0").select(F.expr("CASE WHEN text <> '' THEN text END").alias("text"))
    return whole.union(cut.select(F.expr("CASE WHEN closed THEN text END")))
