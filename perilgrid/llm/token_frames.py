"""Token-id files: independent zstandard frames, a document index and a trailing seek table.

Layout of a file, in the published seekable zstandard format:

- frames, each compressing FRAME_BYTES of the id stream on its own;
- a skippable frame with the document index: id width, count, then doc_ids, nulls and token counts;
- a skippable frame with the seek table: compressed size, decompressed size and checksum of each
  frame (low 32 bits of XXH64), closed by the frame count, a descriptor and the magic number.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer

from perilgrid.llm.arrow import text_slices
from perilgrid.llm.shipping import ship_package
from perilgrid.llm.tokens import encoder

FRAME_BYTES = 1 << 18
LEVEL = 3
# Fixed values of the zstandard formats.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
_FOOTER = struct.Struct("<IBI")
_ENTRY = struct.Struct("<III")
_HEAD = struct.Struct("<II")


def _checksum(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class FrameWriter:
    """Writes one file to an open binary stream."""

    def __init__(self, stream, width: int):
        self._stream, self._type, self._width = stream, f"<u{width}", width
        self._compress = zstandard.ZstdCompressor(level=LEVEL).compress
        self._held = bytearray()
        self._frames: list[tuple[int, int, int]] = []
        self._docs: list[tuple[int | None, int]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """Append a document, given as little-endian unsigned 32-bit ids."""
        values = np.frombuffer(ids, "<u4")
        if len(values) and int(values.max()) >> (8 * self._width):
            raise ValueError(f"id {values.max()} does not fit {self._width} bytes")
        self._docs.append((doc_id, len(values)))
        self._held += values.astype(self._type).tobytes()
        while len(self._held) >= FRAME_BYTES:
            self._flush(FRAME_BYTES)

    def _flush(self, size: int) -> None:
        data = bytes(self._held[:size])
        del self._held[:size]
        frame = self._compress(data)
        self._stream.write(frame)
        self._frames.append((len(frame), len(data), _checksum(data)))

    def close(self) -> tuple[int, int]:
        """Write index and seek table; returns the counts of documents and tokens."""
        if self._held:
            self._flush(len(self._held))
        ids = np.array([d if d is not None else 0 for d, _ in self._docs], "<i8")
        nulls = np.array([d is None for d, _ in self._docs], "u1")
        counts = np.array([n for _, n in self._docs], "<i8")
        index = struct.pack("<BQ", self._width, len(ids)) + ids.tobytes() + nulls.tobytes() + counts.tobytes()
        table = b"".join(_ENTRY.pack(*f) for f in self._frames)
        table += _FOOTER.pack(len(self._frames), CHECKSUM_FLAG, SEEK_MAGIC)
        self._stream.write(_HEAD.pack(SKIPPABLE_INDEX, len(index)) + index)
        self._stream.write(_HEAD.pack(SKIPPABLE_SEEK, len(table)) + table)
        return len(ids), int(counts.sum())


class FrameReader:
    """Reads one file from a seekable binary stream; frames are decompressed one at a time."""

    def __init__(self, stream, size: int):
        self._stream = stream
        stream.seek(size - _FOOTER.size)
        n_frames, flags, magic = _FOOTER.unpack(stream.read(_FOOTER.size))
        if magic != SEEK_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError("not a token file with a checked seek table")
        table_size = n_frames * _ENTRY.size + _FOOTER.size
        stream.seek(size - table_size)
        entries = [_ENTRY.unpack(stream.read(_ENTRY.size)) for _ in range(n_frames)]
        self.packed = np.array([e[0] for e in entries], np.int64)
        self.plain = np.array([e[1] for e in entries], np.int64)
        self._sums = [e[2] for e in entries]
        self._packed_at = np.concatenate([[0], np.cumsum(self.packed)])
        self._plain_at = np.concatenate([[0], np.cumsum(self.plain)])
        stream.seek(int(self._packed_at[-1]))
        kind, length = _HEAD.unpack(stream.read(_HEAD.size))
        if kind != SKIPPABLE_INDEX:
            raise ValueError("the document index is missing")
        index = stream.read(length)
        self.width, count = struct.unpack_from("<BQ", index)
        at = struct.calcsize("<BQ")
        ids = np.frombuffer(index, "<i8", count, at)
        nulls = np.frombuffer(index, "u1", count, at + 8 * count)
        self.counts = np.frombuffer(index, "<i8", count, at + 9 * count)
        self.doc_ids = [None if n else int(d) for d, n in zip(ids, nulls, strict=True)]
        self._starts = np.concatenate([[0], np.cumsum(self.counts)]) * self.width
        self._last: tuple[int, bytes] = (-1, b"")

    def _frame(self, k: int) -> bytes:
        if self._last[0] != k:
            self._stream.seek(int(self._packed_at[k]))
            data = zstandard.ZstdDecompressor().decompress(
                self._stream.read(int(self.packed[k])), max_output_size=int(self.plain[k])
            )
            if _checksum(data) != self._sums[k]:
                raise ValueError(f"frame {k} does not match its checksum")
            self._last = (k, data)
        return self._last[1]

    def document(self, position: int) -> np.ndarray:
        """Token ids of a document by its place in the file; only its frames are decompressed."""
        begin, end = int(self._starts[position]), int(self._starts[position + 1])
        parts = []
        k = int(np.searchsorted(self._plain_at, begin, "right")) - 1
        while begin < end:
            base = int(self._plain_at[k])
            stop = min(end, int(self._plain_at[k + 1]))
            parts.append(self._frame(k)[begin - base : stop - base])
            begin, k = stop, k + 1
        return np.frombuffer(b"".join(parts), f"<u{self.width}").astype("<u4")


def id_width(tokenizer: str, end_id: int = 0) -> int:
    """Bytes that hold every id of a tokenizer and the end id: two or four."""
    ids = Tokenizer.from_file(tokenizer).get_vocab(with_added_tokens=True).values()
    return 2 if max(end_id, *ids, 0) < 1 << 16 else 4


def write_token_files(
    docs: DataFrame, tokenizer: str, out_dir: str, end_id: int = 0, width: int | None = None
) -> DataFrame:
    """Encode ``docs`` in ascending doc_id order; one row (part, path, n_docs, n_tokens) per file.

    Documents are dealt out by ranges of doc_id (nulls first) and sorted inside, so the files in
    order of ``part`` hold all of them in order; rows of equal id are ordered by text. Each task
    streams into a file of a name of its own, and only finished tasks report one, so a task that
    runs again leaves an unlisted file at worst. ``width`` is the bytes of an id in the file, by
    default as many as the tokenizer's vocabulary needs; an id that does not fit is an error.
    """
    ship_package(docs.sparkSession)
    width = id_width(tokenizer, end_id) if width is None else width
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        system, base = fs.FileSystem.from_uri(out_dir)
        path = f"{base}/tokens-{part:06d}-{uuid.uuid4().hex}.zst"
        encode = encoder(tokenizer).encode
        writer = stream = None
        for batch in text_slices(batches):
            if writer is None:
                system.create_dir(base, recursive=True)
                stream = system.open_output_stream(path, compression=None)
                writer = FrameWriter(stream, width)
            texts = batch.column("text").to_pylist()
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                writer.add(doc_id, encode(text) + end if text else end)
        if writer is not None:
            n_docs, n_tokens = writer.close()
            stream.close()
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "path": [path], "n_docs": [n_docs], "n_tokens": [n_tokens]}
            )

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(run, "part long, path string, n_docs long, n_tokens long")


def read_token_files(spark: SparkSession, files: DataFrame, out_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files.

    ``files`` is what ``write_token_files`` returned, written and read again. Its one row per file
    is collected to give each file the number of ids before it; the ids stay in the tasks.
    """
    found = sorted((tuple(r) for r in files.collect()), key=lambda r: r[0])
    before = np.concatenate([[0], np.cumsum([r[3] for r in found])]).astype(int).tolist()
    rows = [(path, base) for (_, path, _, _), base in zip(found, before, strict=False)]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not rows:
        return spark.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(out_dir)
        for batch in batches:
            for path, base in zip(*(batch.column(c).to_pylist() for c in ("path", "base")), strict=True):
                size = system.get_file_info(path).size
                with system.open_input_file(path) as stream:
                    reader = FrameReader(stream, size)
                    starts = base + np.concatenate([[0], np.cumsum(reader.counts)[:-1]]).astype(np.int64)
                    sums = [zlib.crc32(reader.document(i).tobytes()) for i in range(len(reader.doc_ids))]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(reader.doc_ids, pa.int64()),
                            pa.array(starts),
                            pa.array(reader.counts),
                            pa.array(sums, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    listed = spark.createDataFrame(rows, "path string, base long").repartition(len(rows))
    return listed.mapInArrow(run, schema)


def token_files(docs: DataFrame, tokenizer: str, out_dir: str, end_id: int = 0) -> DataFrame:
    """Write ``docs`` as token files below ``out_dir`` and read every document back.

    A null or empty text is the end id alone; null doc_ids come first and stay null; repeated rows
    keep a place each; an empty table gives no file and no rows; other columns are ignored.
    Memory of a task: one document, one frame, and the index of its file.
    """
    spark = docs.sparkSession
    listing = f"{out_dir}/listing"
    write_token_files(docs, tokenizer, f"{out_dir}/files", end_id).write.parquet(listing)
    return read_token_files(spark, spark.read.parquet(listing), f"{out_dir}/files")
