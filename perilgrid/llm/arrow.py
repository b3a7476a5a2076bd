"""Helpers for Arrow batches inside ``mapInArrow`` tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from perilgrid.llm.shipping import ship_package

# Rows a task holds as Python objects at once: a slice ends when it reaches either bound.
SLICE_ROWS = 512
SLICE_BYTES = 4 << 20


def text_slices(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut record batches into slices of bounded text size; one longer row is a slice of its own."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            size = size or 0
            if i > start and (i - start >= SLICE_ROWS or held + size > SLICE_BYTES):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def map_texts(df: DataFrame, schema: str, rows: Callable[..., dict]) -> DataFrame:
    """Apply ``rows(**columns) -> columns`` to slices of a DataFrame that has a ``text`` column.

    ``rows`` gets each column as a list, null texts as empty strings, and returns a dict of
    equally long columns.
    """

    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = None
        for part in text_slices(batches):
            columns = {name: part.column(name).to_pylist() for name in part.schema.names}
            columns["text"] = [t if t is not None else "" for t in columns["text"]]
            out = rows(**columns)
            types = types or _arrow_schema(schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[f.name], type=f.type) for f in types], schema=types
            )

    return df.mapInArrow(run, schema)


_TYPES = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "boolean": pa.bool_(),
    "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()),
    "array<string>": pa.list_(pa.string()),
}


def _arrow_schema(spec: str) -> pa.Schema:
    return pa.schema([(name, _TYPES[kind]) for name, kind in (f.split() for f in spec.split(", "))])
