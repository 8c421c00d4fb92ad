"""Words of UTF-8 texts as byte offsets, computed over numpy arrays inside Spark tasks.

A word is a run of bytes other than space and the five ASCII controls 9 to 13, which is what
``[^\\x20\\x09-\\x0D]+`` matches in characters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Text that a Python worker turns into objects at a time, whatever the size of Spark's Arrow batches.
BATCH_BYTES = 4 << 20


def utf8(column: str | Column) -> Column:
    """A text column as bytes; a null text reads as the empty one."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column, F.lit("")).cast("binary")


def spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words of one text."""
    raw = np.frombuffer(data, dtype=np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = np.empty(len(raw) + 2, dtype=np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = ~_SPACE[raw]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def over_texts(
    docs: DataFrame, schema: str, of_batch: Callable[[dict[str, list], list[bytes]], dict[str, object]]
) -> DataFrame:
    """Apply ``of_batch`` to the other columns and the texts (column ``_text``, binary) of every batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = None
        for batch in batches:
            for part in slices(batch, "_text"):
                given = {name: part.column(name) for name in part.schema.names if name != "_text"}
                found = of_batch(given, part.column("_text").to_pylist())
                target = target or arrow_schema(schema)
                yield pa.RecordBatch.from_arrays(
                    [x if isinstance(x, pa.Array) else pa.array(x, type=f.type) for x, f in zip(found.values(), target)],
                    schema=target,
                )

    return docs.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a slice holds at most BATCH_BYTES of text, or a single row."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
    start = 0
    while start < len(sizes):
        stop = start + max(1, int(np.searchsorted(np.cumsum(sizes[start:]), BATCH_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def values(column: pa.Array) -> Iterator:
    """The values of a text or binary column one by one, few of them in memory at a time."""
    for part in slices(pa.record_batch([column], names=["_text"]), "_text"):
        yield from part.column(0).to_pylist()


_TYPES = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
}


def arrow_type(name: str) -> pa.DataType:
    if name.startswith("array<"):
        return pa.list_(arrow_type(name[6:-1]))
    return _TYPES[name]


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow form of a flat ``name type, ...`` schema."""
    return pa.schema([(name, arrow_type(kind)) for name, kind in (x.strip().split(" ", 1) for x in ddl.split(","))])
