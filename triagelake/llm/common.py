"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of the contracts, as a regex class body.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also inside higher-order functions."""
    return F.element_at(F.transform(F.array(value), body), 1)


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 6_000_000) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a piece holds about ``limit`` bytes of text (one row at least); nulls become ''."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        text = pc.fill_null(batch.column(at).cast(pa.string()), "")
        batch = batch.set_column(at, pa.field(column, pa.string()), text)
        ends = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def utf8(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """The bytes of a string column without nulls, and its len + 1 offsets into them."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    held = data.slice(offsets[0], offsets[-1] - offsets[0]).to_pybytes() if data is not None and len(column) else b""
    return held, offsets - offsets[0]


def strings(data: bytes, offsets: np.ndarray) -> pa.StringArray:
    """A string column over bytes that are already valid UTF-8."""
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))


def concat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, ..., start + length - 1 of every range, one after the other."""
    lengths = lengths.astype(np.int64)
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts.astype(np.int64) - before, lengths)
