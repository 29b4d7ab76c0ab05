"""Small helpers for functions that run over Arrow batches inside tasks."""

from __future__ import annotations

from typing import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a piece holds about ``limit`` bytes of ``column``, one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    first, held = 0, 0
    for row, length in enumerate(lengths):
        if held and held + length > limit:
            yield batch.slice(first, row - first)
            first, held = row, 0
        held += length
    if first < batch.num_rows:
        yield batch.slice(first)


def lists_of(parts: Sequence[bytes], kind: pa.DataType) -> pa.ListArray:
    """A list column from one little-endian value buffer per row."""
    width = kind.bit_width // 8
    offsets, at = [0], 0
    for part in parts:
        at += len(part) // width
        offsets.append(at)
    values = pa.Array.from_buffers(kind, at, [None, pa.py_buffer(b"".join(parts))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def keep_rows(df: DataFrame, text: str, decide: Callable[[Sequence[str | None]], Sequence[bool]], limit: int = SLICE_BYTES) -> DataFrame:
    """Whole rows for which ``decide``, given their texts, says True; columns and repeated rows stay."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, limit):
                yield part.filter(pa.array(decide(part.column(text).to_pylist()), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def fold_of(column: str, folds: int) -> Column:
    """crc32 of the column's text, modulo ``folds``; NULL for NULL."""
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(folds))


def packed(columns: Sequence[str]) -> Column:
    """The columns as one struct, so that no working column can clash with them."""
    return F.struct(*columns) if columns else F.struct(F.lit(None).alias("none"))


def unpacked(struct: str, columns: Sequence[str]) -> list[Column]:
    return [F.col(struct).getField(c).alias(c) for c in columns]


def fresh(df: DataFrame, wanted: str) -> str:
    """A name like ``wanted`` that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
