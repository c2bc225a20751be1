"""Frames that several operators need."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, functions as F

BATCH_BYTES = 4 << 20


def row_key(*columns: Column) -> Column:
    """64-bit key of a row from what decides its result; equal rows share it, nulls differ from empty texts."""
    marked = [part for c in columns for part in (c.isNull(), c)]
    return F.xxhash64(*marked)


def slices(batch: pa.RecordBatch, column: str, limit: int = BATCH_BYTES) -> Iterable[pa.RecordBatch]:
    """Cut an Arrow batch into runs of rows of about ``limit`` text bytes (one row at least)."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)


def bitmap_of(spots: DataFrame, bits: int) -> bytes:
    """Marks of the places ``spot`` (below 2**bits): 2**bits bits, however many rows."""
    word = F.shiftright("spot", 5).cast("int").alias("word")
    words = spots.groupBy(word).agg(F.expr("bit_or(shiftleft(1L, cast(spot & 31 as int)))").alias("marks")).toArrow()
    out = np.zeros(1 << (bits - 5), dtype=np.uint32)
    out[words.column("word").to_numpy()] = words.column("marks").to_numpy().astype(np.uint32)
    return out.tobytes()


def is_marked(bitmap: bytes, spots: np.ndarray) -> np.ndarray:
    held = np.frombuffer(bitmap, dtype=np.uint8)
    return ((held[spots >> 3] >> (spots & 7).astype(np.uint8)) & 1) == 1
