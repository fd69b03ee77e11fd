"""Pieces shared by the operators: stored intermediates, row keys, skew-safe joins, Arrow helpers."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import Stored, new_path, scratch, settled, shared_folder, store  # noqa: F401  the operators' own

#: Keys that get their own broadcast path in join_hot; bounds what is broadcast there.
HOT_KEYS = 256
#: A key below this many rows is never treated as hot.
HOT_ROWS = 1000


def release(spark: SparkSession) -> None:
    """Lets Spark remove shuffle files that nothing refers to any more.

    Spark does so when the driver collects garbage, which a driver that only plans
    rarely needs to; between the phases of an operator the files would pile up.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def row_key(*columns: str, seed: int | None = None) -> F.Column:
    """A 64-bit key of a row's values; equal rows share it. Another seed gives an independent key."""
    return F.xxhash64(*([] if seed is None else [F.lit(seed)]), *[F.col(c) for c in columns])


def unused(name: str, columns: list[str]) -> str:
    """A column name that is not among columns yet (names differ by more than case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def hot_threshold(sized: DataFrame, count: str) -> int:
    """The size from which at most HOT_KEYS keys are hot. One value per key in sized."""
    top = [r[0] for r in sized.select(count).orderBy(F.desc(count)).limit(HOT_KEYS).collect()]
    return max(HOT_ROWS, top[-1] + 1 if len(top) == HOT_KEYS else 0)


def join_hot(left: DataFrame, right: DataFrame, key: str, count: str, how: str = "left") -> DataFrame:
    """left joined with right (one row per key, count = its rows in left), whatever the skew.

    Keys over the threshold (HOT_KEYS of them at most) are joined by broadcast, where
    left's rows stay where they are; no other key holds more than one part in HOT_KEYS
    of the rows, so those go through an ordinary shuffle join.
    """
    least = hot_threshold(right, count)
    hot = F.broadcast(right.where(F.col(count) >= least))
    cold = right.where(F.col(count) < least)
    one = left.join(hot, key, "inner")
    rest = left.join(hot.select(key), key, "left_anti").join(cold, key, how)
    return one.unionByName(rest.select(*one.columns))


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(data, starts, ends) of a string or binary array without copying; nulls are empty."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=kind, count=len(column) + 1, offset=column.offset * kind().itemsize).astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    starts, ends = off[:-1], off[1:].copy()
    if column.null_count:
        gone = ~np.asarray(column.is_valid())
        ends[gone] = starts[gone]
    return raw, starts, ends


def trim() -> None:
    """Gives memory that a worker no longer uses back to the system; workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that a column holds about `most` bytes in each, one row at least."""
    try:
        yield from _slices(batches, column, most)
    finally:
        trim()


def _slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, starts, ends = bytes_of(batch.column(batch.schema.get_field_index(column)))
        total, begin = np.cumsum(ends - starts), 0
        while begin < len(batch):
            base = total[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(total, base + most, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def has_rows(frame: DataFrame) -> bool:
    return bool(frame.limit(1).count())


def bounded(frame: DataFrame, most: int) -> bool:
    """Whether a frame has at most `most` rows; counts no further."""
    return frame.limit(most + 1).count() <= most
