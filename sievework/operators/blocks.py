"""Work on blocks of rows against blocks of references: packed, brought together by number, multiplied in numpy.

Every query has to meet every reference, so blocks meet blocks; what a task holds is one of
each. Left blocks are repeated for each right block, right ones for each share of the left,
and an equi-join on both numbers brings them together: work grows with the product, as the
question has it, and is dealt evenly, whatever the rows are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import store

#: Rows of a packed block; left blocks that share a copy of the right ones.
ROWS, SHARE = 1024, 32


def matrix_of(column: pa.Array, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(vectors of finite numbers as rows of a matrix, which rows have none): nulls, other lengths and what isn't finite give zeros."""
    sizes = np.asarray(column.value_lengths().fill_null(0))
    given = sizes[sizes > 0]
    width = width if width is not None else int(np.bincount(given).argmax()) if len(given) else 0
    out, none = np.zeros((len(column), width)), sizes != width
    if width and not none.all():
        flat = column.filter(pa.array(~none)).flatten().cast(pa.float64())
        out[~none] = np.asarray(flat.fill_null(np.nan)).reshape(-1, width)
    bad = ~np.isfinite(out).all(axis=1)
    out[bad] = 0
    return out, none | bad


def units(matrix: np.ndarray) -> np.ndarray:
    """Rows of length one; zeros stay zeros."""
    norm = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return np.divide(matrix, norm, out=np.zeros_like(matrix), where=norm > 0)


def _packed(keys: pa.Array, vectors: pa.Array, size: int) -> Iterator[tuple[pa.Array, int, bytes]]:
    """(keys, width, matrix) of up to `size` unit vectors of one width each."""
    lengths = np.asarray(vectors.value_lengths().fill_null(0))
    for width in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == width)
        for at in range(0, len(own), size):
            take = pa.array(own[at : at + size])
            yield keys.take(take), width, units(matrix_of(vectors.take(take), width)[0]).tobytes()


def packed_rows(rows: DataFrame, key: str, vector: str, size: int = ROWS) -> DataFrame:
    """(block, keys, width, matrix) of rows where they are. Stored: blocks keep their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, width, matrix in _packed(batch.column(0), batch.column(1), size):
                listed = pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys)
                yield pa.RecordBatch.from_arrays([listed, pa.array([width], pa.int32()), pa.array([matrix], pa.binary())], names=["keys", "width", "matrix"])

    kind = rows.schema[key].dataType.simpleString()
    blocks = rows.select(key, vector).mapInArrow(run, f"keys array<{kind}>, width int, matrix binary")
    return store(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks")


def packed_references(refs: DataFrame, vector: str, numbers: int) -> DataFrame:
    """(number, width, matrix) of references dealt over so many blocks by their hash. Stored."""

    def run(table: pa.Table) -> pa.Table:
        number, vectors = table.column(0).combine_chunks(), table.column(1).combine_chunks()
        made = [(width, matrix) for _, width, matrix in _packed(number, vectors, len(number))]
        return pa.table({"number": pa.array([number[0].as_py()] * len(made), pa.int32()), "width": pa.array([w for w, _ in made], pa.int32()), "matrix": pa.array([m for _, m in made], pa.binary())})

    dealt = refs.select(F.pmod(F.xxhash64(vector), F.lit(numbers)).cast("int").alias("number"), vector)
    return store(dealt.groupBy("number").applyInArrow(run, "number int, width int, matrix binary"), "references")


def meet(left: DataFrame, right: DataFrame, numbers: int, share: int = SHARE) -> DataFrame:
    """Each row of left (block, ...) beside each of right (number below `numbers`, ...); rows are blocks, of many rows each."""
    shares = max(1, -(-left.count() // share))
    every = left.withColumn("_share", F.pmod(F.xxhash64("block"), F.lit(shares)).cast("int")).withColumn("number", F.explode(F.sequence(F.lit(0), F.lit(numbers - 1))))
    copies = right.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    return every.join(copies, ["number", "_share"])
