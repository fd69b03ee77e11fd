"""Gapless numbering of rows within keys, without one task per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import unused


def rank_within(rows: DataFrame, key: str, order: list[Column], spread: Column, buckets: int | Column, rank: str = "rank") -> DataFrame:
    """rows with a number from 0 within each key, gapless, the same on every run.

    A key's rows are dealt into `buckets` (a number, or a column that the key decides) by a
    hash of `spread`, which should differ from row to row: rows equal in it share a bucket.
    Bucket totals give each bucket's first number and rows are counted on from there, in
    `order`. So a key with a third of all rows is numbered by `buckets` tasks. The totals,
    at most keys x buckets rows, are shuffled by key only after they are summed.
    """
    bucket, n, base, at = (unused(name, rows.columns) for name in ("_bucket", "_n", "_base", "_at"))
    dealt = rows.withColumn(bucket, F.pmod(F.xxhash64(spread), buckets if isinstance(buckets, Column) else F.lit(buckets)).cast("int"))
    totals = dealt.groupBy(key, bucket).agg(F.count("*").alias(n))
    before = Window.partitionBy(key).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    first = totals.select(key, bucket, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(base))
    within = Window.partitionBy(key, bucket).orderBy(*order)
    numbered = dealt.withColumn(at, F.row_number().over(within) - 1)
    return numbered.join(first, [key, bucket]).withColumn(rank, F.col(base) + F.col(at)).drop(bucket, base, at)
