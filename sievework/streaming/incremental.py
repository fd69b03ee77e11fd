"""Mining documents as they arrive: a file stream, a batch at a time, no state between."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

#: The partition column that tells which batch rows came with.
BATCH = "batch"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark can read Parquet files at a path."""
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException:
        return False


def _pattern(path: str) -> str:
    """A path as a pattern that fits it alone: file streams take a folder or a pattern, and so a single file as well."""
    path = path.rstrip("/")
    return path if re.search(r"[*?\[{]", path) else f"{path[:-1]}[{path[-1]}]"


def write_new(spark: SparkSession, schema: str | StructType, source: str, checkpoint: str, made: Callable[[DataFrame], dict[str, DataFrame]], by: dict[str, list[str]] | None = None, files: int = 100) -> StreamingQuery:
    """Starts turning Parquet files that appear under source into tables, by the paths that made names.

    Each table is written in partitions of the batch and of the columns that `by` has for
    its path. A batch that runs again, after a failure between its writes and the
    checkpoint's, replaces its own partitions, so what a document gave is there once. The
    query ends when all files that were there are read.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(_pattern(source))

    def write(batch: DataFrame, number: int) -> None:
        for path, table in made(batch).items():
            own = table.withColumn(BATCH, F.lit(number).cast("long"))
            own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH, *(by or {}).get(path, [])).parquet(path)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def mine_new(spark: SparkSession, schema: str | StructType, source: str, target: str, checkpoint: str, mine: Callable[[DataFrame], DataFrame], files: int = 100) -> StreamingQuery:
    """Starts mining Parquet files that appear under source; each batch is written to target under its number (see write_new)."""
    return write_new(spark, schema, source, checkpoint, lambda batch: {target: mine(batch)}, files=files)


def latest(rows: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """rows that the last batch with their document gave; documents (key, batch) lists the documents of each batch, those without rows too."""
    last = documents.groupBy(key).agg(F.max(BATCH).alias(BATCH))
    return rows.join(last, [key, BATCH], "left_semi")
