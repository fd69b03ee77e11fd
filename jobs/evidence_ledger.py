"""Job: sentences that show techniques, of documents as they arrive.

    spark-submit jobs/evidence_ledger.py --documents PATH --output PATH --checkpoint PATH [--config FILE]

A file stream over a folder of Parquet files of documents: each run takes the files that
are new since the last, by the checkpoint, and ends. Every whole text is cut into
sentences, those that show a technique go to OUTPUT/evidence, in partitions of batch and
technique; OUTPUT/documents lists the documents of each batch. A document that arrives
again takes the place of what it gave before: `current` reads the ledger so, and each run
ends with OUTPUT/summary, counts by technique over what is current, made anew.

A run that fails can be started again: a batch that was written but not marked as done
replaces its own partitions. A run without new files changes nothing.
"""

from __future__ import annotations

import argparse
import logging
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import StructField, StructType  # noqa: E402
from pyspark.sql.utils import AnalysisException  # noqa: E402

from jobs.common import config_of, session  # noqa: E402
from sievework.functions import lexicons as lex  # noqa: E402
from sievework.operators import mining  # noqa: E402
from sievework.streaming import incremental  # noqa: E402

CONFIG = "evidence_ledger.json"
log = logging.getLogger("evidence_ledger")


def _tables(output: str) -> tuple[str, str, str]:
    return f"{output}/evidence", f"{output}/documents", f"{output}/summary"


def _schemas(documents: StructType, config: dict) -> tuple[StructType, StructType]:
    """Of the ledger and of the list of documents; an output without rows is read by these."""
    own = StructType([documents[c] for c in (config["id"], *config.get("keep", []))])
    batch = StructType().add(incremental.BATCH, "long")
    return StructType([*own, StructField("statement", documents[config["text"]].dataType), *batch]).add("technique", "string"), StructType([*own, *batch])


def evidence_of(documents: DataFrame, config: dict) -> DataFrame:
    """(id, kept columns, technique, statement): distinct sentences that show a technique."""
    keys = [config["id"], *config.get("keep", [])]
    found = mining.technique_hits(documents, keys, config["text"], F.lit("text"), config.get("techniques", lex.TECHNIQUES))
    return found.select(*keys, "technique", "statement")


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:  # no batch yet
        return spark.createDataFrame([], schema)


def current(spark: SparkSession, output: str, schema: StructType, config: dict) -> DataFrame:
    """The ledger as it stands, of each document what its last batch gave. schema: of the documents."""
    rows, seen = _schemas(schema, config)
    evidence, documents, _ = _tables(output)
    return incremental.latest(_read(spark, evidence, rows), _read(spark, documents, seen), config["id"])


def run(spark: SparkSession, documents: str, output: str, checkpoint: str, config: dict) -> DataFrame:
    """Takes the documents that are new at a path into the ledger and returns it as it then stands."""
    schema = spark.read.parquet(documents).schema
    evidence, seen, summary = _tables(output)
    keys = [config["id"], *config.get("keep", [])]

    def made(batch: DataFrame) -> dict[str, DataFrame]:
        own = batch.where(F.col(config["id"]).isNotNull())
        return {evidence: evidence_of(own, config), seen: own.select(*keys).distinct()}

    query = incremental.write_new(spark, schema, documents, checkpoint, made, {evidence: ["technique"]}, config.get("files", 100))
    query.awaitTermination()
    took = sorted({p["batchId"] for p in query.recentProgress if p["numInputRows"]})
    new = _read(spark, seen, _schemas(schema, config)[1]).where(F.col(incremental.BATCH) >= took[0]).count() if took else 0
    log.info("read %s new documents in %s batches from %s", new, len(took), documents)
    rows = current(spark, output, schema, config)
    counts = rows.groupBy("technique").agg(F.countDistinct(config["id"]).alias("documents"), F.count("*").alias("statements"))
    counts.write.mode("overwrite").partitionBy("technique").parquet(summary)
    for r in spark.read.schema(counts.schema).parquet(summary).orderBy("technique").collect():  # one row a technique
        log.info("%s: %s documents, %s sentences in %s", r.technique, r.documents, r.statements, output)
    return rows


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    for name in ("documents", "output", "checkpoint"):
        args.add_argument(f"--{name}", required=True)
    args.add_argument("--config", help=f"settings; {CONFIG} beside this file if not given")
    given = args.parse_args()
    spark = session("evidence_ledger")
    try:
        run(spark, given.documents, given.output, given.checkpoint, config_of(given.config, CONFIG))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
