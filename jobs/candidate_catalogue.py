"""Job: the candidate sequences of all documents, with what speaks for each.

    spark-submit jobs/candidate_catalogue.py --documents PATH --references PATH --output PATH [--config FILE]

Reads documents and a reference collection (Parquet), mines every whole text for candidate
sequences, scores each with its context and techniques, names the document's species,
ranks the candidates of a document, and tells which of them the collection knows. Writes
Parquet in partitions of a column of the documents.

A run replaces the partitions it has made when all of them are written, so a run that
fails leaves the last result, and one that runs again gives the same. `only` limits a run
to some partitions; `skip_done` leaves partitions alone that the output holds already.
Partitions of which the documents have nothing any more are not touched.
"""

from __future__ import annotations

import argparse
import logging
import string
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.utils import AnalysisException  # noqa: E402

from jobs.common import config_of, session  # noqa: E402
from sievework.functions import lexicons as lex  # noqa: E402
from sievework.operators import merging, mining  # noqa: E402

CONFIG = "candidate_catalogue.json"
log = logging.getLogger("candidate_catalogue")


def _done(spark: SparkSession, output: str, by: str) -> list:
    """Values of the partitions that the output holds; few, since each is a folder."""
    try:
        return [r[0] for r in spark.read.parquet(output).select(by).distinct().collect()]
    except AnalysisException:  # nothing there yet
        return []


def known_sequences(references: DataFrame, text: str) -> DataFrame:
    """(sequence, known) of the words of a reference collection that can be sequences, in either case of A to Z."""
    words = F.regexp_extract_all(F.translate(text, string.ascii_lowercase, string.ascii_uppercase), F.lit(f"[{lex.AA}]{{{lex.MIN_LENGTH},}}"), F.lit(0))
    return references.select(F.explode(words).alias("sequence")).distinct().withColumn("known", F.lit(True))


def catalogue(documents: DataFrame, references: DataFrame, config: dict) -> DataFrame:
    """The candidates of documents, ranked, with species and whether the references know them. Ids are unique; rows without a text have none."""
    key, by = config["id"], config["partition"]
    species = F.array_sort(mining.technique_names(F.col(config["text"]), config.get("species", lex.SPECIES)))
    rows = documents.select(key, by, F.col(config["text"]).alias("text"), species.alias("species"))
    found = mining.mine(
        rows, key, "text", rebuild=config.get("rebuild", True), least=config.get("least", 3), techniques=config.get("techniques", lex.TECHNIQUES), supersedes=config.get("supersedes", lex.SUPERSEDES), keywords=config.get("keywords"), keep=(by, "species")
    )
    found = found.withColumn("evidence_score", mining.evidence_score(F.col("techniques"), config.get("weights", lex.EVIDENCE_WEIGHTS)))
    ranked = merging.ranked(found.drop("normalized_sequence"), [key], "start")
    return ranked.join(known_sequences(references, config.get("reference_text", "text")), "sequence", "left").withColumn("known", F.coalesce("known", F.lit(False)))


def run(spark: SparkSession, documents: str, references: str, output: str, config: dict) -> DataFrame:
    """Makes the catalogue of the documents at a path and returns it as it then stands at the output path."""
    by = config["partition"]
    rows = spark.read.parquet(documents)
    if config.get("only"):
        rows = rows.where(F.col(by).isin(*config["only"]))
    if config.get("skip_done") and (done := _done(spark, output, by)):
        rows = rows.where(~F.coalesce(F.col(by).isin(*[d for d in done if d is not None]), F.lit(False)))
        rows = rows.where(F.col(by).isNotNull()) if None in done else rows
        log.info("left alone: partitions %s", sorted(map(str, done)))
    log.info("read %s documents from %s", rows.count(), documents)
    made = catalogue(rows, spark.read.parquet(references), config)
    # rows of a partition meet in few tasks, so that a partition has few files; AQE splits large ones
    made.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(output)
    stands = spark.read.schema(made.schema).parquet(output)
    for r in stands.groupBy(by).agg(F.count("*").alias("rows"), F.count(F.when(F.col("known"), 1)).alias("known")).orderBy(by).collect():  # one row a folder
        log.info("%s/%s=%s holds %s candidates, %s of them known", output, by, r[by], r["rows"], r["known"])
    return stands


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    for name in ("documents", "references", "output"):
        args.add_argument(f"--{name}", required=True)
    args.add_argument("--config", help=f"settings; {CONFIG} beside this file if not given")
    given = args.parse_args()
    spark = session("candidate_catalogue")
    try:
        run(spark, given.documents, given.references, given.output, config_of(given.config, CONFIG))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
