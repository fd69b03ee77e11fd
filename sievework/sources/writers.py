"""Writers of results: Parquet tables for stages, CSV, JSON and text for people."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Result column, and the verified column it shows.
RESULT = {
    "PMID": "pmid",
    "Sequence": "sequence",
    "Sequence_Evidence_Line": "sequence_line",
    "Sequence_LLM_Confidence": "sequence_confidence",
    "Techniques": "verified_techniques",
    "Technique_Scores": "technique_scores",
    "Technique_Evidence_Lines": "technique_evidence_lines",
    "Species": "verified_species",
    "Species_LLM_Confidence": "species_confidence",
    "Species_Evidence_Line": "species_evidence_line",
    "Is_Synthesized": "is_synthesized",
    "Gold_Standard_Match": "gold_match",
    "Comments": "reason",
}


def table(rows: DataFrame, path: str, by: str | None = None, mode: str = "overwrite") -> None:
    """A stage table: page texts, OCR text, techniques, candidates, evidence, metadata.

    by: a column of few values, a folder each. What has a value for every paper is no
    such column: files and folders would grow with the papers.
    """
    writer = rows.write.mode(mode)
    (writer.partitionBy(by) if by else writer).parquet(path)


def json(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    rows.write.mode(mode).json(path)


def log(rows: DataFrame, path: str) -> None:
    """Appends audit records; prompt_id tells records of one prompt."""
    rows.write.mode("append").json(path)


def result_columns(rows: DataFrame) -> DataFrame:
    """The 13 columns of the result: arrays as JSON, no nulls in text, gold match blank where unknown."""
    kinds = dict(rows.dtypes)
    out = []
    for shown, own in RESULT.items():
        c = F.col(own)
        if kinds[own].startswith("array"):
            c = F.to_json(c)
        elif own == "gold_match":
            c = F.coalesce(F.initcap(c.cast("string")), F.lit(""))
        elif kinds[own] == "string":
            c = F.coalesce(c, F.lit(""))
        out.append(c.alias(shown))
    return rows.select(*out)


def csv(table: DataFrame, path: str, one_file: bool = False, rows: int = 0) -> None:
    """CSV with a header; one_file is for results that people open. rows: the most that a file has, 0 for any number."""
    (table.coalesce(1) if one_file else table).write.mode("overwrite").option("maxRecordsPerFile", rows).option("escape", '"').option("emptyValue", "").csv(path, header=True)


def metrics(counts: DataFrame, path: str) -> None:
    """Counts by document (pmid, tp, fp, fn) as one CSV in order of document."""
    shown = counts.select(F.col("pmid").alias("PMID"), F.col("tp").alias("TP"), F.col("fp").alias("FP"), F.col("fn").alias("FN"))
    csv(shown.repartition(1).sortWithinPartitions("PMID"), path)


def text(rows: DataFrame, path: str) -> None:
    rows.select("value").coalesce(1).write.mode("overwrite").text(path)


def metadata(pages: DataFrame, images: DataFrame, supplementary: DataFrame, key: str = "pmid") -> DataFrame:
    """(key, page_count, image_count, supplementary_count) of every document with pages."""
    counted = lambda rows, name: rows.groupBy(key).agg(F.count("*").alias(name))
    out = counted(pages, "page_count").join(counted(images, "image_count"), key, "left").join(counted(supplementary, "supplementary_count"), key, "left")
    return out.fillna(0, ["image_count", "supplementary_count"])


def charts(totals: DataFrame, by_document: DataFrame, folder: str, most: int = 20) -> list[str]:
    """Bar charts of the totals and, for up to `most` documents, of each; needs matplotlib. Returns the files made."""
    import matplotlib

    matplotlib.use("Agg")
    import matplotlib.pyplot as plt

    made = []
    row = totals.first()
    figure, axis = plt.subplots()
    axis.bar(["Precision", "Recall", "F1"], [row["precision"], row["recall"], row["f1"]])
    axis.set_ylim(0, 1)
    made.append(f"{folder}/metrics.png")
    figure.savefig(made[-1])
    few = by_document.orderBy("pmid").limit(most + 1).toPandas()
    if 0 < len(few) <= most:
        axis = few.set_index("pmid")[["tp", "fp", "fn"]].plot.bar()
        made.append(f"{folder}/metrics_by_pmid.png")
        axis.figure.savefig(made[-1])
    return made
