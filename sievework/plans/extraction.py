"""The whole way from pages and files to verified sequences, as one lazy plan.

Documents are keyed by path: two papers that name the same PMID stay apart, and the
PMID is an attribute. `save(frame, name)` writes a stage and reads it back; it is called
before and after what is costly to repeat.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicons as lex
from ..functions import text as T
from ..operators import evaluation, merging, mining, scoring, verification
from ..sources import readers, writers
from ..streaming import incremental

Save = Callable[[DataFrame, str], DataFrame]


def documents(pages: DataFrame, ocr: DataFrame | None = None) -> DataFrame:
    """(path, pmid, raw_text, text, ocr_text) of pages (path, page, text) and OCR parts (path, page, img_no, text).

    text is raw_text with line-end hyphens joined, without back matter, and with
    numbered sequence lines put together; OCR text is put together alike.
    """
    raw = readers.joined_pages(pages, ["path"], ["page"])
    stem = readers.stem(F.col("path"))
    docs = raw.select("path", T.pmid(F.col("raw_text"), stem).alias("pmid"), "raw_text")
    if ocr is not None:
        docs = docs.join(readers.joined_pages(ocr, ["path"], ["page", "img_no"], name="ocr_text"), "path", "left")
    else:
        docs = docs.withColumn("ocr_text", F.lit(None).cast("string"))
    clean = docs.select("path", T.before_back_matter(T.join_hyphens(F.col("raw_text"))).alias("text"), F.col("ocr_text").alias("ocr"))
    return docs.drop("ocr_text").join(clean, "path").withColumnRenamed("ocr", "ocr_text")


def numbered(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text) with numbered sequence lines merged and numbered blocks joined."""
    rows = docs.where(F.col(text).isNotNull()).select(key, F.posexplode(T.lines(F.col(text))).alias("ln", "line"))
    merged = T.merge_numbered_lines(rows, [key])
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ln", "line"))), lambda p: p["line"]), "\n")
    return merged.groupBy(key).agg(whole.alias("_t")).select(key, T.join_numbered(F.col("_t")).alias(text))


def technique_table(docs: DataFrame) -> DataFrame:
    """(path, technique, statement, source): sentences that show techniques, those of the text before those of OCR."""
    text = mining.technique_hits(docs, ["path"], "text", F.lit("pdf_text"))
    ocr = mining.technique_hits(docs.where("ocr_text is not null"), ["path"], "ocr_text", F.lit("ocr"))
    return mining.first_per_technique(text.unionByName(ocr), ["path"], ["pdf_text", "ocr"])


def union(*lists: DataFrame) -> DataFrame:
    """Candidate lists one after the other, with their number."""
    out = None
    for i, rows in enumerate(lists):
        part = rows.withColumn("list", F.lit(i))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def candidates(docs: DataFrame) -> DataFrame:
    """Merged candidates of a document's text, OCR text and tables."""
    text, ocr = numbered(docs, "path", "text"), numbered(docs, "path", "ocr_text")
    bad = mining.abbreviation_words(text, "path", "text")
    lists = union(mining.mine(text, "path", "text", "pdf_text", bad), mining.mine(ocr, "path", "ocr_text", "ocr", bad), mining.mine_tables(text, "path", "text", "pdf_text", bad))
    return merging.merge_candidates(lists, ["path", "sequence"], ["list", "start"]).drop("list")


def supplementary(files: DataFrame, docs: DataFrame) -> DataFrame:
    """Distinct candidates of files (path, source, id, row, cells, context, whole) whose names begin with a document's PMID; of equal sequences the first in the order of file, row and cell."""
    named = files.select(F.col("path").alias("file"), "source", "id", "row", "cells", "context", "whole", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"))
    own = merging.join_by_prefix(named, docs.select("path", "pmid").distinct(), "name", "pmid")
    keys = ["path", "file", "row", "id"]
    found = [mining.mine_cells(own.where(F.col("whole") == w), keys, F.col("cells"), F.col("context"), F.col("source"), whole=w) for w in (True, False)]
    return merging.first_of(found[0].unionByName(found[1]), ["path", "sequence"], ["file", "row", "start"]).drop("file", "row")


def with_supplementary(main: DataFrame, extra: DataFrame) -> DataFrame:
    return merging.merge_candidates(union(main, extra), ["path", "sequence"], ["list", "start"]).drop("list")


def prepare(pages: DataFrame, ocr: DataFrame | None, files: DataFrame | None, save: Save) -> dict[str, DataFrame]:
    """The stage tables: documents, techniques, candidates, supplementary, merged."""
    docs = save(documents(pages, ocr), "documents")
    main = save(candidates(docs), "candidates")
    out = {"documents": docs, "techniques": technique_table(docs), "candidates": main, "merged": main}
    if files is not None:
        out["supplementary"] = save(supplementary(files, docs), "supplementary")
        out["merged"] = with_supplementary(main, out["supplementary"])
    out["evidence"] = mining.evidence(out["merged"], ["path"])
    out["chunks"] = mining.chunks(main, ["path"])
    return out


def run(
    stages: dict[str, DataFrame], references: DataFrame, model: Callable[[], verification.Model], save: Save, encoder: Callable[[], scoring.Encoder] | None = None, contexts: list[str] = lex.REFERENCE_CONTEXTS, gold: DataFrame | None = None, graded: bool = False, journal: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(result with the 13 columns, audit log) of prepared stages and reference sequences (seq).

    Without an encoder contexts have no score, which passes. gold: (pmid, sequence).
    """
    docs, found = stages["documents"], stages["merged"]
    spark = found.sparkSession
    scores = scoring.sequence_scores(found.select(F.col("sequence").alias("seq")), references).select(F.col("seq").alias("sequence"), "sequence_score")
    found = found.join(docs.select("path", "pmid"), "path").join(scores, "sequence", "left").withColumn("id", F.concat_ws(":", "path", "sequence"))
    if encoder is None:
        found = found.withColumn("bio_score", F.lit(None).cast("double"))
    else:
        refs = save(scoring.encode(spark.createDataFrame([(c,) for c in contexts], "t string"), "t", encoder), "references")
        own = save(scoring.encode(found.select("context").distinct(), "context", encoder), "contexts")
        found = found.join(scoring.context_scores(own, "context", refs), "context", "left")
    found = save(found, "scored")
    species = F.array_sort(mining.technique_names(F.col("raw_text"), lex.SPECIES)).alias("species")
    extracted = docs.select("path", species, F.substring("raw_text", 1, 4000).alias("head"))
    verified, log = verification.verify(found, extracted, model, save, key="path", graded=graded, journal=journal)
    marked = verification.with_synthesized(verified)
    matched = evaluation.gold_match(marked, gold if gold is not None else spark.createDataFrame([], "pmid string, sequence string"))
    return writers.result_columns(matched), log


def run_folders(
    spark: SparkSession, papers: str, output: str, supplementary_files: str | None = None, parse: Callable[[bytes], list[tuple]] | None = None, images: Callable[[bytes], list[tuple]] | None = None, read: Callable[[bytes], str] | None = None, ocr: bool = True, references: str | None = None,
    model: Callable[[], verification.Model] | None = None, encoder: Callable[[], scoring.Encoder] | None = None, gold: str | None = None, graded: bool = False, ending: str = "pdf",
) -> dict[str, DataFrame]:
    """From a folder of papers and one of supplementary files to all outputs, each a table below `output`.

    pages (with what could not be read), ocr, documents, techniques, candidates,
    supplementary and unreadable, merged, evidence, chunks, metadata; with a model and reference
    sequences (FASTA) also result (and result_csv for people) and audit; with a gold
    standard (JSON) also metrics and report. parse, images and read take the place of the
    parsers that need libraries; ocr=False leaves images alone. A table that is there
    whole is read and not made again, so a run that failed goes on where it ended; images
    are known by their content, and a journal keeps the model's answers.
    """
    out: dict[str, DataFrame] = {}

    def kept(name: str, build: Callable[[], DataFrame]) -> DataFrame:
        path = f"{output}/{name}"
        if not incremental.exists(spark, path):
            writers.table(build(), path, by=None)
        out[name] = spark.read.parquet(path)
        return out[name]

    def save(frame: DataFrame, name: str) -> DataFrame:
        return kept(name, lambda: frame)

    files = readers.files(spark, papers, readers.with_ending(ending))
    pages = kept("pages", lambda: readers.pdf_pages(files, parse))
    read_pages = pages.where("error is null").drop("error")
    texts = None
    if ocr:
        found = kept("images", lambda: readers.pdf_images(files, images))
        texts = readers.cached(found.where("error is null").drop("error"), ["path", "page", "img_no"], "image", lambda rows: readers.recognised(rows, read), f"{output}/ocr")
        out["ocr"] = texts
        texts = texts.where("error is null").select("path", "page", "img_no", "text")
    docs = kept("documents", lambda: documents(read_pages, texts))
    kept("techniques", lambda: technique_table(docs))
    main = kept("candidates", lambda: candidates(docs))
    merged = main
    if supplementary_files is not None:
        kept("unreadable", lambda: readers.unreadable(spark, supplementary_files))
        extra = kept("supplementary", lambda: supplementary(readers.supplementary(spark, supplementary_files), docs))
        merged = kept("merged", lambda: with_supplementary(main, extra))
    kept("evidence", lambda: mining.evidence(merged, ["path"]))
    kept("chunks", lambda: mining.chunks(main, ["path"]))
    none = spark.createDataFrame([], "path string")
    kept("metadata", lambda: writers.metadata(read_pages, out["images"].where("error is null") if ocr else none, out["supplementary"] if supplementary_files is not None else none, "path"))
    if model is None or references is None:
        return out

    def verified() -> tuple[DataFrame, DataFrame]:
        known = readers.gold_json(spark, gold) if gold is not None else None
        stages = {"documents": docs, "merged": merged}
        return run(stages, readers.fasta(spark, references).select("seq"), model, save, encoder, gold=None if known is None else evaluation.gold_pairs(known), graded=graded, journal=f"{output}/journal")

    made = verified()
    result = kept("result", lambda: made[0])
    kept("audit", lambda: made[1])
    writers.csv(result, f"{output}/result_csv", one_file=True)
    if gold is not None:
        pairs = evaluation.gold_pairs(result, "PMID", "Sequence")
        counts = kept("metrics", lambda: evaluation.confusion(pairs, evaluation.gold_pairs(readers.gold_json(spark, gold))))
        writers.metrics(counts, f"{output}/metrics_csv")
        writers.text(evaluation.report(evaluation.micro(counts)), f"{output}/report")
    return out
