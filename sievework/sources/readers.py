"""Readers of sequence files, tables, candidates and gold standards.

Files are read by Spark's own readers wherever one fits, so any store that Spark knows
will do. Formats that need a library (PDF, images, Excel) take the parser as a function.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..storage import store
from ..streaming import incremental

#: Candidate records, as they are written and read.
CANDIDATE = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("id", "sequence", "original_sequence", "normalized_sequence", "source", "context", "sequence_line")]
    + [T.StructField(n, T.IntegerType()) for n in ("length", "score")]
    + [T.StructField(n, T.ArrayType(T.StringType())) for n in ("techniques", "technique_lines")]
    + [T.StructField("evidence_score", T.DoubleType())]
)

#: Items of parsed files that a task holds, beyond those of one file, before it hands them on.
ITEMS = 1_000

FASTA_ENDINGS = ("fa", "fasta", "fna")


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length, content) of the files of a folder, or of one file."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "length", "content")


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length) of the files of a folder; contents are not read."""
    return files(spark, path, pattern).select("path", "length")


def numbered(rows: DataFrame, order: str, name: str = "no") -> DataFrame:
    """rows with their number from 1 in the order of a column.

    Sorted rows know their place in their part; how many are in the parts before is a
    table of one row a part. They are stored first, since a sort may cut its parts
    otherwise when it runs again.
    """
    place = F.monotonically_increasing_id()  # part << 33 | place
    placed = store(rows.orderBy(order).withColumn("_place", place), "numbered")
    part, at = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    sizes = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))  # one row a part
    return placed.withColumn("_part", part).join(F.broadcast(sizes), "_part").withColumn(name, F.col("_before") + at + 1).drop("_part", "_place", "_before")


def with_ending(*endings: str) -> str:
    """A pattern of file names with any of these endings, in either case."""
    return "*.{" + ",".join("".join(f"[{c.lower()}{c.upper()}]" for c in e) for e in endings) + "}"


def ending(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def parsed(rows: DataFrame, parse: Callable[[bytes], list[tuple]], schema: str, keep: str = "path") -> DataFrame:
    """One row per item that parse makes of a file's content; a file that can't be parsed gives a row with its error.

    schema names parse's columns, e.g. `page int, text string` for the pages of a PDF or
    `page int, img_no int, image binary` for its images.
    """
    names = [c.strip().split(" ")[0] for c in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, content in zip(batch[keep], batch["content"], strict=True):
                try:
                    out += [(key, *item, None) for item in parse(bytes(content))]
                except Exception as e:  # one bad file is no reason to lose the others
                    out.append((key, *[None] * len(names), str(e)))
                if len(out) >= ITEMS:
                    yield pd.DataFrame(out, columns=[keep, *names, "error"])
                    out = []
            yield pd.DataFrame(out, columns=[keep, *names, "error"])

    return rows.select(keep, "content").mapInPandas(run, f"{keep} string, {schema}, error string")


def pdf_pages(rows: DataFrame, parse: Callable[[bytes], list[tuple]] | None = None) -> DataFrame:
    """(path, page, text, error) with pages from 1; the default parser needs PyMuPDF."""

    def default(content: bytes) -> list[tuple]:
        import fitz

        with fitz.open(stream=content, filetype="pdf") as pdf:
            return [(i, page.get_text()) for i, page in enumerate(pdf, 1)]

    return parsed(rows, parse or default, "page int, text string")


def pdf_images(rows: DataFrame, parse: Callable[[bytes], list[tuple]] | None = None) -> DataFrame:
    """(path, page, img_no, image, error); the default parser needs PyMuPDF."""

    def default(content: bytes) -> list[tuple]:
        import fitz

        with fitz.open(stream=content, filetype="pdf") as pdf:
            return [(i, k, pdf.extract_image(image[0])["image"]) for i, page in enumerate(pdf, 1) for k, image in enumerate(page.get_images(full=True), 1)]

    return parsed(rows, parse or default, "page int, img_no int, image binary")


def recognised(images: DataFrame, read: Callable[[bytes], str] | None = None) -> DataFrame:
    """images with text and error; the default reader needs Pillow and Tesseract."""

    def default(content: bytes) -> str:
        import io

        import pytesseract
        from PIL import Image, ImageOps

        image = ImageOps.autocontrast(ImageOps.grayscale(Image.open(io.BytesIO(content))))
        return pytesseract.image_to_string(image.resize((image.width * 3, image.height * 3)), config="--oem 3 --psm 6")

    one = read or default

    @F.pandas_udf("text string, error string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for content in batch:
                try:
                    out.append((one(bytes(content)), None))
                except Exception as e:
                    out.append((None, str(e)))
            yield pd.DataFrame(out, columns=["text", "error"])

    return images.withColumn("_ocr", run("image")).select("*", "_ocr.*").drop("_ocr", "image")


def not_done(rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """rows whose keys a stored result does not hold yet: only new files are read again."""
    return rows.join(done.select(*keys).distinct(), keys, "left_anti")


def cached(rows: DataFrame, keys: list[str], content: str, made: Callable[[DataFrame], DataFrame], path: str) -> DataFrame:
    """What made gives for rows, from a table of results at path wherever it holds one for the same keys and content.

    Results are kept by keys and the SHA-256 of the content (`digest`), so what changed is
    made again and what did not is not. made takes rows with digest and keeps both. New
    results are appended by one write of Spark's: they are there whole, or not at all
    where it fails. Rows of equal keys and content are made once.
    """
    spark = rows.sparkSession
    own = [*keys, "digest"]
    marked = rows.withColumn("digest", F.sha2(content, 256))
    new = marked.dropDuplicates(own)
    if incremental.exists(spark, path):
        new = new.join(spark.read.parquet(path).select(*own).distinct(), own, "left_anti")
    made(new).write.mode("append").parquet(path)
    return spark.read.parquet(path).join(marked.select(*own).distinct(), own, "left_semi")


def joined_pages(pages: DataFrame, keys: list[str], order: list[str], text: str = "text", name: str = "raw_text") -> DataFrame:
    """Parts of a document put together in order, a line break between."""
    parts = F.array_sort(F.collect_list(F.struct(*order, F.coalesce(text, F.lit("")).alias("_t"))))
    return pages.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda p: p["_t"]), "\n").alias(name))


# ------------------------------------------------------------------ sequence and table files


def texts(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, value) of whole text files; bytes that are no UTF-8 become U+FFFD."""
    return files(spark, path, pattern).select("path", F.make_valid_utf8(F.col("content").cast("string")).alias("value"))


def fasta(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, row, id, description, seq) of FASTA records, split on lines that begin with >."""
    return fasta_records(texts(spark, path, pattern), "value")


def fasta_records(rows: DataFrame, text: str) -> DataFrame:
    """rows, one for each record of a FASTA text, numbered in order; lines before the first header make a record without one."""
    each = rows.select("*", F.posexplode(F.split(F.concat(F.lit("\n"), F.col(text)), r"\R(?=>)")).alias("row", "_record"))
    own = X.lines(F.regexp_replace("_record", r"^\R", ""))
    headed = F.col("_record").rlike(r"^\R?>")
    head = F.when(headed, F.regexp_extract("_record", r"^\R?>([^\r\n]*)", 1)).otherwise(F.lit(""))
    body = F.when(headed, F.slice(own, 2, F.size(own))).otherwise(own)
    seq = F.upper(F.array_join(F.transform(body, X.strip), ""))
    out = each.select(*[c for c in rows.columns if c != text], "row", F.split(head, r"\s+")[0].alias("id"), head.alias("description"), F.regexp_replace(seq, r"\s+", "").alias("seq"))
    return out.where("seq <> ''")


def delimited(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """(cells, context) of the rows of one table in delimited files with a header; every value is text, empty ones stay ''."""
    raw = spark.read.csv(path, header=True, inferSchema=False, sep=separator, multiLine=True, escape='"')
    return as_cells(raw)


def as_cells(raw: DataFrame) -> DataFrame:
    values = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in raw.columns]
    return raw.select(F.array(*values).alias("cells"), F.concat_ws(" | ", *values).alias("context"))


_CELLS = "row int, cells array<string>, context string"


def _as_rows(tables: list[pd.DataFrame]) -> list[tuple]:
    rows = [[str(v) for v in row] for frame in tables for row in frame.fillna("").itertuples(index=False)]
    return [(i, row, " | ".join(row)) for i, row in enumerate(rows)]


def tables(rows: DataFrame, separator: str = ",") -> DataFrame:
    """(path, row, cells, context, error) of many delimited files (path, content), each with a header of its own."""

    def parse(content: bytes) -> list[tuple]:
        return _as_rows([pd.read_csv(io.BytesIO(content), sep=separator, dtype=str, keep_default_na=False)])

    return parsed(rows, parse, _CELLS)


def excel(rows: DataFrame) -> DataFrame:
    """(path, row, cells, context, error) of all sheets of workbooks (path, content); the old binary format needs a reader that pandas can use."""

    def parse(content: bytes) -> list[tuple]:
        if zipfile.is_zipfile(io.BytesIO(content)):
            sheets = workbook(content)
            return _as_rows([pd.DataFrame([[*r, *[""] * (max(map(len, rows_)) - len(r))] for r in rows_[1:]]) for rows_ in sheets if rows_])
        return _as_rows(list(pd.read_excel(io.BytesIO(content), sheet_name=None, dtype=str).values()))

    return parsed(rows, parse, _CELLS)


def workbook(content: bytes) -> list[list[list[str]]]:
    """Rows of text of each sheet of an Office Open XML workbook, in the workbook's order."""
    main = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    link = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        xml = lambda name: ElementTree.fromstring(z.read(name))
        said = lambda node: "".join(t.text or "" for t in node.iter(f"{main}t"))
        shared = [said(node) for node in xml("xl/sharedStrings.xml").iter(f"{main}si")] if "xl/sharedStrings.xml" in z.namelist() else []
        places = {r.get("Id"): r.get("Target").lstrip("/").removeprefix("xl/") for r in xml("xl/_rels/workbook.xml.rels")}
        out = []
        for sheet in xml("xl/workbook.xml").iter(f"{main}sheet"):
            rows = []
            for row in xml(f"xl/{places[sheet.get(link)]}").iter(f"{main}row"):
                cells: list[str] = []
                for cell in row.iter(f"{main}c"):
                    at, kind, value = cell.get("r"), cell.get("t"), cell.find(f"{main}v")
                    if at:  # cells that are left out are empty
                        letters = at.rstrip("0123456789")
                        k = 0
                        for c in letters:
                            k = 26 * k + ord(c) - 64
                        cells += [""] * (k - 1 - len(cells))
                    text = said(cell) if kind == "inlineStr" else "" if value is None else value.text or ""
                    cells.append(shared[int(text)] if kind == "s" and text else text)
                rows.append(cells)
            out.append([r for r in rows if any(r)])
    return out


def plain(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, text) of whole text files; bytes that are no UTF-8 are left out."""
    raw = files(spark, path, pattern).select("path", F.col("content").cast("string").alias("value"))
    # of bytes, not of characters: those that stood in the file are put by, what takes the place of bad bytes is cut
    mark, bad = F.lit("\ue000\ue001"), F.lit("\ufffd")
    cut = F.replace(F.make_valid_utf8(F.replace("value", bad, mark)), bad, F.lit(""))
    return raw.select("path", F.when(F.is_valid_utf8("value"), F.col("value")).otherwise(F.replace(cut, mark, bad)).alias("text"))


def unreadable(spark: SparkSession, path: str) -> DataFrame:
    """(path, source, error) of the table files of a folder that supplementary can't read."""
    kinds = {"csv": (tables, ["csv"], [","]), "tsv": (tables, ["tsv"], ["\t"]), "xlsx": (excel, ["xlsx", "xls"], [])}
    failed = [read(files(spark, path, with_ending(*endings)), *more).where("error is not null").select("path", F.lit(source).alias("source"), "error") for source, (read, endings, more) in kinds.items()]
    return failed[0].unionByName(failed[1]).unionByName(failed[2])


def supplementary(spark: SparkSession, path: str) -> DataFrame:
    """(path, source, id, row, cells, context, whole) of all files that can be read, by their ending; others give nothing (see unreadable).

    Each ending is one scan, however many files there are; row is the order in a file.
    """
    columns = ["path", "source", "id", "row", "cells", "context", "whole"]
    none, first = F.lit(None).cast("string").alias("id"), F.lit(0).alias("row")

    def rows(read: DataFrame, source: str) -> DataFrame:
        return read.where("error is null").select("path", F.lit(source).alias("source"), none, "row", "cells", "context", F.lit(False).alias("whole"))

    out = rows(tables(files(spark, path, with_ending("csv")), ","), "csv")
    out = out.unionByName(rows(tables(files(spark, path, with_ending("tsv")), "\t"), "tsv"))
    out = out.unionByName(rows(excel(files(spark, path, with_ending("xlsx", "xls"))), "xlsx"))
    records = fasta(spark, path, with_ending(*FASTA_ENDINGS)).select("path", F.lit("fasta").alias("source"), "id", "row", F.array("seq").alias("cells"), F.col("description").alias("context"), F.lit(True).alias("whole"))
    text = plain(spark, path, with_ending("txt")).select("path", F.lit("txt").alias("source"), none, first, F.array("text").alias("cells"), F.substring("text", 1, 500).alias("context"), F.lit(False).alias("whole"))
    return out.unionByName(records).unionByName(text).select(*columns)


# ------------------------------------------------------------------ records


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Candidate records from JSON arrays, with what older files lack filled in."""
    rows = spark.read.schema(CANDIDATE).option("multiLine", True).json(path)
    return rows.select(*[F.coalesce(c, F.array().cast("array<string>")).alias(c) if c in ("techniques", "technique_lines") else F.coalesce(c, F.lit(1.0)).alias(c) if c == "evidence_score" else F.coalesce(c, F.lit("")).alias(c) if c == "sequence_line" else F.col(c) for c in rows.columns])


def parsed_papers(spark: SparkSession, root: str, name: str = "sequence_candidates.json") -> DataFrame:
    """(pmid, path) of the folders under root that hold a candidate file."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", name).load(root)
    return found.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("pmid"), "path")


def gold_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("pmid string, sequence string").option("multiLine", True).json(path)


def gold_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, ln, line) of a text file in order."""
    return texts(spark, path).select("path", F.posexplode(X.lines(F.col("value"))).alias("ln", "line"))


def verified_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"')


def reference_contexts(spark: SparkSession, path: str, otherwise: str = "peptide synthesized and analyzed") -> DataFrame:
    """(context): validation statements; where no record has one, the sequences' sources."""
    rows = spark.read.schema("validation_statement string, sequence_source string").option("multiLine", True).json(path)
    given = rows.where("validation_statement is not null and validation_statement <> ''").select(F.col("validation_statement").alias("context"))
    any_ = rows.agg(F.max(F.when(F.col("validation_statement") != "", 1)).alias("has"))
    fallback = rows.crossJoin(F.broadcast(any_)).where("has is null").select(F.coalesce("sequence_source", F.lit(otherwise)).alias("context"))  # one row
    return given.unionByName(fallback).distinct()
