"""Queries that go through files: tables are written with the writers, read with the readers.

Files stand in the shared folder; what they hold comes from the driver's tables, so SQL
over these says what must come back.
"""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import evaluation, merging, mining
from ..sources import readers, writers
from ..storage import new_path
from ..streaming import incremental
from . import evaluating, extraction
from . import mining as plans
from . import registry as R
from .registry import FOLD, TOKEN, UP, folded, query, table, upper

#: Cells that a CSV file must quote or leave empty.
_PARTS = "SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS a, p_name || ', ' || p_brand AS b, CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size % 3 = 1 THEN 'say \"' || p_type || '\"' ELSE 'NA' END AS c FROM part"
_CELLS_SQL = f"SELECT CAST(a AS INT) AS p_partkey, a || ' | ' || b || ' | ' || c AS context, CAST(3 AS BIGINT) AS n FROM ({_PARTS})"


#: Rows of a table file that is parsed whole.
_FILE_ROWS = 10_000


def _parts(spark, sf_dir):
    size = F.col("p_size") % 3
    c = F.when(size == 0, F.lit("")).when(size == 1, F.concat(F.lit('say "'), F.col("p_type"), F.lit('"'))).otherwise(F.lit("NA"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("a"), F.concat("p_name", F.lit(", "), "p_brand").alias("b"), c.alias("c"))


def _shown(cells):
    return cells.select(F.col("cells")[0].cast("int").alias("p_partkey"), "context", F.size("cells").cast("long").alias("n"))


@query("csv_cells", _CELLS_SQL)
def csv_cells(spark, sf_dir):
    path = new_path(spark, "csv")
    writers.csv(_parts(spark, sf_dir), path)
    return _shown(readers.delimited(spark, path))


@query("csv_tables", _CELLS_SQL)
def csv_tables(spark, sf_dir):
    """The same by one scan of many files, each with its own header."""
    path = new_path(spark, "csv")
    writers.csv(_parts(spark, sf_dir).repartition(3, "a"), path, rows=_FILE_ROWS)
    return _shown(readers.tables(readers.files(spark, path, readers.with_ending("csv"))).where("error is null"))


@query("tsv_cells", _CELLS_SQL)
def tsv_cells(spark, sf_dir):
    path = new_path(spark, "tsv")
    _parts(spark, sf_dir).write.option("escape", '"').option("emptyValue", "").csv(path, header=True, sep="\t")
    return _shown(readers.delimited(spark, path, "\t"))


def _workbook(rows: list[list[str]]) -> bytes:
    """A workbook of two sheets, each with half of the rows below a header: shared strings, numbers, inline text, cells left out."""
    out, shared = io.BytesIO(), sorted({r[1] for r in rows})

    def sheet(part: list[list[str]]) -> str:
        lines = ['<row r="1"><c r="A1" t="inlineStr"><is><t>a</t></is></c><c r="B1" t="inlineStr"><is><t>b</t></is></c><c r="C1" t="inlineStr"><is><t>c</t></is></c></row>']
        for i, (a, b, c) in enumerate(part, 2):
            last = f'<c r="C{i}" t="inlineStr"><is><r><t>{escape(c[:2])}</t></r><r><t xml:space="preserve">{escape(c[2:])}</t></r></is></c>' if c else ""
            lines.append(f'<row r="{i}"><c r="A{i}"><v>{a}</v></c><c r="B{i}" t="s"><v>{shared.index(b)}</v></c>{last}</row>')
        return f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{"".join(lines)}</sheetData></worksheet>'

    half = len(rows) // 2
    kind = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="{kind}"><sheets><sheet name="one" sheetId="1" r:id="rId1"/><sheet name="two" sheetId="2" r:id="rId2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Target="/xl/worksheets/sheet2.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">' + "".join(f"<si><t>{escape(s)}</t></si>" for s in shared) + "</sst>")
        z.writestr("xl/worksheets/sheet1.xml", sheet(rows[:half]))
        z.writestr("xl/worksheets/sheet2.xml", sheet(rows[half:]))
    return out.getvalue()


@query("xlsx_cells", _CELLS_SQL)
def xlsx_cells(spark, sf_dir):
    def book(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"path": [f"{group.k.iloc[0]}.xlsx"], "content": [_workbook(group[["a", "b", "c"]].values.tolist())]})

    parts = _parts(spark, sf_dir).withColumn("k", F.floor(F.col("a").cast("long") / 100))  # as many books as there are hundreds of rows
    books = parts.groupBy("k").applyInPandas(book, "path string, content binary")
    return _shown(readers.excel(books).where("error is null"))


# ------------------------------------------------------------------ text files


def _lines_of(spark, rows, key: str, value: str):
    """A folder with a text file for each key, below key=...; the path tells the key."""
    path = new_path(spark, "text")
    rows.select(key, value).write.partitionBy(key).text(path)
    return path


_KEY = r"item_id=(\d+)"


@query("txt_files", "SELECT item_id, md5(text || chr(10)) AS digest FROM benchmark")
def txt_files(spark, sf_dir):
    path = _lines_of(spark, table(spark, sf_dir, "benchmark"), "item_id", "text")
    return readers.plain(spark, f"{path}/*").select(F.regexp_extract("path", _KEY, 1).cast("long").alias("item_id"), F.md5("text").alias("digest"))


@query("fasta_files", f"SELECT item_id, 'id' || item_id AS id, 'id' || item_id || ' of > benchmark' AS description, regexp_replace({UP}, '\\s+', '', 'g') AS seq FROM benchmark")
def fasta_files(spark, sf_dir):
    rows = table(spark, sf_dir, "benchmark").select("item_id", F.concat(F.lit(">id"), "item_id", F.lit(" of > benchmark\n"), T.fold(F.col("text"))).alias("t"))
    path = _lines_of(spark, rows, "item_id", "t")
    return readers.fasta(spark, f"{path}/*").select(F.regexp_extract("path", _KEY, 1).cast("long").alias("item_id"), "id", "description", "seq")


@query(
    "supp_dispatch",
    f"""WITH p AS ({_PARTS}), b AS (SELECT item_id, {FOLD} AS t FROM benchmark)
    SELECT 'csv' AS source, CAST(NULL AS VARCHAR) AS id, a || ' | ' || b || ' | ' || c AS context FROM p UNION ALL
    SELECT 'tsv', NULL, a || ' | ' || b || ' | ' || c FROM p UNION ALL
    SELECT 'txt', NULL, substring(t || chr(10), 1, 500) FROM b UNION ALL
    SELECT 'fasta', 'id' || item_id, 'id' || item_id || ' x' FROM b""",
)
def supp_dispatch(spark, sf_dir):
    """A folder of every kind of file, and of kinds that give nothing, read by ending."""
    root = new_path(spark, "supp")
    parts = _parts(spark, sf_dir)
    # files are parsed whole: more rows are more files, not larger ones
    writers.csv(parts.repartition(2), f"{root}/a", rows=_FILE_ROWS)
    parts.repartition(2).write.option("maxRecordsPerFile", _FILE_ROWS).option("escape", '"').option("emptyValue", "").option("extension", "tsv").csv(f"{root}/b", header=True, sep="\t")
    items = table(spark, sf_dir, "benchmark").select("item_id", T.fold(F.col("text")).alias("t"))
    items.write.partitionBy("item_id").text(f"{root}/c")
    records = items.select(F.explode(F.split(F.concat(F.lit(">id"), "item_id", F.lit(" x\n"), "t"), "\n")).alias("line"))
    _raw_lines(records, f"{root}/d", "FNA")
    items.write.json(f"{root}/e")
    return readers.supplementary(spark, f"{root}/{{a,b,d,e,c/*}}").select("source", "id", "context")


def _raw_lines(lines, path: str, ending: str) -> None:
    """Lines as they are, in files with an ending of three letters."""
    lines.write.option("extension", ending).option("quote", "").option("escapeQuotes", False).option("emptyValue", "").option("ignoreTrailingWhiteSpace", False).option("ignoreLeadingWhiteSpace", False).csv(path, sep="\x01")


# ------------------------------------------------------------------ records


def _json_files(spark, rows, key: str, record) -> str:
    """A folder below key=... for each key, with a file that holds the key's records as one JSON array."""
    path = new_path(spark, "json")
    each = rows.groupBy(key).agg(F.to_json(F.collect_list(record)).alias("value"))  # keys have few records
    each.write.partitionBy(key).text(path)
    return path


@query(
    "candidate_json",
    "SELECT CAST(item_id // 4 AS VARCHAR) AS pmid, 'S' || item_id AS sequence, CASE WHEN item_id % 2 = 0 THEN 4.0 ELSE 1.0 END::DOUBLE AS evidence_score, CASE WHEN item_id % 2 = 0 THEN 'T|U' ELSE '' END AS techniques, CASE WHEN item_id % 2 = 0 THEN 'l' ELSE '' END AS sequence_line FROM benchmark",
)
def candidate_json(spark, sf_dir):
    """Folders of papers with candidate files, older records without some fields; other folders are left alone."""
    new = lambda c: F.when(F.col("item_id") % 2 == 0, c)
    record = F.struct(F.concat(F.lit("S"), "item_id").alias("sequence"), F.lit(3).alias("score"), new(F.array(F.lit("T"), F.lit("U"))).alias("techniques"), new(F.array().cast("array<string>")).alias("technique_lines"), new(F.lit(4.0)).alias("evidence_score"), new(F.lit("l")).alias("sequence_line"))
    rows = table(spark, sf_dir, "benchmark").withColumn("paper", F.floor(F.col("item_id") / 4))
    root = _json_files(spark, rows, "paper", record)
    rows.limit(1).select("text").write.json(f"{root}/other=1")
    papers = readers.parsed_papers(spark, root, "*.txt")
    found = readers.candidates(spark, f"{root}/*/*.txt").withColumn("path", F.input_file_name())
    named = found.withColumn("folder", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)).join(papers.select(F.col("pmid").alias("folder")), "folder")
    return named.select(F.regexp_extract("folder", r"(\d+)$", 1).alias("pmid"), "sequence", "evidence_score", F.array_join("techniques", "|").alias("techniques"), "sequence_line")


@query("gold_json", "SELECT DISTINCT CAST(item_id % 5 AS VARCHAR) AS pmid, regexp_replace(upper('ac-' || (item_id % 4) || 'dEf' || chr(65 + CAST(item_id % 7 AS INT))), '[^A-Z]', '', 'g') AS sequence FROM benchmark WHERE item_id % 6 <> 0")
def gold_json(spark, sf_dir):
    """A gold standard in several files; pairs without a document or a sequence are left out."""
    i = F.col("item_id")
    named = (i % 6 != 0) | (i % 12 == 0)
    made = F.concat(F.lit("ac-"), (i % 4).cast("string"), F.lit("dEf"), F.char(65 + i % 7))
    record = F.struct(F.when(named, (i % 5).cast("string")).otherwise("").alias("pmid"), F.when(~named, "ACD").when(i % 12 == 0, "").otherwise(made).alias("sequence"))
    rows = table(spark, sf_dir, "benchmark").withColumn("part", F.floor(i / 50))
    return evaluation.gold_pairs(readers.gold_json(spark, _json_files(spark, rows, "part", record) + "/*"))


@query("reference_contexts", "SELECT DISTINCT CASE WHEN item_id % 2 = 0 THEN text ELSE 'same' END AS context FROM benchmark WHERE item_id % 3 <> 0")
def reference_contexts(spark, sf_dir):
    """Validation statements of several files, those of equal text once; records without one give nothing."""
    i = F.col("item_id")
    record = F.struct(F.when(i % 3 == 0, "no").alias("sequence_source"), F.when(i % 3 != 0, F.when(i % 2 == 0, F.col("text")).otherwise("same")).alias("validation_statement"))
    rows = table(spark, sf_dir, "benchmark").withColumn("part", F.floor(i / 50))
    return readers.reference_contexts(spark, _json_files(spark, rows, "part", record) + "/*")


@query("verified_csv", "SELECT CAST(p_partkey AS VARCHAR) AS \"PMID\", p_type AS \"Sequence\", '[\"' || p_brand || '\"]' AS \"Techniques\", CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size % 3 = 1 THEN 'True' ELSE 'False' END AS \"Gold_Standard_Match\", 'a \"b\", ' || p_name AS \"Comments\" FROM part")
def verified_csv(spark, sf_dir):
    path = new_path(spark, "verified")
    rows = evaluating.result_rows(table(spark, sf_dir, "part")).withColumn("reason", F.concat(F.lit('a "b", '), "p_name"))
    writers.csv(writers.result_columns(rows), path, one_file=True)
    back = readers.verified_csv(spark, path)
    return back.select("PMID", "Sequence", "Techniques", F.coalesce("Gold_Standard_Match", F.lit("")).alias("Gold_Standard_Match"), "Comments")


# ------------------------------------------------------------------ pages, images, stages


def _papers(spark, sf_dir):
    """(path, content): a conversation as a file whose pages are parted by form feeds."""
    turns = F.array_sort(F.collect_list(F.struct("turn", "text")))
    pages = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(turns, lambda t: t["text"]), "\f").alias("t"))
    return pages.select(F.concat(F.lit("p/"), "conv_id", F.lit(".pdf")).alias("path"), F.col("t").cast("binary").alias("content"))


def _split(content: bytes) -> list[tuple]:
    if b"\x0c" not in content:
        raise ValueError("one page only")
    return [(i, p) for i, p in enumerate(content.decode().split("\x0c"), 1)]


PAGES_SQL = "pages AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS page, text, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations)"


@query("page_texts", f"WITH {PAGES_SQL} SELECT CAST(conv_id AS BIGINT) AS conv_id, CASE WHEN n > 1 THEN CAST(page AS INT) END AS page, CASE WHEN n > 1 THEN md5(text) END AS digest, CASE WHEN n = 1 THEN 'one page only' END AS error FROM pages")
def page_texts(spark, sf_dir):
    """Files to pages through a parser, a file that fails keeps its error; stored by document and read back."""
    path = new_path(spark, "pages")
    pages = readers.pdf_pages(_papers(spark, sf_dir), _split)
    writers.table(pages.withColumn("pmid", F.pmod(readers.stem(F.col("path")).cast("long"), F.lit(5))), path, by="pmid")
    back = spark.read.parquet(path)
    return back.select(readers.stem(F.col("path")).cast("long").alias("conv_id"), "page", F.md5("text").alias("digest"), "error")


@query("paper_files", "SELECT row_number() OVER (ORDER BY 'paper=' || item_id) AS no, 'paper=' || item_id AS name, CAST(octet_length(encode(text)) + 1 AS BIGINT) AS length FROM benchmark")
def paper_files(spark, sf_dir):
    """Papers of a folder in order of name; other files are not listed."""
    root = new_path(spark, "papers")
    rows = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("paper"), "text")
    rows.write.partitionBy("paper").text(root)
    rows.write.mode("append").partitionBy("paper").json(root)
    listed = readers.listing(spark, f"{root}/*", readers.with_ending("txt")).withColumn("name", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1))
    return readers.numbered(listed.select("name", "length"), "name").select("no", "name", "length")


@query("ocr_texts", f"WITH {PAGES_SQL} SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(page AS INT) AS page, CASE WHEN page % 4 <> 0 THEN md5(upper({FOLD})) END AS digest, page % 4 = 0 AS failed FROM pages WHERE n > 1 AND page % 3 <> 1")
def ocr_texts(spark, sf_dir):
    """Images through a parser, their text through a reader that fails on some; what a stored result holds is not read again."""

    def images(content: bytes) -> list[tuple]:
        return [(i, 1, p.encode()) for i, p in _split(content)]

    def read(image: bytes) -> str:
        if image.startswith(b"bad "):
            raise ValueError("bad image")
        return image.decode().upper()

    found = readers.pdf_images(_papers(spark, sf_dir), images).where("error is null").drop("error")
    done = found.where("page % 3 = 1").select("path", "page", "img_no")
    folded_ = T.fold(F.col("image").cast("string"))
    new = readers.not_done(found, done, ["path", "page", "img_no"]).withColumn("image", F.when(F.col("page") % 4 == 0, F.concat(F.lit("bad "), folded_)).otherwise(folded_).cast("binary"))
    path = new_path(spark, "ocr")
    writers.table(readers.recognised(new, read), path, by=None)
    return spark.read.parquet(path).select(readers.stem(F.col("path")).cast("long").alias("conv_id"), "page", F.md5("text").alias("digest"), F.col("error").isNotNull().alias("failed"))


@query("ocr_cache", f"WITH {PAGES_SQL} SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(page AS INT) AS page, md5(CASE WHEN page % 3 = 0 THEN 'two ' || upper({FOLD}) || ' CHANGED' ELSE 'one ' || upper({FOLD}) END) AS digest FROM pages WHERE n > 1")
def ocr_cache(spark, sf_dir):
    """Images read twice, some of them changed between: exactly those are read again."""

    def images(content: bytes) -> list[tuple]:
        return [(i, 1, p.encode()) for i, p in _split(content)]

    def reader(said: str):
        return lambda rows: readers.recognised(rows, lambda image: f"{said} {image.decode().upper()}")

    found = readers.pdf_images(_papers(spark, sf_dir), images).where("error is null").drop("error")
    found = found.withColumn("image", T.fold(F.col("image").cast("string")).cast("binary"))
    changed = found.withColumn("image", F.when(F.col("page") % 3 == 0, F.concat("image", F.lit(" changed").cast("binary"))).otherwise(F.col("image")))
    path = new_path(spark, "ocr")
    for rows, said in ((found, "one"), (changed, "two")):
        out = readers.cached(rows, ["path", "page", "img_no"], "image", reader(said), path)
    return out.select(readers.stem(F.col("path")).cast("long").alias("conv_id"), "page", F.md5("text").alias("digest"))


@query("documents_stage", f"""WITH r AS (SELECT conv_id, string_agg({FOLD}, chr(10) ORDER BY turn) AS raw FROM conversations GROUP BY 1)
    SELECT conv_id, CAST(conv_id AS VARCHAR) AS pmid, md5(raw) AS raw, md5(array_to_string(CASE WHEN k > 0 THEN ls[1:k - 1] ELSE ls END, chr(10))) AS text, md5(raw) AS ocr
    FROM (SELECT *, list_position(list_transform(ls, lambda x: regexp_full_match(x, '(?i)\\s*(?:\\[?[0-9]+\\]?\\.?\\s*)?(?:References)[.:\\s]*')), TRUE) AS k
      FROM (SELECT conv_id, raw, {R.LINES.format("raw")} AS ls FROM r))""")
def documents_stage(spark, sf_dir):
    """The documents table of pages and OCR parts: numbers, raw, cleaned and OCR text."""
    pages = table(spark, sf_dir, "conversations").select(F.concat(F.lit("p/"), "conv_id", F.lit(".pdf")).alias("path"), F.col("turn").alias("page"), T.fold(F.col("text")).alias("text"))
    docs = extraction.documents(pages, pages.withColumn("img_no", F.lit(1)))
    path = new_path(spark, "documents")
    writers.table(docs, path, by=None)
    return spark.read.parquet(path).select(readers.stem(F.col("path")).cast("long").alias("conv_id"), "pmid", F.md5("raw_text").alias("raw"), F.md5("text").alias("text"), F.md5("ocr_text").alias("ocr"))


_HITS = f"SELECT DISTINCT doc_id, s AS statement, unnest({R.sql_technique('s', R.TECHNIQUES)}) AS technique FROM (SELECT doc_id, unnest({R.SENTENCES.format('{0}')}) AS s FROM documents)"


@query("technique_sources", f"WITH a AS ({_HITS.format(FOLD)}), b AS ({_HITS.format(f'substring({FOLD}, 200, 600)')}) SELECT doc_id, technique, statement, min(source) AS source FROM (SELECT *, 'pdf_text' AS source FROM a WHERE length(statement) % 3 > 0 UNION ALL SELECT *, 'zocr' FROM b) GROUP BY ALL")
def technique_sources(spark, sf_dir):
    """Techniques of a document's text and of another source, the text's first; stored and read back.

    The tables have no second source of a document, so a stretch of its text stands for one.
    """
    docs = folded(spark, sf_dir)
    text = mining.technique_hits(docs, ["doc_id"], "text", F.lit("pdf_text"), R.TECHNIQUES).where("length(statement) % 3 > 0")
    ocr = mining.technique_hits(docs.withColumn("text", F.substring("text", 200, 600)), ["doc_id"], "text", F.lit("zocr"), R.TECHNIQUES)
    path = new_path(spark, "techniques")
    writers.table(mining.first_per_technique(text.unionByName(ocr), ["doc_id"], ["pdf_text", "zocr"]), path, by=None)
    return spark.read.parquet(path).select("doc_id", "technique", "statement", "source")


@query(
    "candidate_lists",
    f"""WITH d AS (SELECT doc_id, unnest(regexp_extract_all({UP}, '{TOKEN}')) AS sequence FROM documents)
    SELECT doc_id, sequence, 0 AS list, NULL::INT AS start FROM d UNION ALL SELECT doc_id, sequence, 1, length(sequence)::INT FROM d WHERE length(sequence) > 8""",
)
def candidate_lists(spark, sf_dir):
    """Lists of candidates one after the other, nothing removed, columns that one lacks null; stored before they are merged."""
    found = folded(spark, sf_dir, upper()).select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0))).alias("sequence"))
    long = found.where("length(sequence) > 8").withColumn("start", F.length("sequence"))
    path = new_path(spark, "lists")
    writers.table(extraction.union(found, long), path, by="list")
    return spark.read.parquet(path).select("doc_id", "sequence", "list", "start")


def _words(spark, sf_dir):
    """(candidates, pages): lower-case words of conversations as candidates."""
    pages = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("pmid"), F.col("turn").alias("page"), F.lower(T.fold(F.col("text"))).alias("text"))
    word = F.explode(F.regexp_extract_all("text", F.lit("[a-z]{8,}"), F.lit(0))).alias("sequence")
    each = pages.select("pmid", word).distinct()
    more = [F.col("sequence").alias(c) for c in ("original_sequence", "normalized_sequence", "sequence_line", "context")]
    lists = [F.array(F.lit("T")).alias("techniques"), F.array(F.lit("l")).alias("technique_lines")]
    return each.select("pmid", "sequence", *more, *lists, F.length("sequence").alias("score"), F.lit(1.0).alias("evidence_score"), F.lit("pdf_text").alias("source")), pages


_WORDS = f"w AS (SELECT DISTINCT conv_id AS pmid, unnest(regexp_extract_all(lower({FOLD}), '[a-z]{{8,}}')) AS sequence FROM conversations)"


@query("evidence_chunks", f"WITH {_WORDS} SELECT pmid, sequence, 'pdf_text' AS source, sequence AS context FROM w")
def evidence_chunks(spark, sf_dir):
    path = new_path(spark, "chunks")
    writers.json(mining.chunks(_words(spark, sf_dir)[0], ["pmid"]), path)
    return spark.read.schema("pmid long, sequence string, source string, context string").json(path)


@query("llm_candidates", f"WITH {_WORDS} SELECT w.pmid, w.sequence, CAST(length(w.sequence) AS BIGINT) AS score, min(c.turn) AS page FROM w JOIN conversations c ON c.conv_id = w.pmid AND contains(lower(regexp_replace(c.text, '[^\\x00-\\x7F]', 'x', 'g')), w.sequence) GROUP BY ALL")
def llm_candidates(spark, sf_dir):
    found, pages = _words(spark, sf_dir)
    path = new_path(spark, "llm")
    writers.table(mining.llm_candidates(found, pages), path)
    return spark.read.parquet(path).select(F.col("pmid").cast("long").alias("pmid"), "sequence", F.col("score").cast("long").alias("score"), "page")


@query("supplementary_json", plans.SUPP_CELLS_SQL)
def supplementary_json(spark, sf_dir):
    path = new_path(spark, "supp")
    writers.json(plans.supp_cells(spark, sf_dir), path)
    return spark.read.schema("p_partkey long, start long, sequence string, original_sequence string").json(path)


@query("audit_log", "SELECT p_partkey % 3 AS type, count(*) * 2 AS n, count(DISTINCT p_brand) AS prompts FROM part GROUP BY 1")
def audit_log(spark, sf_dir):
    """Records are appended, those of one prompt are told by its number."""
    path = new_path(spark, "log")
    rows = table(spark, sf_dir, "part").select((F.col("p_partkey") % 3).alias("type"), F.sha2("p_brand", 256).alias("prompt_id"), F.col("p_name").alias("response"))
    for _ in range(2):
        writers.log(rows, path)
    return spark.read.schema("type long, prompt_id string, response string").json(path).groupBy("type").agg(F.count("*").alias("n"), F.countDistinct("prompt_id").alias("prompts"))


@query("metrics_file", f"WITH {evaluating.SETS} SELECT pmid AS \"PMID\", CAST(tp AS VARCHAR) AS \"TP\", CAST(fp AS VARCHAR) AS \"FP\", CAST(fn AS VARCHAR) AS \"FN\", row_number() OVER (ORDER BY pmid) - 1 AS no FROM counts")
def metrics_file(spark, sf_dir):
    path = new_path(spark, "metrics")
    writers.metrics(evaluating.counts(spark, sf_dir), path)
    return readers.tables(readers.files(spark, path, "*.csv")).select(*[F.col("cells")[k].alias(c) for k, c in enumerate(("PMID", "TP", "FP", "FN"))], F.col("row").cast("long").alias("no"))


@query("report_file", R.ORACLE_SQL["eval_report"].replace("SELECT unnest(", "SELECT unnest(range(12)) AS no, unnest("))
def report_file(spark, sf_dir):
    path = new_path(spark, "report")
    writers.text(evaluation.report(evaluation.micro(evaluating.counts(spark, sf_dir))), path)
    return readers.texts(spark, path, "*.txt").select(F.posexplode(T.lines(F.col("value"))).alias("no", "value")).withColumn("no", F.col("no").cast("long"))


#: Documents of a file that arrives at most.
_STREAM_ROWS = 2_000


@query("mined_stream", R.ORACLE_SQL["cand_extract"])
def mined_stream(spark, sf_dir):
    """Documents that arrive as files, mined batch by batch."""
    root = new_path(spark, "stream")
    docs = folded(spark, sf_dir, upper())
    # documents are written where they are; more of them are more files, not larger ones
    docs.write.option("maxRecordsPerFile", min(_STREAM_ROWS, max(1, -(-docs.count() // 3)))).parquet(f"{root}/in")
    arrived = readers.listing(spark, f"{root}/in", "*.parquet").count()

    def mine(batch):
        return mining.sequences(batch, ["doc_id"], "text", reach=0).select("doc_id", "sequence", F.length("sequence").cast("long").alias("length"), F.col("places")[0]["start"].alias("start"), "occurrences")

    incremental.mine_new(spark, docs.schema, f"{root}/in", f"{root}/out", f"{root}/checkpoint", mine, files=max(1, -(-arrived // 3))).awaitTermination()
    return spark.read.parquet(f"{root}/out").select("doc_id", "sequence", "length", "start", "occurrences")


@query(
    "supp_first",
    """WITH f AS (SELECT p_partkey, CAST(p_partkey % 7 AS VARCHAR) || '_s' || CAST(p_size % 3 AS VARCHAR) || '.csv' AS file, p_type AS s FROM part)
    SELECT substring(file, 1, 1) AS pmid, s AS sequence, arg_min(p_partkey, file || lpad(CAST(p_partkey AS VARCHAR), 9, '0')) AS p_partkey FROM f GROUP BY ALL""",
)
def supp_first(spark, sf_dir):
    """Of equal sequences of a document's files the first in the order of file and row."""
    part = table(spark, sf_dir, "part")
    name = F.concat((F.col("p_partkey") % 7).cast("string"), F.lit("_s"), (F.col("p_size") % 3).cast("string"), F.lit(".csv"))
    rows = part.select(name.alias("file"), F.col("p_partkey").alias("row"), F.col("p_type").alias("sequence"))
    keys = part.select((F.col("p_partkey") % 7).cast("string").alias("pmid")).distinct()
    own = merging.join_by_prefix(rows, keys, "file", "pmid")
    return merging.first_of(own, ["pmid", "sequence"], ["file", "row"]).select("pmid", "sequence", F.col("row").alias("p_partkey"))
