"""The jobs as queries: each runs twice into one new folder and gives the output as it then stands."""

from __future__ import annotations

import string
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import candidate_catalogue, evidence_ledger
from jobs.common import config_of
from sievework.functions import lexicons as lex
from sievework.plans import registry as R
from sievework.storage import shared_folder

_CATALOGUE, _LEDGER = config_of(None, candidate_catalogue.CONFIG), config_of(None, evidence_ledger.CONFIG)


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder that stays."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def job1_candidate_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _folder(spark, "candidate-catalogue")
    for _ in range(2):
        rows = candidate_catalogue.run(spark, f"{sf_dir}/documents.parquet", f"{sf_dir}/benchmark.parquet", f"{root}/output", _CATALOGUE)
    lists = [F.array_join(c, "|").alias(c) for c in ("species", "techniques", "technique_lines")]
    return rows.select("doc_id", "lang", "sequence", "original_sequence", "start", F.col("length").cast("long").alias("length"), F.col("score").cast("long").alias("score"), F.col("rank").cast("long").alias("rank"), "source", "context", "sequence_line", "evidence_score", "known", *lists)


def job2_evidence_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _folder(spark, "evidence-ledger")
    for _ in range(2):
        rows = evidence_ledger.run(spark, f"{sf_dir}/documents.parquet", f"{root}/output", f"{root}/checkpoint", _LEDGER)
    return rows.select("doc_id", "lang", "technique", "statement")


# ------------------------------------------------------------------ SQL


#: A text in which what is not ASCII stands as x (letters and digits), a blank (white space) or a dot, so that RE2's notions of them hold; as long as the text.
_PLAIN = r"regexp_replace(regexp_replace(regexp_replace(text, '[\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]', ' ', 'g'), '[^\x00-\x7F\pL\pN]', '.', 'g'), '[^\x00-\x7F]', 'x', 'g')"


def _points(context: str, words: dict) -> str:
    has = lambda w: f"CAST(contains(lower({context}), '{w}') AS INT)"
    table = f"({R.sql_any(f'lower({context})', words['table'])} OR len(list_filter({R.LINES.format(context)}, lambda x: len(string_split_regex(trim(x), '\\s{{2,}}|\\t')) >= 2)) > 0)"
    listed = " + ".join([f"3 * {has(w)}" for w in words["peptide"]] + [f"5 * {has(w)}" for w in words["table"]])
    near = rf"6 * CAST(regexp_matches({context}, '(?i)\b({words['before']})\W{{0,20}}' || sequence || '\b') AS INT) + 6 * CAST(regexp_matches({context}, '(?i)\b' || sequence || '\W{{0,30}}({words['after']})\b') AS INT)"
    letters = R.sql_letters("sequence")
    rich = f"CASE WHEN length(sequence) >= 20 AND {letters} >= 10 THEN 4 WHEN length(sequence) >= 15 AND {letters} >= 8 THEN 2 ELSE 0 END"
    return f"greatest({listed} + 8 * CAST({table} AS INT) + {near} + 2 * least(greatest(occurrences - 1, 0), 5) + {rich}, 0)"


def _catalogue_sql(config: dict) -> str:
    cut = "substring({0}, greatest(start - 1000, 0) + 1, start + length(match) + 1000 - greatest(start - 1000, 0))"
    plausible = R.sql_plausible("sequence", lex.BLACKLIST, lex.SECTION_TITLES)
    weights = ", ".join(f"('{n}', {w}.0)" for n, w in config["weights"].items())
    covered = " OR ".join(f"(name IN ({R.sql_list(general)}) AND EXISTS (SELECT 1 FROM h g WHERE g.doc_id = h.doc_id AND g.sequence = h.sequence AND g.name = '{n}'))" for n, general in config["supersedes"].items() if general)
    return rf"""WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
    t AS (SELECT doc_id, lang, text, {_PLAIN} AS plain FROM d),
    raw AS (SELECT *, regexp_extract_all(plain, '{lex.CANDIDATE}') AS ms, string_split_regex(plain, '{lex.CANDIDATE}') AS gaps FROM t),
    each AS (SELECT doc_id, unnest(ms) AS match, unnest(range(len(ms))) AS no, unnest(gaps[1:len(ms)]) AS gap FROM raw),
    placed AS (SELECT *, CAST(sum(length(gap) + length(match)) OVER (PARTITION BY doc_id ORDER BY no) - length(match) AS BIGINT) AS start, regexp_replace(match, '[^A-Z01]', '', 'g') AS sequence FROM each),
    counted AS (SELECT *, count(*) OVER (PARTITION BY doc_id, sequence) AS occurrences FROM placed),
    around AS (SELECT doc_id, lang, text, sequence, match, start, occurrences, {cut.format("plain")} AS seen, {cut.format("text")} AS context FROM counted JOIN t USING (doc_id) WHERE {plausible}),
    scored AS (SELECT *, {_points("seen", config["keywords"])} AS score FROM around WHERE NOT {R.sql_gene("sequence", "seen", lex.GENE_TERMS, lex.PEPTIDE_TERMS)}),
    a AS (SELECT * FROM scored WHERE score >= {config["least"]} QUALIFY row_number() OVER (PARTITION BY doc_id, sequence ORDER BY start) = 1),
    s AS (SELECT doc_id, sequence, unnest(ss) AS s, unnest(range(len(ss))) AS no FROM (SELECT doc_id, sequence, {R.SENTENCES.format("context")} AS ss FROM a)),
    m AS (SELECT doc_id, sequence, s, no, unnest({R.sql_hits("s", config["techniques"])}, recursive := true) FROM s),
    h AS (SELECT doc_id, sequence, name, name_no, arg_min(s, pattern_no * 1000000 + no) AS line FROM m GROUP BY ALL),
    k AS (SELECT * FROM h WHERE NOT ({covered or "FALSE"})),
    w(name, w) AS (VALUES {weights}),
    e AS (SELECT doc_id, sequence, string_agg(name, '|' ORDER BY name_no) AS techniques, string_agg(line, '|' ORDER BY name_no) AS technique_lines, sum(coalesce(w, 0)) AS evidence FROM k LEFT JOIN w USING (name) GROUP BY ALL),
    b AS (SELECT DISTINCT unnest(regexp_extract_all(translate({config["reference_text"]}, '{string.ascii_lowercase}', '{string.ascii_uppercase}'), '[{lex.AA}]{{6,}}')) AS sequence FROM benchmark)
    SELECT a.doc_id, a.lang, a.sequence, substring(a.text, a.start + 1, length(a.match)) AS original_sequence, CAST(a.start AS BIGINT) AS start, CAST(length(a.sequence) AS BIGINT) AS length, CAST(a.score AS BIGINT) AS score,
      row_number() OVER (PARTITION BY a.doc_id ORDER BY a.score DESC, a.start) AS rank, 'pdf_text' AS source, a.context,
      coalesce(trim(list_filter({R.LINES.format("a.text")}, lambda x: contains(x, substring(a.text, a.start + 1, length(a.match))))[1]), '') AS sequence_line,
      CAST(CASE WHEN evidence > 0 THEN evidence ELSE 1 END AS DOUBLE) AS evidence_score, b.sequence IS NOT NULL AS known,
      array_to_string(list_sort({R.sql_names("a.text", config["species"])}), '|') AS species, coalesce(techniques, '') AS techniques, coalesce(technique_lines, '') AS technique_lines
    FROM a LEFT JOIN e ON e.doc_id = a.doc_id AND e.sequence = a.sequence LEFT JOIN b ON b.sequence = a.sequence"""


def _ledger_sql(config: dict) -> str:
    return f"""WITH s AS (SELECT doc_id, lang, unnest({R.SENTENCES.format("text")}) AS statement FROM documents)
    SELECT DISTINCT doc_id, lang, unnest({R.sql_names("statement", config["techniques"])}) AS technique, statement FROM s WHERE doc_id IS NOT NULL"""


QUERIES = {"job1_candidate_catalogue": job1_candidate_catalogue, "job2_evidence_ledger": job2_evidence_ledger}
ORACLE_SQL = {"job1_candidate_catalogue": _catalogue_sql(_CATALOGUE), "job2_evidence_ledger": _ledger_sql(_LEDGER)}
