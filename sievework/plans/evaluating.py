"""Queries of evaluation against a gold standard."""

from __future__ import annotations

import string

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import evaluation, verification
from ..sources import writers
from .registry import TOKEN, UP, query, table, upper

#: Found: tokens of documents by language. Gold: tokens of the benchmark, each for two languages.
SETS = f"""found AS (SELECT DISTINCT lang AS pmid, unnest(regexp_extract_all({UP}, '{TOKEN}')) AS sequence FROM documents),
gold AS (SELECT DISTINCT unnest(['en', 'xx']) AS pmid, sequence FROM (SELECT unnest(regexp_extract_all({UP}, '{TOKEN}')) AS sequence FROM benchmark)),
counts AS (SELECT pmid, count(*) FILTER (f AND g) AS tp, count(*) FILTER (f AND NOT g) AS fp, count(*) FILTER (NOT f AND g) AS fn
  FROM (SELECT coalesce(a.pmid, b.pmid) AS pmid, a.sequence IS NOT NULL AS f, b.sequence IS NOT NULL AS g FROM found a FULL JOIN gold b ON a.pmid = b.pmid AND a.sequence = b.sequence) GROUP BY 1),
total AS (SELECT CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn FROM counts),
pr AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0 END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0 END AS recall FROM total)"""


def _sets(spark, sf_dir):
    token = F.explode(F.regexp_extract_all(upper(), F.lit(TOKEN), F.lit(0))).alias("sequence")
    found = table(spark, sf_dir, "documents").select(F.col("lang").alias("pmid"), token).distinct()
    gold = table(spark, sf_dir, "benchmark").select(token).select(F.explode(F.array(F.lit("en"), F.lit("xx"))).alias("pmid"), "sequence")
    return found, evaluation.gold_pairs(gold)


def counts(spark, sf_dir):
    return evaluation.confusion(*_sets(spark, sf_dir))


@query("confusion_by_doc", f"WITH {SETS} SELECT * FROM counts")
def confusion_by_doc(spark, sf_dir):
    return counts(spark, sf_dir)


@query("micro_prf", f"WITH {SETS} SELECT tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END, 6) AS f1 FROM pr")
def micro_prf(spark, sf_dir):
    return evaluation.micro(counts(spark, sf_dir)).select("tp", "fp", "fn", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query("eval_rollup", f"WITH {SETS} SELECT pmid, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn FROM counts GROUP BY ROLLUP (pmid)")
def eval_rollup(spark, sf_dir):
    return evaluation.rolled_up(counts(spark, sf_dir))


@query("gold_intersect", f"WITH {SETS} SELECT pmid, sequence FROM found INTERSECT SELECT pmid, sequence FROM gold")
def gold_intersect(spark, sf_dir):
    found, gold = _sets(spark, sf_dir)
    return found.select("pmid", "sequence").intersect(gold.select("pmid", "sequence"))


@query("gold_missed", f"WITH {SETS} SELECT pmid, sequence FROM gold EXCEPT SELECT pmid, sequence FROM found")
def gold_missed(spark, sf_dir):
    found, gold = _sets(spark, sf_dir)
    return gold.select("pmid", "sequence").subtract(found.select("pmid", "sequence"))


@query("gold_keys", f"WITH {SETS} SELECT pmid FROM gold UNION SELECT pmid FROM found")
def gold_keys(spark, sf_dir):
    found, gold = _sets(spark, sf_dir)
    return gold.select("pmid").union(found.select("pmid")).distinct()


@query("gold_match_tristate", f"WITH {SETS} SELECT f.pmid, f.sequence, CASE WHEN f.pmid IN (SELECT pmid FROM gold) THEN EXISTS (SELECT 1 FROM gold g WHERE g.pmid = f.pmid AND g.sequence = f.sequence) END AS gold_match FROM found f")
def gold_match_tristate(spark, sf_dir):
    found, gold = _sets(spark, sf_dir)
    return evaluation.gold_match(found, gold)


@query(
    "gold_stanza_ffill",
    f"""WITH l AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN 'PMID: ' || (conv_id * 10 + turn) ELSE regexp_extract({UP}, '{TOKEN}') END AS line FROM conversations),
    f AS (SELECT *, last_value(nullif(regexp_extract(line, '^PMID[:\\s]+(\\d+)', 1), '') IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS pmid FROM l)
    SELECT DISTINCT conv_id, pmid, line AS sequence FROM f WHERE pmid IS NOT NULL AND NOT starts_with(line, 'PMID:') AND regexp_full_match(line, '[ACDEFGHIKLMNPQRSTVWY]{{4,}}')""",
)
def gold_stanza_ffill(spark, sf_dir):
    head = F.concat(F.lit("PMID: "), (F.col("conv_id") * 10 + F.col("turn")).cast("string"))
    lines = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 3 == 0, head).otherwise(F.regexp_extract(upper(), TOKEN, 0)).alias("line"))
    return evaluation.gold_stanzas(lines, ["conv_id"], "turn", "line")


@query(
    "eval_report",
    f"""WITH {SETS}, x AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM pr)
    SELECT unnest(['Evaluation Report', '=================', '', format('Total True Positives (TP): {{}}', tp), format('Total False Positives (FP): {{}}', fp), format('Total False Negatives (FN): {{}}', fn), '',
      format('Precision: {{:.4f}}', precision), format('Recall: {{:.4f}}', recall), format('F1 Score: {{:.4f}}', f1), '', 'Per-PMID Results saved to metrics_by_pmid.csv']) AS value FROM x""",
)
def eval_report(spark, sf_dir):
    return evaluation.report(evaluation.micro(counts(spark, sf_dir)))


@query(
    "metadata",
    "SELECT conv_id, count(*) AS page_count, count(*) FILTER (role = 'user') AS image_count, CAST(0 AS BIGINT) AS supplementary_count FROM conversations GROUP BY 1",
)
def metadata(spark, sf_dir):
    pages = table(spark, sf_dir, "conversations")
    return writers.metadata(pages, pages.where("role = 'user'"), pages.where("role = 'none'"), "conv_id")


@query("result_columns", "SELECT CAST(p_partkey AS VARCHAR) AS PMID, p_type AS Sequence, '[\"' || p_brand || '\"]' AS Techniques, CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size % 3 = 1 THEN 'True' ELSE 'False' END AS Gold_Standard_Match, '' AS Species FROM part")
def result_columns(spark, sf_dir):
    return writers.result_columns(result_rows(table(spark, sf_dir, "part"))).select("PMID", "Sequence", "Techniques", "Gold_Standard_Match", "Species")


def result_rows(part):
    """part with the columns of a verified result."""
    text = lambda v: F.lit(v).cast("string")
    return part.select("p_name", F.col("p_partkey").cast("string").alias("pmid"), F.col("p_type").alias("sequence"), text("").alias("sequence_line"), F.lit(0.5).alias("sequence_confidence"), F.array("p_brand").alias("verified_techniques"), F.array(F.lit(0.5)).alias("technique_scores"), F.array(F.lit("")).alias("technique_evidence_lines"), text(None).alias("verified_species"), F.lit(0.0).alias("species_confidence"), text("").alias("species_evidence_line"), F.lit(False).alias("is_synthesized"), F.when(F.col("p_size") % 3 > 0, F.col("p_size") % 3 == 1).alias("gold_match"), text("").alias("reason"))


_SHARED = " + ".join(f"least(length(a) - length(replace(a, '{c}', '')), length(b) - length(replace(b, '{c}', '')))" for c in string.ascii_uppercase)


@query("ratio_bound", f"WITH p AS (SELECT a.p_partkey, regexp_replace(upper(a.p_name), '[^A-Z]', '', 'g') AS a, regexp_replace(upper(b.p_name), '[^A-Z]', '', 'g') AS b FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1) SELECT p_partkey, round(CASE WHEN length(a) + length(b) > 0 THEN 2 * ({_SHARED}) / (length(a) + length(b))::DOUBLE ELSE 1 END, 6) AS bound FROM p")
def ratio_bound(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", T.letters_only(F.col("p_name")).alias("a"))
    after = part.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("a").alias("b"))
    return part.join(after, "p_partkey").select("p_partkey", F.round(evaluation.ratio_bound(F.col("a"), F.col("b")), 6).alias("bound"))


@query("gold_similar")
def gold_similar(spark, sf_dir):
    """Sequences that are nearly a gold sequence of their document; SQL has no matching blocks, so brute force tests it."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("pmid"), F.col("p_name").alias("sequence"))
    gold = evaluation.gold_pairs(part.where("p_partkey % 10 = 0"))
    return evaluation.similar_to_gold(part, gold)


_ASKED = "SELECT CAST(p_partkey AS VARCHAR) AS pmid, p_type AS sequence, CASE WHEN p_size % 2 = 0 THEN [p_brand, 'T'] ELSE [] END AS ts, CASE WHEN p_size % 2 = 0 THEN [p_name, 'l'] ELSE [] END AS ls, p_size, p_name FROM part"


@query(
    "prompt_pairs",
    f"SELECT pmid, array_to_string(list_transform(list_zip(ts, ls), lambda z: z[1] || ': ' || z[2]), chr(10)) AS pairs, CASE WHEN p_size % 3 = 0 THEN 'none' ELSE '0.75' END AS score, p_name || CASE WHEN p_size % 2 = 0 THEN chr(10) || chr(10) || 'Extracted Technique Sentences:' || chr(10) || p_name || chr(10) || 'l' ELSE '' END AS extended FROM ({_ASKED})",
)
def prompt_pairs(spark, sf_dir):
    """What prompts say of techniques and their sentences."""
    even = F.col("p_size") % 2 == 0
    none = F.array().cast("array<string>")
    rows = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("pmid"), F.col("p_type").alias("sequence"), F.lit("csv").alias("source"), F.col("p_name").alias("context"), F.lit(None).cast("double").alias("bio_score"),
        F.when(F.col("p_size") % 3 != 0, F.lit(0.75)).alias("sequence_score"), F.when(even, F.array("p_brand", F.lit("T"))).otherwise(none).alias("techniques"), F.when(even, F.array("p_name", F.lit("l"))).otherwise(none).alias("technique_lines"),
    )
    prompt = verification.sequence_prompt()
    part = lambda pattern: F.regexp_extract(prompt, pattern, 1)
    return rows.select("pmid", part(r"(?s)Techniques found:\n(.*)\nText:").alias("pairs"), part(r"Scores: sequence ([^,]*),").alias("score"), verification.extended_context().alias("extended"))
