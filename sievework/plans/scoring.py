"""Queries of sequence scores, context scores and model responses."""

from __future__ import annotations

import itertools
import json
import re

import numpy as np
from pyspark.sql import functions as F

from ..functions import lexicons as lex
from ..functions import sql
from ..functions import text as T
from ..operators import mining, scoring, verification
from ..storage import store
from . import mining as plans
from . import registry as R
from .registry import AA, FOLD, TOKEN, UP, query, table, upper


def _tokens(spark, sf_dir, name):
    rows = table(spark, sf_dir, name).select(F.explode(F.regexp_extract_all(upper(), F.lit(TOKEN), F.lit(0))).alias("seq"))
    return rows


REFS = f"refs AS (SELECT unnest(regexp_extract_all({UP}, '{TOKEN}')) AS seq FROM benchmark), d AS (SELECT DISTINCT seq FROM refs)"
QUERIES_SQL = f"q AS (SELECT DISTINCT unnest(regexp_extract_all({UP}, '{TOKEN}')) AS seq FROM documents)"
GRAMS = "list_transform(range(1, length(seq) - 1), lambda i: lower(substring(seq, i, 3)))"
IDF = f"""gd AS (SELECT g AS gram, count(*) AS df FROM (SELECT seq, unnest(list_distinct({GRAMS})) AS g FROM d) GROUP BY 1),
idf AS (SELECT gram, df, ln((1 + (SELECT count(*) FROM d)) / (1 + df)::DOUBLE) + 1 AS idf FROM gd)"""


def _weights(name: str, source: str) -> str:
    return f"""{name}_t AS (SELECT seq, gram, count(*) * any_value(idf) AS v FROM (SELECT seq, unnest({GRAMS}) AS gram FROM {source}) JOIN idf USING (gram) GROUP BY seq, gram),
    {name} AS (SELECT seq, gram, v / sqrt(sum(v * v) OVER (PARTITION BY seq)) AS w FROM {name}_t)"""


NEAREST = f"""{IDF}, {_weights('rw', 'd')}, {_weights('qw', 'miss')},
nn AS (SELECT seq, max(c) AS nearest FROM (SELECT qw.seq, rw.seq AS ref, sum(qw.w * rw.w) AS c FROM qw JOIN rw USING (gram) GROUP BY ALL) GROUP BY 1)"""


@query("ref_stats", f"WITH {REFS} SELECT median(length(seq)) AS median_length, CAST(sum(length(seq)) AS BIGINT) AS residues FROM refs")
def ref_stats(spark, sf_dir):
    return scoring.reference_statistics(_tokens(spark, sf_dir, "benchmark")).select("median_length", "residues")


@query("letter_shares", f"WITH {REFS} SELECT letter, count(*) AS n, round(count(*) / (sum(count(*)) OVER ())::DOUBLE, 6) AS share FROM (SELECT unnest(string_split(seq, '')) AS letter FROM refs) GROUP BY 1")
def letter_shares(spark, sf_dir):
    return scoring.letter_shares(_tokens(spark, sf_dir, "benchmark")).withColumn("share", F.round("share", 6))


@query("kmer_idf", f"WITH {REFS}, {IDF} SELECT gram, df, round(idf, 6) AS idf FROM idf")
def kmer_idf(spark, sf_dir):
    return scoring.gram_idf(_tokens(spark, sf_dir, "benchmark")).withColumn("idf", F.round("idf", 6))


@query("kmer_nn", f"WITH {REFS}, {QUERIES_SQL}, miss AS (SELECT * FROM q), {NEAREST} SELECT q.seq, round(coalesce(nearest, 0), 6) AS nearest FROM q LEFT JOIN nn USING (seq)")
def kmer_nn(spark, sf_dir):
    return _nearest(spark, sf_dir)


def _nearest(spark, sf_dir, **more):
    return scoring.nearest(_tokens(spark, sf_dir, "documents"), _tokens(spark, sf_dir, "benchmark"), **more).withColumn("nearest", F.round("nearest", 6))


@query("kmer_nn_blocks", R.ORACLE_SQL["kmer_nn"])
def kmer_nn_blocks(spark, sf_dir):
    """The same by blocks of an index, as it is for more references than one index holds."""
    return _nearest(spark, sf_dir, postings=0)


@query("exact_match", f"WITH {REFS}, {QUERIES_SQL} SELECT seq, seq IN (SELECT seq FROM d) AS exact FROM q")
def exact_match(spark, sf_dir):
    known = _tokens(spark, sf_dir, "benchmark").distinct().withColumn("_k", F.lit(True))
    return _tokens(spark, sf_dir, "documents").distinct().join(known, "seq", "left").select("seq", F.coalesce("_k", F.lit(False)).alias("exact"))


@query(
    "sequence_score",
    f"""WITH {REFS}, {QUERIES_SQL}, miss AS (SELECT seq FROM q WHERE seq NOT IN (SELECT seq FROM d)), {NEAREST},
    rl AS (SELECT letter, count(*)::DOUBLE AS n FROM (SELECT unnest(string_split(seq, '')) AS letter FROM refs) GROUP BY 1),
    ql AS (SELECT seq, letter, count(*)::DOUBLE AS n FROM (SELECT seq, unnest(string_split(seq, '')) AS letter FROM miss) GROUP BY ALL),
    comp AS (SELECT ql.seq, sum(ql.n * coalesce(rl.n, 0)) / sqrt(sum(ql.n * ql.n)) / (SELECT sqrt(sum(n * n)) FROM rl) AS composition FROM ql LEFT JOIN rl USING (letter) GROUP BY 1),
    s AS (SELECT miss.seq, coalesce(nearest, 0) AS nearest, composition, greatest(0, 1 - abs(length(miss.seq) - m) / greatest(m, 1)) AS length_score
          FROM miss LEFT JOIN nn USING (seq) JOIN comp ON comp.seq = miss.seq, (SELECT median(length(seq)) AS m FROM refs))
    SELECT seq, FALSE AS exact, round(nearest, 6) AS nearest, round(composition, 6) AS composition, round(length_score, 6) AS length_score, 1.0::DOUBLE AS validity,
           round(0.5 * nearest + 0.3 * composition + 0.2 * length_score, 6) AS sequence_score FROM s
    UNION ALL SELECT seq, TRUE, 1.0, 1.0, 1.0, 1.0, 1.0 FROM q WHERE seq IN (SELECT seq FROM d)""",
)
def sequence_score(spark, sf_dir):
    scores = scoring.sequence_scores(_tokens(spark, sf_dir, "documents"), _tokens(spark, sf_dir, "benchmark"))
    return scores.select("seq", "exact", *[F.round(c, 6).alias(c) for c in ("nearest", "composition", "length_score", "validity", "sequence_score")])


@query("length_validity", f"SELECT p_partkey, CASE WHEN length(s) > 0 THEN round(length(regexp_replace(s, '[^{AA}]', '', 'g')) / length(s)::DOUBLE, 6) END AS validity, round(greatest(0, 1 - abs(length(s) - m) / greatest(m, 1)), 6) AS length_score FROM (SELECT p_partkey, upper(p_name) AS s FROM part), (SELECT median(length(p_type)) AS m FROM part)")
def length_validity(spark, sf_dir):
    median = table(spark, sf_dir, "part").agg(F.median(F.length("p_type")).alias("m"))
    part = table(spark, sf_dir, "part").select("p_partkey", F.upper("p_name").alias("s")).crossJoin(F.broadcast(median))  # one row
    return part.select("p_partkey", F.round(F.when(F.length("s") > 0, scoring.validity(F.col("s"))), 6).alias("validity"), F.round(scoring.length_score(F.length("s").cast("double"), F.col("m")), 6).alias("length_score"))


@query("ref_sample_cap", f"WITH {REFS} SELECT seq FROM d ORDER BY md5(seq), seq LIMIT 100")
def ref_sample_cap(spark, sf_dir):
    return scoring.capped(_tokens(spark, sf_dir, "benchmark"), rows=100)


@query(
    "context_cosine",
    """WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS n FROM v)
    SELECT a.vec_id, round(greatest(0, max(list_dot_product(a.e, b.e) / a.n / b.n)), 6) AS bio_score FROM u a, u b WHERE b.vec_id % 50 = 0 GROUP BY 1""",
)
def context_cosine(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    scores = scoring.context_scores(rows, "vec_id", rows.where(F.col("vec_id") % 50 == 0))
    return scores.withColumn("bio_score", F.round("bio_score", 6))


@query("context_cosine_blocks", R.ORACLE_SQL["context_cosine"])
def context_cosine_blocks(spark, sf_dir):
    """The same by blocks of references, as it is for more of them than are broadcast."""
    rows = table(spark, sf_dir, "embeddings")
    scores = scoring.context_scores(rows, "vec_id", rows.where(F.col("vec_id") % 50 == 0), most=16)
    return scores.withColumn("bio_score", F.round("bio_score", 6))


#: A text's letter counts stand in for a model's vector.
_LETTERS = "aeinst"
_LETTER_SQL = "[" + ", ".join(f"1.0::DOUBLE + length(t) - length(replace(t, '{c}', ''))" for c in _LETTERS) + "]"

# ------------------------------------------------------------------ responses

_K = "CAST(json_extract_string(props, '$.k') AS INT)"


def _responses(spark, sf_dir):
    """Responses made of events: objects in noise, wrong types, numbers out of range, none at all."""
    k = F.get_json_object("props", "$.k").cast("int")
    flag = F.when(k % 7 == 0, F.lit('"true"')).otherwise(F.when(k % 2 == 0, F.lit("true")).otherwise(F.lit("false")))
    confidence = F.when(k % 11 == 0, F.lit("1.5")).when(k % 5 == 0, F.concat(F.lit('"'), (k / 100).cast("string"), F.lit('"'))).otherwise((k / 100).cast("string"))
    support = F.element_at(F.array(*map(F.lit, ("strong", "moderate", "weak", "reject", "other"))), (k % 5 + 1).cast("int"))
    body = F.concat(F.lit('{"valid_sequence": '), flag, F.lit(', "confidence": '), confidence, F.lit(', "support_type": "'), support, F.lit('", "linked_techniques": [], "reason": "r"}'))
    return table(spark, sf_dir, "events").select("event_id", k.alias("k"), F.when(k % 13 == 0, F.lit("no object here")).otherwise(F.concat(F.lit("noise "), body, F.lit(" tail"))).alias("response"))


@query(
    "json_extract_validate",
    f"""WITH e AS (SELECT event_id, {_K} AS k FROM events), r AS (SELECT *, CASE
      WHEN k % 13 = 0 THEN 'no object' WHEN k % 7 = 0 THEN 'valid_sequence' WHEN k % 11 = 0 THEN 'confidence' WHEN k % 5 = 4 THEN 'support_type' END AS error FROM e)
    SELECT event_id, error IS NULL AS ok, error, CASE WHEN error IS NULL THEN k % 2 = 0 END AS valid_sequence, CASE WHEN error IS NULL THEN round(k / 100.0::DOUBLE, 6) END AS confidence FROM r""",
)
def json_extract_validate(spark, sf_dir):
    rows = _responses(spark, sf_dir).withColumn("v", verification.read_verdict(F.col("response")))
    ok = F.col("v.ok")
    return rows.select("event_id", ok.alias("ok"), F.col("v.error").alias("error"), F.when(ok, F.col("v.valid_sequence")).alias("valid_sequence"), F.when(ok, F.round("v.confidence", 6)).alias("confidence"))


@query(
    "json_technique_species",
    f"SELECT event_id, k % 3 <> 0 AS technique_ok, k % 3 <> 0 AND k % 4 <> 0 AS species_ok FROM (SELECT event_id, {_K} AS k FROM events)",
)
def json_technique_species(spark, sf_dir):
    k = F.col("k")
    flag = F.when(k % 3 == 0, F.lit("null")).otherwise(F.lit("true"))
    name = F.when(k % 4 == 0, F.lit("7")).when(k % 4 == 1, F.lit("null")).otherwise(F.lit('"s"'))
    body = F.concat(F.lit('{"technique_confirmed": '), flag, F.lit(', "species_confirmed": '), flag, F.lit(', "confidence": 0.5, "verified_species": '), name, F.lit(', "evidence_line": "e", "reason": ""}'))
    rows = _responses(spark, sf_dir).withColumn("body", body)
    return rows.select("event_id", verification.read_technique(F.col("body"))["ok"].alias("technique_ok"), verification.read_species(F.col("body"))["ok"].alias("species_ok"))


@query(
    "validity_gate",
    "SELECT event_id, value >= 10 AND NOT coalesce(CASE WHEN event_id % 3 > 0 THEN (event_id % 100) / 100.0 END < 0.6, FALSE) AND NOT coalesce(CASE WHEN event_id % 4 > 0 THEN (event_id % 10) / 10.0 END < 0.6, FALSE) AS is_valid FROM events",
)
def validity_gate(spark, sf_dir):
    i = F.col("event_id")
    rows = table(spark, sf_dir, "events").withColumn("sequence_score", F.when(i % 3 > 0, (i % 100) / 100)).withColumn("bio_score", F.when(i % 4 > 0, (i % 10) / 10))
    return rows.select("event_id", verification.final_validity(F.col("value") >= 10).alias("is_valid"))


@query(
    "synth_marker",
    "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN to_json([p_brand, 'synthesized']) ELSE to_json([p_brand]) END AS techniques, CASE WHEN p_size % 2 = 0 THEN to_json([p_type, CASE WHEN p_size % 4 = 0 THEN p_name ELSE '' END]) ELSE to_json([p_type]) END AS lines FROM part",
)
def synth_marker(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", F.array("p_brand").alias("verified_techniques"), F.array(F.lit(0.5)).alias("technique_scores"), F.array("p_type").alias("technique_evidence_lines"), (F.col("p_size") % 2 == 0).alias("is_synthesized"), F.when(F.col("p_size") % 4 == 0, F.col("p_name")).alias("synthesized_line"))
    return verification.with_synthesized(part).select("p_partkey", F.to_json("verified_techniques").alias("techniques"), F.to_json("technique_evidence_lines").alias("lines"))


@query("strength_labels", "SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'strong' WHEN o_orderpriority = '2-HIGH' THEN 'moderate' WHEN o_orderpriority = '5-LOW' THEN 'weak' ELSE 'reject' END AS support FROM orders")
def strength_labels(spark, sf_dir):
    p = F.col("o_orderpriority")
    graded = F.when(p == "1-URGENT", "High").when(p == "2-HIGH", "Medium").when(p == "5-LOW", "Low").otherwise("None")
    return table(spark, sf_dir, "orders").select("o_orderkey", verification.label_from_strength(graded).alias("support"))


#: The mean of the letter counts of a text's first 256 words; no words, no vector.
_WORD_SQL = "[" + ", ".join(f"1.0::DOUBLE + (length(t) - length(replace(t, '{c}', ''))) / n::DOUBLE" for c in _LETTERS) + "]"
_CUT = f"SELECT *, array_to_string(ws, ' ') AS t, len(ws) AS n FROM (SELECT *, regexp_extract_all({FOLD}, '[A-Za-z]+')[1:256] AS ws FROM {{0}})"


#: Words that a worker's encoder remembers.
_KNOWN_WORDS = 50_000


def letter_encoder():
    """Vectors of letter counts, pooled over a text's first words; words are remembered for the texts of a worker, up to a bound."""
    words, known = re.compile("[A-Za-z]+"), {}
    vectors = [[0.0] * len(_LETTERS)]

    def tokenise(text):
        out = []
        for m in itertools.islice(words.finditer(text), scoring.MOST_TOKENS):  # what comes after is cut in any case
            w = m[0]
            if w not in known:
                known[w] = len(vectors)
                vectors.append([1.0 + w.count(c) for c in _LETTERS])
            out.append(known[w])
        return out

    def embed(ids, mask):
        own, at = np.unique(ids, return_inverse=True)  # of the words these texts have, not of all that are known
        shown = np.array([vectors[i] for i in own.tolist()])[at.reshape(ids.shape)]
        if len(vectors) > _KNOWN_WORDS:  # ids hold for these texts alone
            known.clear()
            del vectors[1:]
        return shown

    return scoring.token_encoder(tokenise, embed)


@query(
    "encoder_scores",
    f"""WITH v AS (SELECT doc_id, {_WORD_SQL} AS e FROM ({_CUT.format("documents")}) WHERE n > 0),
    r AS (SELECT DISTINCT {_WORD_SQL} AS e FROM ({_CUT.format("benchmark")}) WHERE n > 0),
    s AS (SELECT doc_id, max(list_dot_product(v.e, r.e) / sqrt(list_dot_product(v.e, v.e)) / sqrt(list_dot_product(r.e, r.e))) AS s FROM v, r GROUP BY 1)
    SELECT doc_id, round(coalesce(s, 0), 6) AS bio_score FROM documents LEFT JOIN s USING (doc_id)""",
)
def encoder_scores(spark, sf_dir):
    """Contexts through an encoder of tokens that a worker loads once, cut and pooled, and their best references."""

    text = lambda name, *keys: table(spark, sf_dir, name).select(*keys, T.fold(F.col("text")).alias("t"))
    refs = store(scoring.encode(text("benchmark").distinct(), "t", letter_encoder), "references")
    own = store(scoring.encode(text("documents", "doc_id"), "t", letter_encoder), "contexts")
    return scoring.context_scores(own, "doc_id", refs).withColumn("bio_score", F.round("bio_score", 6))


@query(
    "sql_functions",
    f"""SELECT p_partkey, regexp_replace(upper(p_name), '[^A-Z]', '', 'g') AS letters, translate(regexp_replace(upper(p_type), '[^A-Z01]', '', 'g'), '0O1I', 'QQIL') AS candidate, regexp_replace(replace(upper(p_name), 'A ', 'A-' || chr(10) || ' '), '([{AA}])-\\s*\\n\\s*([{AA}])', '\\1\\2', 'g') AS joined,
    CAST(2 AS BIGINT) AS sentences, round(greatest(0, 1 - abs(length(p_name) - 20) / 20.0::DOUBLE), 6) AS length_score, round(length(regexp_replace(upper(p_name), '[^{AA}]', '', 'g')) / length(p_name)::DOUBLE, 6) AS validity,
    CASE WHEN p_size % 2 = 0 THEN {float(lex.EVIDENCE_WEIGHTS["NMR"])}::DOUBLE ELSE 1.0::DOUBLE END AS evidence, 'id' || p_partkey AS id, 'id' || p_partkey || ' d' AS description, regexp_replace(upper(p_brand || p_type), '\\s+', '', 'g') AS seq FROM part""",
)
def sql_functions(spark, sf_dir):
    """The functions as SQL knows them."""
    sql.register(spark)
    return spark.sql(
        """SELECT p_partkey, normalize_sequence(p_name) AS letters, normalize_candidate(p_type, 'ocr') AS candidate, join_hyphens(replace(upper(p_name), 'A ', 'A-\n ')) AS joined,
        CAST(size(split_sentences(concat('One. ', p_name))) AS BIGINT) AS sentences, round(length_score(length(p_name), 20), 6) AS length_score, round(sequence_validity(upper(p_name)), 6) AS validity,
        evidence_score(CASE WHEN p_size % 2 = 0 THEN array('NMR', 'NMR') ELSE array('none') END) AS evidence, f.id, f.description, f.seq
        FROM {part} p, LATERAL fasta(concat('>id', p.p_partkey, ' d\n', p_brand, '\n', p_type)) f""",
        part=table(spark, sf_dir, "part"),
    )


# ------------------------------------------------------------------ verification


def stub_model():
    """Answers by what a prompt asks about, so that SQL can say what comes of it; some answers can't be read."""

    def answer(prompt: str) -> str:
        if "Named in it: " in prompt:
            names = prompt.split("Named in it: ")[1].split("\n")[0]
            return json.dumps({"species_confirmed": names.startswith("P"), "confidence": 0.75, "verified_species": names.split(", ")[0], "evidence_line": names})
        if "Technique: " in prompt:
            name = prompt.split("Technique: ")[1].split("\n")[0]
            return json.dumps({"technique_confirmed": name in ("Alpha", "Gamma"), "confidence": 0.4 if name == "Gamma" else 0.87654, "evidence_line": f"line of {name}"})
        n = len(re.split("Sequence: |Sequence\n", prompt)[1].split()[0])
        if n % 5 == 0:
            return "no answer"
        if "Question\nShould" in prompt:
            return json.dumps({"verified": n % 2 == 1, "confidence": n / 200, "evidence_strength": ("High", "Medium", "Low", "None")[n % 4], "reason": "Synthetic" if n % 3 == 0 else "r"})
        return "so: " + json.dumps({"valid_sequence": n % 2 == 1, "confidence": n / 200, "support_type": "weak", "reason": "r", "species": "Prima" if n % 3 == 0 else None, "is_synthesized": n % 7 == 0, "synthesized_line": "made"})

    return answer


def _candidates(spark, sf_dir):
    """(candidates, documents) as the passes take them."""
    found = plans._firsts(spark, sf_dir, 100)
    pairs = mining.technique_lines(F.col("context"), R.TECHNIQUES, R.SUPERSEDES)
    score = F.when(F.length("sequence") % 4 == 0, 0.5).otherwise(0.9)
    found = found.select(F.concat_ws(":", "doc_id", "sequence").alias("id"), F.col("doc_id").cast("string").alias("pmid"), "sequence", F.lit("").alias("sequence_line"), "source", "context", F.lit(1.0).alias("evidence_score"), score.alias("sequence_score"), F.lit(None).cast("double").alias("bio_score"), pairs.alias("p"))
    found = found.withColumn("techniques", F.transform("p", lambda p: p["technique"])).withColumn("technique_lines", F.transform("p", lambda p: p["line"])).drop("p")
    documents = R.folded(spark, sf_dir).select(F.col("doc_id").cast("string").alias("pmid"), F.array_sort(mining.technique_names(F.col("text"), R.SPECIES)).alias("species"), F.substring("text", 1, 4000).alias("head"))
    return store(found, "candidates"), documents


_VALID = f"""{plans.RAW}, c AS (SELECT *, length(sequence) AS n, substring(up, greatest(start - 100, 0) + 1, start + length(match) + 100 - greatest(start - 100, 0)) AS context FROM firsts),
    valid AS (SELECT * FROM c WHERE n % 4 <> 0 AND n % 5 <> 0 AND n % 2 = 1)"""


@query(
    "verify_passes",
    f"""WITH {_VALID}, {plans.sql_techniques("doc_id, sequence", "context", "valid")},
    sp AS (SELECT doc_id, list_sort({R.sql_technique(FOLD, R.SPECIES)}) AS named FROM documents),
    v AS (SELECT valid.*, CASE WHEN n % 3 = 0 AND NOT list_contains(named, 'Prima') THEN list_append(named, 'Prima') ELSE named END AS names FROM valid JOIN sp USING (doc_id)),
    a AS (SELECT doc_id, sequence, count(*) AS alpha FROM k WHERE name = 'Alpha' GROUP BY ALL)
    SELECT v.doc_id || ':' || v.sequence AS id, round(n / 200.0::DOUBLE, 6) AS sequence_confidence, 'weak' AS support_type,
      CASE WHEN alpha IS NULL THEN '' ELSE 'Alpha' END || CASE WHEN n % 7 = 0 THEN CASE WHEN alpha IS NULL THEN '' ELSE '|' END || 'synthesized' ELSE '' END AS techniques,
      CASE WHEN alpha IS NULL THEN 0 ELSE 0.8765::DOUBLE END + CASE WHEN n % 7 = 0 THEN 1 ELSE 0 END AS score,
      CASE WHEN alpha IS NULL THEN '' ELSE 'line of Alpha' END || CASE WHEN n % 7 = 0 THEN CASE WHEN alpha IS NULL THEN '' ELSE '|' END || 'made' ELSE '' END AS lines,
      CASE WHEN names[1] LIKE 'P%' THEN names[1] END AS verified_species, CASE WHEN names[1] LIKE 'P%' THEN 0.75::DOUBLE ELSE 0.0::DOUBLE END AS species_confidence,
      CASE WHEN names[1] LIKE 'P%' THEN array_to_string(names, ', ') ELSE '' END AS species_line
    FROM v LEFT JOIN a ON a.doc_id = v.doc_id AND a.sequence = v.sequence""",
)
def verify_passes(spark, sf_dir):
    """The three passes over mined candidates with a model that answers by rule."""
    verified, _ = verification.verify(*_candidates(spark, sf_dir), stub_model, store)
    marked = verification.with_synthesized(verified)
    joined = lambda c: F.array_join(c, "|")
    score = F.aggregate("technique_scores", F.lit(0.0), lambda a, x: a + x)
    return marked.select("id", F.round("sequence_confidence", 6).alias("sequence_confidence"), "support_type", joined("verified_techniques").alias("techniques"), score.alias("score"), joined("technique_evidence_lines").alias("lines"), "verified_species", "species_confidence", F.col("species_evidence_line").alias("species_line"))


@query(
    "verify_graded",
    f"WITH {_VALID} SELECT doc_id || ':' || sequence AS id, CASE n % 4 WHEN 1 THEN 'moderate' WHEN 3 THEN 'reject' ELSE 'weak' END AS support_type, round(n / 200.0::DOUBLE, 6) AS sequence_confidence, n % 3 = 0 AS is_synthesized, CASE WHEN n % 3 = 0 THEN 'Synthetic' ELSE 'r' END AS reason FROM valid",
)
def verify_graded(spark, sf_dir):
    """The passes with a model that grades evidence."""
    verified, _ = verification.verify(*_candidates(spark, sf_dir), stub_model, store, graded=True)
    return verified.select("id", "support_type", F.round("sequence_confidence", 6).alias("sequence_confidence"), "is_synthesized", "reason")


@query(
    "verify_log",
    f"""WITH {plans.RAW} SELECT 'sequence_verification' AS type, CAST(CASE WHEN length(sequence) % 5 = 0 THEN 3 ELSE 1 END AS BIGINT) AS tries, count(*) AS n FROM firsts WHERE length(sequence) % 4 <> 0 GROUP BY ALL""",
)
def verify_log(spark, sf_dir):
    """How often each prompt of the first pass was asked: answers that can't be read are asked for again."""
    _, log = verification.verify(*_candidates(spark, sf_dir), stub_model, store)
    return log.where("type = 'sequence_verification'").groupBy("type", F.col("attempt").cast("long").alias("tries")).agg(F.count("*").alias("n"))
