"""Verification by a model: prompts, strict reading of responses, and the three passes.

A model is anything that maps prompts to response texts. Passes send each distinct
prompt once; responses are validated where they arrive, asked for again if they fail any
rule, and only validated ones count. Candidates that their scores rule out are never sent.
With a journal, prompts are a stream of small files: what has been answered stays answered
when a run fails, and the next one asks the rest.
"""

from __future__ import annotations

import functools
import json
import math
import time
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..streaming import incremental

Model = Callable[[str], str]

#: What a verified sequence may be supported by, thresholds, and what a model is asked with.
SUPPORT = ("strong", "moderate", "weak", "reject")
LEAST_SCORE = 0.6
LEAST_TECHNIQUE = 0.5
OPTIONS = {"temperature": 0, "num_predict": 512, "num_thread": 6}
#: Labels and question that a grading model was tuned on, each with the column it shows.
GRADED = [("Sequence", "sequence"), ("Species", "_species"), ("Sequence Score", "sequence_score"), ("Bio Score", "bio_score"), ("Evidence Score", "evidence_score"), ("Detected Techniques", "techniques"), ("Context", "context")]
QUESTION = "Question\nShould this candidate be accepted as a real experimentally validated plant peptide?\n"


def http_model(url: str, model: str, timeout: int = 300) -> Callable[[], Model]:
    """A loader of a client for a local generation endpoint that answers in JSON."""

    def load() -> Model:
        def generate(prompt: str) -> str:
            body = {"model": model, "prompt": prompt, "stream": False, "format": "json", "options": OPTIONS}
            request = urllib.request.Request(f"{url.rstrip('/')}/api/generate", json.dumps(body).encode(), {"Content-Type": "application/json"})
            with urllib.request.urlopen(request, timeout=timeout) as answer:
                return json.loads(answer.read())["response"]

        return generate

    return load


# ------------------------------------------------------------------ reading responses


#: How a JSON value begins.
_BEGINS = r"^\s*(?:[\[{\"0-9-]|true|false|null)"


def json_object(response: Column) -> Column:
    """The object in a response, as a variant: the whole text, or what its outermost braces hold; null if none."""
    text = F.trim(response)
    inner = F.try_parse_json(F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit("")))
    # a parse that fails costs much more than one that succeeds: what can't begin a JSON value is not tried
    found = F.coalesce(F.when(text.rlike(_BEGINS), F.try_parse_json(text)), inner)
    return T.bound(found, lambda v: F.when(F.schema_of_variant(v).startswith("OBJECT"), v))


def _kind(v: Column, path: str) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_variant_get(v, path, "variant")), F.lit("MISSING"))


def _confidence(v: Column) -> Column:
    """The confidence from 0 to 1, 0 if absent; null if it is no such number."""
    number = lambda kind: F.when(kind == "MISSING", F.lit(0.0)).when(kind != "VOID", F.try_variant_get(v, "$.confidence", "double"))
    return T.bound(T.bound(_kind(v, "$.confidence"), number), lambda x: F.when(~F.isnan(x) & x.between(0, 1), x))


def _text(v: Column, name: str) -> Column:
    return T.bound(_kind(v, f"$.{name}"), lambda kind: F.when(kind == "MISSING", F.lit("")).when(kind == "STRING", F.try_variant_get(v, f"$.{name}", "string")))



def read_verdict(response: Column) -> Column:
    """struct<ok, error, valid_sequence, confidence, support_type, linked_techniques, reason, species, is_synthesized, synthesized_line>."""
    return T.bound(json_object(response), _verdict)  # parsed once


def _verdict(v: Column) -> Column:
    support = F.coalesce(F.try_variant_get(v, "$.support_type", "string"), F.lit(""))
    names = T.bound(_kind(v, "$.linked_techniques"), lambda kind: F.when(kind == "MISSING", F.array().cast("array<string>")).when(kind.startswith("ARRAY"), F.try_variant_get(v, "$.linked_techniques", "array<string>")))
    values = F.struct(_confidence(v).alias("confidence"), support.alias("support_type"), names.alias("linked_techniques"), _text(v, "reason").alias("reason"))
    return T.bound(values, lambda x: T.bound(_verdict_error(v, x), lambda error: _verdict_of(v, x, error)))  # each value is read once


def _verdict_error(v: Column, x: Column) -> Column:
    return (
        F.when(v.isNull(), F.lit("no object"))
        .when(_kind(v, "$.valid_sequence") != "BOOLEAN", F.lit("valid_sequence"))
        .when(x["confidence"].isNull(), F.lit("confidence"))
        .when(~x["support_type"].isin(*SUPPORT), F.lit("support_type"))
        .when(x["linked_techniques"].isNull(), F.lit("linked_techniques"))
        .when(x["reason"].isNull(), F.lit("reason"))
    )


def _verdict_of(v: Column, x: Column, error: Column) -> Column:
    made = F.try_variant_get(v, "$.is_synthesized", "boolean")
    return F.struct(
        error.isNull().alias("ok"),
        error.alias("error"),
        F.try_variant_get(v, "$.valid_sequence", "boolean").alias("valid_sequence"),
        *[x[c].alias(c) for c in ("confidence", "support_type", "linked_techniques", "reason")],
        F.nullif(F.try_variant_get(v, "$.species", "string"), F.lit("")).alias("species"),
        F.coalesce(made, F.lit(False)).alias("is_synthesized"),
        F.nullif(F.try_variant_get(v, "$.synthesized_line", "string"), F.lit("")).alias("synthesized_line"),
    )


def _read_confirmation(response: Column, flag: str, extra_error: Callable[[Column], Column | None]) -> Column:
    return T.bound(json_object(response), lambda v: _confirmation(v, flag, extra_error))


def _confirmation(v: Column, flag: str, extra_error: Callable[[Column], Column | None]) -> Column:
    more = extra_error(v)

    def error_of(x: Column) -> Column:
        error = F.when(v.isNull(), F.lit("no object")).when(_kind(v, f"$.{flag}") != "BOOLEAN", F.lit(flag)).when(x["confidence"].isNull(), F.lit("confidence"))
        if more is not None:
            error = error.when(more, F.lit("verified_species"))
        return error.when(x["evidence_line"].isNull(), F.lit("evidence_line")).when(x["reason"].isNull(), F.lit("reason"))

    def read(x: Column, error: Column) -> Column:
        species = [F.try_variant_get(v, "$.verified_species", "string").alias("verified_species")] if more is not None else []
        return F.struct(error.isNull().alias("ok"), error.alias("error"), F.try_variant_get(v, f"$.{flag}", "boolean").alias(flag), x["confidence"].alias("confidence"), *species, x["evidence_line"].alias("evidence_line"), x["reason"].alias("reason"))

    values = F.struct(_confidence(v).alias("confidence"), _text(v, "evidence_line").alias("evidence_line"), _text(v, "reason").alias("reason"))
    return T.bound(values, lambda x: T.bound(error_of(x), lambda error: read(x, error)))


def read_technique(response: Column) -> Column:
    """struct<ok, error, technique_confirmed, confidence, evidence_line, reason>."""
    return _read_confirmation(response, "technique_confirmed", lambda v: None)


def read_species(response: Column) -> Column:
    """struct<ok, error, species_confirmed, confidence, verified_species, evidence_line, reason>."""
    return _read_confirmation(response, "species_confirmed", lambda v: ~_kind(v, "$.verified_species").isin("STRING", "VOID", "MISSING"))


def _object(text: str) -> dict | None:
    """The object in a response: the whole text, or what its outermost braces hold."""
    for part in (text, text[text.find("{") : text.rfind("}") + 1]):
        try:
            value = json.loads(part)
        except ValueError:
            continue
        return value if isinstance(value, dict) else None
    return None


def _number(value) -> float | None:
    """A confidence as a number; None if it is none, or outside 0 to 1."""
    try:
        number = float(value)
    except (TypeError, ValueError):
        return None
    return number if 0 <= number <= 1 else None


def check(text: str, kind: str) -> str | None:
    """The first rule that a response breaks, None if it breaks none: what the readers of responses tell, in the worker.

    kind: sequence, technique, species, or graded for a model that grades evidence.
    """
    value = _object(text.strip())
    if value is None:
        return "no object"
    if kind == "graded":
        given = value.get("confidence", 0.0)
        return None if isinstance(given, int | float | str) and _float(given) is not None else "confidence"
    flag = {"sequence": "valid_sequence", "technique": "technique_confirmed", "species": "species_confirmed"}[kind]
    if not isinstance(value.get(flag), bool):
        return flag
    if _number(value.get("confidence", 0.0)) is None:
        return "confidence"
    if kind == "sequence":
        if value.get("support_type") not in SUPPORT:
            return "support_type"
        if not isinstance(value.get("linked_techniques", []), list):
            return "linked_techniques"
        texts = ["reason"]
    else:
        if kind == "species" and not isinstance(value.get("verified_species"), str | None):
            return "verified_species"
        texts = ["evidence_line", "reason"]
    return next((t for t in texts if not isinstance(value.get(t, ""), str)), None)


def _float(value) -> float | None:
    try:
        number = float(value)
    except ValueError:
        return None
    return None if math.isnan(number) else number


# ------------------------------------------------------------------ prompts


def sequence_prompt() -> Column:
    listed = F.array_join(F.transform(F.arrays_zip("techniques", "technique_lines"), lambda p: F.concat_ws(": ", p["techniques"], p["technique_lines"])), "\n")
    return F.concat_ws(
        "\n",
        F.lit("Decide whether the text reports this amino-acid sequence as an experimentally supported peptide."),
        F.lit('Answer with one JSON object: {"valid_sequence": bool, "confidence": 0..1, "support_type": "strong|moderate|weak|reject", "linked_techniques": [], "reason": "", "species": null, "is_synthesized": bool, "synthesized_line": null}'),
        F.concat(F.lit("Document: "), F.col("pmid")),
        F.concat(F.lit("Sequence: "), F.col("sequence"), F.lit("  Source: "), F.col("source")),
        F.concat(F.lit("Scores: sequence "), F.coalesce(F.col("sequence_score").cast("string"), F.lit("none")), F.lit(", context "), F.coalesce(F.col("bio_score").cast("string"), F.lit("none"))),
        F.concat(F.lit("Techniques found:\n"), listed),
        F.concat(F.lit("Text:\n"), F.substring("context", 1, 1500)),
    )


def graded_prompt(template: list[tuple[str, str]] = GRADED, question: str = QUESTION) -> Column:
    """The prompt of a model that grades evidence: each fact below its label, then the question."""

    def shown(name: str) -> Column:
        if name == "techniques":
            return F.coalesce(F.nullif(F.array_join(name, "\n"), F.lit("")), F.lit("None"))
        return F.format_string("%.3f", F.coalesce(F.col(name), F.lit(0.0))) if name.endswith("_score") else F.coalesce(F.col(name), F.lit(""))

    return F.concat_ws("\n", *[x for label, name in template for x in (F.lit(label), shown(name))], F.lit(question))


def extended_context() -> Column:
    """The context, with the technique sentences below it where there are any."""
    block = F.concat(F.lit("\n\nExtracted Technique Sentences:\n"), F.array_join("technique_lines", "\n"))
    return F.concat(F.col("context"), F.when(F.size("technique_lines") > 0, block).otherwise(F.lit("")))


def technique_prompt(technique: Column, context: Column) -> Column:
    return F.concat_ws("\n", F.lit("Decide whether the text says that this technique was used on a peptide of the study."), F.lit('Answer with one JSON object: {"technique_confirmed": bool, "confidence": 0..1, "evidence_line": "", "reason": ""}'), F.concat(F.lit("Document: "), F.col("pmid")), F.concat(F.lit("Technique: "), technique), F.concat(F.lit("Text:\n"), F.substring(context, 1, 1500)))


def species_prompt(species: Column, context: Column) -> Column:
    return F.concat_ws("\n", F.lit("Decide which plant species the peptides of this document come from."), F.lit('Answer with one JSON object: {"species_confirmed": bool, "confidence": 0..1, "verified_species": null, "evidence_line": "", "reason": ""}'), F.concat(F.lit("Document: "), F.col("pmid")), F.concat(F.lit("Named in it: "), F.array_join(species, ", ")), F.concat(F.lit("Text:\n"), F.substring(context, 1, 4000)))


RECORD = "prompt string, attempt int, response string, error string, ok boolean, runtime double"


def _asked(prompts: DataFrame, load: Callable[[], Model], kind: str, attempts: int, threads: int, last: bool = False) -> DataFrame:
    """A record of each attempt at each prompt (prompt), or of the last alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()

        def one(prompt: str) -> list[tuple]:
            made = []
            for k in range(1, attempts + 1):
                began = time.monotonic()
                try:
                    text, error = model(prompt), None
                except Exception as e:  # counted as an answer that can't be read
                    text, error = "", f"{type(e).__name__}: {e}"
                error = error or check(text, kind)
                made.append((prompt, k, text, error, error is None, time.monotonic() - began))
                if error is None:
                    break
            return made[-1:] if last else made

        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                # a thread takes a few prompts at a time, so that models that answer at once don't wait for threads
                prompts_, few = batch["prompt"].tolist(), max(1, min(64, len(batch) // (8 * threads)))
                parts = pool.map(lambda part: [r for prompt in part for r in one(prompt)], [prompts_[i : i + few] for i in range(0, len(prompts_), few)])
                yield pd.DataFrame([r for own in parts for r in own], columns=RECORD.replace(",", "").split()[::2])

    return prompts.select("prompt").mapInPandas(run, RECORD)


def ask(prompts: DataFrame, load: Callable[[], Model], kind: str, attempts: int, partitions: int = 0, threads: int = 4, journal: str | None = None, together: int = 16, last: bool = False) -> DataFrame:
    """(prompt, attempt, response, error, ok, runtime): a record of each attempt at each distinct prompt, with `last` and no journal of the last attempt alone.

    A bad or failed answer is asked for again, up to `attempts` times. A task waits for
    `threads` answers at a time; partitions sets how many tasks ask. With a journal, a
    folder, prompts that it doesn't hold are added to it in `partitions` files, files are
    asked `together` at a time, and each such batch is recorded before the next: a run that
    fails repeats one batch at most, and prompts that were answered are never asked again.
    """
    each = prompts.select("prompt").where("prompt is not null").distinct()
    if journal is None:
        return _asked(each.repartition(partitions) if partitions else each, load, kind, attempts, threads, last)
    spark, waiting, records = each.sparkSession, f"{journal}/prompts", f"{journal}/records"
    new = each
    if incremental.exists(spark, waiting):
        new = each.join(spark.read.schema("prompt string").parquet(waiting), "prompt", "left_anti")
    (new.repartition(partitions) if partitions else new).write.mode("append").parquet(waiting)
    incremental.write_new(spark, "prompt string", waiting, f"{journal}/checkpoint", lambda batch: {records: _asked(batch, load, kind, attempts, threads)}, files=together).awaitTermination()
    return spark.read.schema(RECORD).parquet(records).join(each, "prompt", "left_semi")


def answers(records: DataFrame) -> DataFrame:
    """The record of each prompt that counts: the attempt that was right, else the last."""
    last = F.max_by(F.struct(*[c for c in records.columns if c != "prompt"]), "attempt")
    return records.groupBy("prompt").agg(last.alias("_a")).select("prompt", "_a.*")


# ------------------------------------------------------------------ passes


def passes_scores() -> Column:
    """Null scores pass."""
    return ~F.coalesce(F.col("sequence_score") < LEAST_SCORE, F.lit(False)) & ~F.coalesce(F.col("bio_score") < LEAST_SCORE, F.lit(False))


def final_validity(valid: Column) -> Column:
    return F.coalesce(valid, F.lit(False)) & passes_scores()


def _key() -> Column:
    """What tells a prompt: 128 bits of its text, which is long."""
    return F.unhex(F.md5("prompt")).alias("_prompt")


def audit(asked: DataFrame, found: DataFrame, kind: str, flag: str) -> DataFrame:
    """The record of each question asked: who asked (pmid, sequence or technique), prompt, answer, what was read from it, attempt and time."""
    who = [F.col(c) if c in asked.columns else F.lit(None).cast("string").alias(c) for c in ("pmid", "sequence", "technique")]
    joined = asked.select(_key(), "prompt", *who).join(found, "_prompt")
    name = F.lit(f"{kind}_verification") if kind == "sequence" else F.when(F.col("ok"), f"{kind}_verification").otherwise(f"{kind}_verification_error")
    parsed = F.when(F.col("ok"), F.to_json("_v"))
    return joined.select(name.alias("type"), "pmid", "sequence", "technique", F.sha2("prompt", 256).alias("prompt_id"), "prompt", F.col("response").alias("raw_response"), parsed.alias("parsed"), F.coalesce(F.col("ok") & F.col(f"_v.{flag}"), F.lit(False)).alias("verification_result"), F.col("ok").alias("parse_ok"), "attempt", "runtime", "error")


def verify(candidates: DataFrame, documents: DataFrame, load: Callable[[], Model], save: Callable[[DataFrame, str], DataFrame], key: str = "pmid", graded: bool = False, journal: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(verified candidates, audit log).

    candidates: id, pmid, sequence, sequence_line, source, context, techniques,
    technique_lines, evidence_score, sequence_score, bio_score, and key; documents: key
    (a document's own, one row each), species, head. save(frame, name) writes a frame and
    reads it back: a model is asked once, whatever runs again later. graded: the model
    judges sequences by grading evidence. journal: a folder in which answers stay from
    run to run.
    """

    def answered(asked: DataFrame, kind: str, attempts: int, name: str, read: Callable[[Column], Column]) -> DataFrame:
        """The answer to each prompt with what is read from it (_v), read once and stored by the prompt's key."""
        records = ask(asked, load, kind, attempts, journal=journal and f"{journal}/{name}", last=True)
        counted = answers(records) if journal else records  # a task has all attempts at its prompts, and hands on the last
        return save(counted.select(_key(), *[c for c in counted.columns if c != "prompt"], read(F.col("response")).alias("_v")), name)

    def told_by(asked: DataFrame, found: DataFrame, columns: list, name: str) -> DataFrame:
        return asked.select(*columns, _key()).join(found.select("_prompt", F.col("_v").alias(name)), "_prompt").drop("_prompt")

    possible = candidates.where(passes_scores())
    if graded:
        first_named = documents.select(F.col(key).alias("_key"), F.get("species", F.lit(0)).alias("_species"))
        possible = possible.join(first_named, F.col(key) == F.col("_key"), "left").withColumn("_species", F.coalesce("_species", F.lit("unknown")))
        possible = possible.withColumn("prompt", graded_prompt()).drop("_key", "_species")
    else:
        possible = possible.withColumn("prompt", sequence_prompt())
    first = answered(possible, "graded" if graded else "sequence", 3, "sequence", read_graded if graded else read_verdict)
    judged = told_by(possible, first.where(F.col("_v.ok") & F.col("_v.valid_sequence")), candidates.columns, "v")
    valid = save(judged, "valid")

    each = valid.select("id", "pmid", F.posexplode("techniques").alias("no", "technique"), extended_context().alias("_text"))
    each = each.withColumn("prompt", technique_prompt(F.col("technique"), F.col("_text")))
    second = answered(each, "technique", 2, "technique", read_technique)
    sure = told_by(each, second, ["id", "no", "technique"], "t")
    sure = sure.where(F.col("t.ok") & F.col("t.technique_confirmed") & (F.col("t.confidence") >= LEAST_TECHNIQUE))
    kept = sure.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("no", "technique", F.round("t.confidence", 4).alias("score"), F.col("t.evidence_line").alias("line")))).alias("ts"))

    with_docs = valid.join(documents.select(key, F.col("species").alias("found"), "head"), key, "left")
    named = F.coalesce("found", F.array().cast("array<string>"))
    llm = F.when(F.lower("v.species") != "null", F.col("v.species"))
    species = F.when(llm.isNull() | F.array_contains(named, llm), named).otherwise(F.array_append(named, llm))
    asked = with_docs.select("id", "pmid", species.alias("species"), F.coalesce(F.nullif(F.col("head"), F.lit("")), extended_context()).alias("_text"))
    asked = asked.where((F.size("species") > 0) | (F.col("_text") != "")).withColumn("prompt", species_prompt(F.col("species"), F.col("_text")))
    third = answered(asked, "species", 2, "species", read_species)
    told = told_by(asked, third, ["id"], "s").where(F.col("s.ok") & F.col("s.species_confirmed")).select("id", "s")

    none = F.array()
    out = valid.join(kept, "id", "left").join(told, "id", "left").select(
        "id", "pmid", "sequence", "sequence_line", F.col("v.confidence").alias("sequence_confidence"), F.col("v.support_type").alias("support_type"), F.col("v.reason").alias("reason"),
        F.coalesce(F.transform("ts", lambda t: t["technique"]), none.cast("array<string>")).alias("verified_techniques"),
        F.coalesce(F.transform("ts", lambda t: t["score"]), none.cast("array<double>")).alias("technique_scores"),
        F.coalesce(F.transform("ts", lambda t: t["line"]), none.cast("array<string>")).alias("technique_evidence_lines"),
        F.col("s.verified_species").alias("verified_species"), F.coalesce(F.round("s.confidence", 4), F.lit(0.0)).alias("species_confidence"), F.coalesce("s.evidence_line", F.lit("")).alias("species_evidence_line"),
        "evidence_score", "context", "bio_score", "sequence_score", F.lit(True).alias("is_valid"), F.col("v.is_synthesized").alias("is_synthesized"), F.col("v.synthesized_line").alias("synthesized_line"),
    )
    logs = [audit(possible, first, "sequence", "valid_sequence"), audit(each, second, "technique", "technique_confirmed"), audit(asked, third, "species", "species_confirmed")]
    return out, functools.reduce(DataFrame.unionByName, logs)


def with_synthesized(rows: DataFrame) -> DataFrame:
    """Verified rows with the marker technique `synthesized` where it applies and isn't there yet."""
    mark = F.coalesce("is_synthesized", F.lit(False)) & ~F.array_contains("verified_techniques", "synthesized")
    add = lambda c, v: F.when(mark, F.array_append(c, v)).otherwise(F.col(c)).alias(c)
    new = {"verified_techniques": F.lit("synthesized"), "technique_scores": F.lit(1.0), "technique_evidence_lines": F.coalesce("synthesized_line", F.lit(""))}
    return rows.select(*[add(c, new[c]) if c in new else F.col(c) for c in rows.columns])


def label_from_strength(strength: Column) -> Column:
    """Support of a model that grades evidence: High, Medium, Low, anything else."""
    return F.when(strength == "High", "strong").when(strength == "Medium", "moderate").when(strength == "Low", "weak").otherwise("reject")


def read_graded(response: Column) -> Column:
    """The verdict of a model that answers with verified, confidence, evidence_strength and reason."""
    return T.bound(json_object(response), _graded)


def _graded(v: Column) -> Column:
    number = lambda kind: F.when(kind == "MISSING", F.lit(0.0)).when(kind != "VOID", F.try_variant_get(v, "$.confidence", "double"))
    value = F.coalesce(F.try_variant_get(v, "$.verified", "boolean"), F.try_variant_get(v, "$.valid_sequence", "boolean"), F.lit(False))
    reason = F.coalesce(F.try_variant_get(v, "$.reason", "string"), F.lit(""))

    def read(x: Column) -> Column:
        error = F.when(v.isNull(), F.lit("no object")).when(x["confidence"].isNull() | F.isnan(x["confidence"]), F.lit("confidence"))
        low = F.lower(x["reason"])
        return F.struct(
            error.isNull().alias("ok"),
            error.alias("error"),
            value.alias("valid_sequence"),
            x["confidence"].alias("confidence"),
            label_from_strength(F.try_variant_get(v, "$.evidence_strength", "string")).alias("support_type"),
            F.array().cast("array<string>").alias("linked_techniques"),
            x["reason"].alias("reason"),
            F.try_variant_get(v, "$.species", "string").alias("species"),
            (low.contains("synthesize") | low.contains("synthetic")).alias("is_synthesized"),
            F.lit(None).cast("string").alias("synthesized_line"),
        )

    return T.bound(F.struct(T.bound(_kind(v, "$.confidence"), number).alias("confidence"), reason.alias("reason")), read)
