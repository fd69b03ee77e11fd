from __future__ import annotations

import itertools
import json

import pytest
from pyspark.sql import functions as F

from sievework.operators import verification

#: A right answer of each kind, and values that break a rule.
RIGHT = {
    "sequence": {"valid_sequence": True, "confidence": 0.5, "support_type": "weak", "linked_techniques": ["NMR"], "reason": "r"},
    "technique": {"technique_confirmed": True, "confidence": 0.5, "evidence_line": "e", "reason": "r"},
    "species": {"species_confirmed": False, "confidence": 0.5, "verified_species": "Zea mays", "evidence_line": "e", "reason": "r"},
    "graded": {"verified": True, "confidence": 0.5, "evidence_strength": "High", "reason": "r"},
}
READ = {"sequence": verification.read_verdict, "technique": verification.read_technique, "species": verification.read_species, "graded": verification.read_graded}
VALUES = [True, 1, 0.3, 1.5, -0.1, "0.4", "x", "", None, [], {}, ["a"], "strong", "High"]


@pytest.mark.parametrize("kind", sorted(RIGHT))
def test_the_worker_checks_what_readers_read(spark, kind):
    made = [RIGHT[kind]]
    for name in RIGHT[kind]:
        made += [RIGHT[kind] | {name: v} for v in VALUES] + [{k: v for k, v in RIGHT[kind].items() if k != name}]
    texts = [json.dumps(x) for x in made] + ["", "none", "[1]", "3", "x {} y", "{", "} {", 'so: {"a": {"b": 1}} end', "so: " + json.dumps(RIGHT[kind]) + " ok?"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", READ[kind](F.col("t")).alias("v")).collect()
    told = {r.i: r.v.error for r in rows}
    assert [told[i] for i in range(len(texts))] == [verification.check(t, kind) for t in texts]
    assert sum(e is None for e in told.values()) > 5 and len(set(told.values())) > 2


@pytest.mark.parametrize("kind", sorted(RIGHT))
def test_each_broken_rule_is_asked_again(spark, kind):
    """The first answer breaks one rule, the second is right: two attempts, and the right one counts."""
    broken = [(k, v) for k in RIGHT[kind] for v in VALUES if verification.check(json.dumps(RIGHT[kind] | {k: v}), kind)]
    prompts = spark.createDataFrame([(f"{k}|{json.dumps(v)}",) for k, v in broken], "prompt string")
    right = RIGHT[kind]

    def load():
        asked = {}

        def model(prompt):
            asked[prompt] = asked.get(prompt, 0) + 1
            name, value = prompt.split("|")
            return json.dumps(right | {name: json.loads(value)} if asked[prompt] == 1 else right)

        return model

    records = verification.ask(prompts, load, kind, 3).collect()
    assert sorted((r.attempt, r.ok) for r in records) == [(1, False)] * len(broken) + [(2, True)] * len(broken)
    final = verification.answers(spark.createDataFrame(records)).collect()
    assert all(r.ok and r.attempt == 2 and json.loads(r.response) == right and r.runtime >= 0 for r in final) and len(final) == len(broken)


class Lost(BaseException):
    """Not an answer that failed: the worker is gone."""


def test_a_journal_keeps_what_was_answered(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    prompts = spark.createDataFrame([(f"p{i:02d}",) for i in range(40)], "prompt string")

    def load(lost: str | None):
        def make():
            def model(prompt):
                if prompt == lost:
                    raise SystemExit(1)
                with open(calls / prompt, "a") as f:
                    f.write("x")
                if prompt.endswith("9"):
                    raise ValueError("no server")
                return json.dumps(RIGHT["technique"]) if not prompt.endswith("5") else "garbage"

            return model

        return make

    journal = str(tmp_path / "journal")
    ask = lambda rows, lost=None: verification.ask(rows, load(lost), "technique", 2, partitions=10, threads=1, journal=journal, together=1)
    with pytest.raises(Exception):  # noqa: B017
        ask(prompts, "p17").collect()
    before = {p.name: len(p.read_text()) for p in calls.iterdir()}
    done = {r.prompt for r in spark.read.schema(verification.RECORD).parquet(f"{journal}/records").collect()} if (tmp_path / "journal/records").exists() else set()
    records = ask(prompts).collect()
    assert sorted({r.prompt for r in records}) == [f"p{i:02d}" for i in range(40)]
    wanted = [(f"p{i:02d}", a) for i in range(40) for a in range(1, 3 if i % 10 in (5, 9) else 2)]
    assert sorted((r.prompt, r.attempt) for r in records) == wanted  # each attempt once, by prompt and number
    assert {r.error for r in records if not r.ok} == {"no object", "ValueError: no server"}
    after = {p.name: len(p.read_text()) for p in calls.iterdir()}
    assert all(after[p] == before[p] for p in done)  # what had a record was not asked again
    ask(prompts).collect()
    more = prompts.union(spark.createDataFrame([("p50",), (None,)], "prompt string"))
    assert {r.prompt for r in ask(more).collect()} == {*[f"p{i:02d}" for i in range(40)], "p50"}
    assert {p.name: len(p.read_text()) for p in calls.iterdir()} == after | {"p50": 1}
    assert {r.prompt for r in ask(more.where("prompt = 'p50'")).collect()} == {"p50"}


SCHEMA = "id string, pmid string, sequence string, sequence_line string, source string, context string, techniques array<string>, technique_lines array<string>, evidence_score double, sequence_score double, bio_score double"


def test_audit_tells_who_asked_and_what_came(spark, tmp_path):
    rows = [("1", "7", "MKTLLV", "l", "csv", "c", ["NMR", "HPLC"], ["n", "h"], 6.0, 0.9, None), ("2", "8", "ACDEFG", "l", "csv", "d", [], [], 1.0, None, 0.9)]
    docs = spark.createDataFrame([("7", ["Zea mays"], "head"), ("8", [], "")], "pmid string, species array<string>, head string")
    numbers = itertools.count()

    def load():
        def model(prompt):
            if "Named in it" in prompt:
                return '{"species_confirmed": true, "confidence": 2}'
            if "Technique: NMR" in prompt:
                return json.dumps(RIGHT["technique"])
            if "Technique: " in prompt:
                raise OSError("down")
            return json.dumps(RIGHT["sequence"]) if "MKTLLV" in prompt else "garbage"

        return model

    def save(frame, name):
        path = str(tmp_path / f"{name}{next(numbers)}")
        frame.write.parquet(path)
        return spark.read.parquet(path)

    for journal in (None, str(tmp_path / "journal")):
        verified, log = verification.verify(spark.createDataFrame(rows, SCHEMA), docs, load, save, journal=journal)
        assert [r.verified_techniques for r in verified.collect()] == [["NMR"]]
        got = {(r.type, r.pmid, r.sequence, r.technique): r for r in log.collect()}
        assert sorted(got, key=str) == sorted([("sequence_verification", "7", "MKTLLV", None), ("sequence_verification", "8", "ACDEFG", None), ("technique_verification", "7", None, "NMR"), ("technique_verification_error", "7", None, "HPLC"), ("species_verification_error", "7", None, None)], key=str)
        good, bad = got["sequence_verification", "7", "MKTLLV", None], got["sequence_verification", "8", "ACDEFG", None]
        assert good.parse_ok and good.verification_result and good.attempt == 1 and json.loads(good.parsed)["support_type"] == "weak" and good.error is None and good.runtime >= 0
        assert not bad.parse_ok and not bad.verification_result and bad.attempt == 3 and bad.parsed is None and bad.error == "no object" and bad.raw_response == "garbage"
        assert got["technique_verification_error", "7", None, "HPLC"].error == "OSError: down"
        assert got["species_verification_error", "7", None, None].error == "confidence"


def test_graded_prompt_names_the_species(spark, tmp_path):
    rows = [("1", "7", "MKTLLV", "l", "csv", "c", ["NMR"], ["n"], 6.0, 0.91234, None), ("2", "8", "ACDEFG", "l", "csv", "c", [], [], 1.0, None, 0.9), ("3", "9", "WWWWWW", "l", "csv", "c", [], [], 1.0, None, None)]
    docs = spark.createDataFrame([("7", ["Zea mays", "x"], "head"), ("8", [], "")], "pmid string, species array<string>, head string")
    numbers = itertools.count()

    def save(frame, name):
        path = str(tmp_path / f"{name}{next(numbers)}")
        frame.write.parquet(path)
        return spark.read.parquet(path)

    _, log = verification.verify(spark.createDataFrame(rows, SCHEMA), docs, lambda: lambda prompt: "no", save, graded=True)
    prompts = {r.pmid: r.prompt for r in log.collect()}
    assert prompts["7"].startswith("Sequence\nMKTLLV\nSpecies\nZea mays\nSequence Score\n0.912\nBio Score\n0.000\nEvidence Score\n6.000\nDetected Techniques\nNMR\nContext\nc\nQuestion\n")
    assert "Species\nunknown\n" in prompts["8"] and "Species\nunknown\n" in prompts["9"] and "Detected Techniques\nNone\n" in prompts["8"]


@pytest.mark.parametrize("kind", sorted(READ))
def test_each_value_of_a_response_is_read_once(spark, kind):
    """As often as it is named in a rule or a result at most; conditions and results don't repeat what they hang on."""
    plan = spark.range(1).select(READ[kind](F.lit("{}")).alias("v"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("variant_get(") <= 14


def test_prompts_are_not_joined_by_their_text(spark, tmp_path):
    schema = "id string, pmid string, sequence string, sequence_line string, source string, context string, techniques array<string>, technique_lines array<string>, evidence_score double, sequence_score double, bio_score double"
    rows = spark.createDataFrame([(str(i), "7", "ACDEFG" + "W" * (i % 3), "l", "csv", "c", ["NMR"], ["n"], 6.0, 0.9, None) for i in range(9)], schema)
    docs = spark.createDataFrame([("7", ["Zea mays"], "head")], "pmid string, species array<string>, head string")
    stored = {}

    def save(frame, name):
        frame.write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
        return stored[name]

    answer = json.dumps(RIGHT["sequence"] | RIGHT["technique"] | RIGHT["species"] | {"species_confirmed": True})
    out, log = verification.verify(rows, docs, lambda: lambda prompt: "no" if "WW" in prompt else answer, save)
    assert sorted(r.id for r in out.collect()) == ["0", "1", "3", "4", "6", "7"]
    assert sorted(r.attempt for r in stored["sequence"].collect()) == [1, 1, 3]
    for name in ("sequence", "technique", "species"):
        assert "prompt" not in stored[name].columns and {len(r._prompt) for r in stored[name].collect()} == {16}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "variant_get" not in plan  # answers were read when they were stored
    assert all(len(r.prompt) > 100 and r.parsed for r in log.where("parse_ok").collect())
