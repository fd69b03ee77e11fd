from __future__ import annotations

import json
import logging
import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from jobs import candidate_catalogue, evidence_ledger
from jobs import registry as jobs
from jobs.common import config_of

from . import oracle

ROOT = Path(__file__).resolve().parent.parent
SF, LARGE = "/root/testdata/sf0.001", "/root/testdata/sf0.1"
WORDS = "the peptide MKTLLVWAR was isolated. By Edman degradation it is QWERTYWHK. "


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(jobs.QUERIES))
def test_jobs_match_sql(spark, name):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    oracle.assert_same(jobs.QUERIES[name](spark, SF), oracle.connect(SF), jobs.ORACLE_SQL[name])
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


@pytest.mark.skipif(not os.path.isdir(LARGE), reason="no larger tables")
def test_catalogue_of_larger_tables(spark):
    """References in several languages: only A to Z count in either case."""
    name = "job1_candidate_catalogue"
    oracle.assert_same(jobs.QUERIES[name](spark, LARGE), oracle.connect(LARGE), jobs.ORACLE_SQL[name])


def test_jobs_do_not_need_the_other_parts():
    code = "import sys; import jobs.registry; assert not [m for m in sys.modules if m.startswith('sievework.llm') or m == 'corpus_pipeline']"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


# ------------------------------------------------------------------ catalogue

DOCS = [(1, WORDS, "en"), (2, WORDS + "Zea mays gave SYNPEPTIDEK.", "de"), (3, None, "en"), (4, "", "de"), (5, "no sequence here", None), (6, WORDS * 3, None)]


def _docs(spark, path, rows):
    spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1).write.mode("append").parquet(str(path))


@pytest.fixture
def papers(spark, tmp_path):
    _docs(spark, tmp_path / "docs", DOCS)
    spark.createDataFrame([("seen: MKTLLVWAR",), (None,)], "text string").write.parquet(str(tmp_path / "refs"))
    return tmp_path


PLAIN = {"id": "doc_id", "text": "text", "partition": "lang"}


def _rows(frame):
    return sorted(map(tuple, frame.select("doc_id", "sequence", "lang", "rank", "known", F.array_join("species", "|"), F.array_join("techniques", "|"), "evidence_score").collect()), key=repr)


def _run(spark, root, **more):
    return candidate_catalogue.run(spark, str(root / "docs"), str(root / "refs"), str(root / "out"), PLAIN | more)


def test_catalogue_twice_is_the_same(spark, papers, caplog):
    with caplog.at_level(logging.INFO):
        once = _rows(_run(spark, papers))
    assert "read 6 documents" in caplog.text and "lang=de holds 3 candidates, 1 of them known" in caplog.text
    assert _rows(_run(spark, papers)) == once
    assert {(d, s, k) for d, s, _, _, k, *_ in once} == {(1, "MKTLLVWAR", True), (1, "QWERTYWHK", False), (2, "MKTLLVWAR", True), (2, "QWERTYWHK", False), (2, "SYNPEPTIDEK", False), (6, "MKTLLVWAR", True), (6, "QWERTYWHK", False)}
    assert all(t == "Edman Sequencing" and e == 5.0 for *_, t, e in once)
    assert {s for d, _, _, _, _, s, *_ in once if d == 2} == {"Zea mays (maize)"}
    assert sorted(p.name for p in (papers / "out").iterdir() if p.is_dir()) == ["lang=__HIVE_DEFAULT_PARTITION__", "lang=de", "lang=en"]


def test_catalogue_of_some_partitions_leaves_the_others(spark, papers):
    _run(spark, papers)
    _docs(spark, papers / "docs", [(7, WORDS, "de"), (8, WORDS, "en")])
    assert {r[0] for r in _rows(_run(spark, papers, only=["de"]))} == {1, 2, 6, 7}
    assert {r[0] for r in _rows(_run(spark, papers, skip_done=True))} == {1, 2, 6, 7}
    _docs(spark, papers / "docs", [(9, WORDS, "fr")])
    assert {r[0] for r in _rows(_run(spark, papers, skip_done=True))} == {1, 2, 6, 7, 9}
    assert {r[0] for r in _rows(_run(spark, papers))} == {1, 2, 6, 7, 8, 9}


def test_catalogue_that_fails_leaves_the_last_result(spark, papers, monkeypatch):
    once = _rows(_run(spark, papers))

    def broken(references, text):
        return references.select(F.raise_error(F.lit("broken")).cast("string").alias("sequence"), F.lit(True).alias("known"))

    monkeypatch.setattr(candidate_catalogue, "known_sequences", broken)
    with pytest.raises(Exception, match="broken"):
        _run(spark, papers)
    monkeypatch.undo()
    assert _rows(spark.read.parquet(str(papers / "out"))) == once


def test_catalogue_of_nothing(spark, tmp_path):
    _docs(spark, tmp_path / "docs", [])
    spark.createDataFrame([], "text string").write.parquet(str(tmp_path / "refs"))
    assert _run(spark, tmp_path).count() == 0


# ------------------------------------------------------------------ ledger

LEDGER = {"id": "doc_id", "text": "text", "keep": ["lang"], "files": 1, "techniques": {"Alpha": [r"\balpha\b"], "Beta": [r"\bbeta\b"]}}


def _ledger(spark, root, **more):
    return sorted(map(tuple, evidence_ledger.run(spark, str(root / "docs"), str(root / "out"), str(root / "mark"), LEDGER | more).select("doc_id", "lang", "technique", "statement").collect()))


def _summary(spark, root):
    return {r.technique: (r.documents, r.statements) for r in spark.read.parquet(str(root / "out/summary")).collect()}


def test_ledger_takes_what_is_new(spark, tmp_path, caplog):
    _docs(spark, tmp_path / "docs", [(1, "An alpha. A beta! No", "en"), (2, None, "en"), (3, "nothing", "de")])
    first = [(1, "en", "Alpha", "An alpha."), (1, "en", "Beta", "A beta!")]
    assert _ledger(spark, tmp_path) == first and _summary(spark, tmp_path) == {"Alpha": (1, 1), "Beta": (1, 1)}
    with caplog.at_level(logging.INFO):
        assert _ledger(spark, tmp_path) == first
    assert "read 0 new documents" in caplog.text
    _docs(spark, tmp_path / "docs", [(4, "alpha and beta. alpha and beta.", "de"), (None, "alpha", "de")])
    _docs(spark, tmp_path / "docs", [(5, "More alpha. éalpha", "fr")])
    grown = sorted([*first, (4, "de", "Alpha", "alpha and beta."), (4, "de", "Beta", "alpha and beta."), (5, "fr", "Alpha", "More alpha.")])
    caplog.clear()
    with caplog.at_level(logging.INFO):
        assert _ledger(spark, tmp_path) == grown
    assert "read 2 new documents in 2 batches" in caplog.text
    assert _summary(spark, tmp_path) == {"Alpha": (3, 3), "Beta": (2, 2)}


def test_document_that_arrives_again_takes_its_place(spark, tmp_path):
    _docs(spark, tmp_path / "docs", [(1, "An alpha.", "en"), (2, "A beta.", "en")])
    _ledger(spark, tmp_path)
    _docs(spark, tmp_path / "docs", [(1, "Now a beta.", "en"), (2, "nothing any more", "en")])
    assert _ledger(spark, tmp_path) == [(1, "en", "Beta", "Now a beta.")]
    assert _summary(spark, tmp_path) == {"Beta": (1, 1)}


def test_batch_that_fails_is_taken_again(spark, tmp_path, monkeypatch):
    _docs(spark, tmp_path / "docs", [(1, "An alpha.", "en")])
    before = _ledger(spark, tmp_path)
    _docs(spark, tmp_path / "docs", [(2, "A beta.", "en")])
    whole = evidence_ledger._tables(str(tmp_path / "out"))
    made = evidence_ledger.incremental.write_new

    def broken(spark_, schema, source, checkpoint, tables, by, files):
        def some(batch):
            out = tables(batch)
            return {whole[0]: out[whole[0]], whole[1]: out[whole[1]].select(F.raise_error(F.lit("lost")).alias("doc_id"), "lang")}

        return made(spark_, schema, source, checkpoint, some, by, files)

    monkeypatch.setattr(evidence_ledger.incremental, "write_new", broken)
    with pytest.raises(Exception, match="lost"):
        _ledger(spark, tmp_path)
    monkeypatch.undo()
    assert evidence_ledger.current(spark, str(tmp_path / "out"), spark.read.parquet(str(tmp_path / "docs")).schema, LEDGER).count() == len(before)
    assert _ledger(spark, tmp_path) == [*before, (2, "en", "Beta", "A beta.")]


def test_ledger_of_no_documents(spark, tmp_path):
    _docs(spark, tmp_path / "docs", [])
    assert _ledger(spark, tmp_path) == []


# ------------------------------------------------------------------ command lines


def _command(job: str, **given) -> None:
    env = os.environ | {"SPARK_LOCAL_IP": "127.0.0.1"}
    args = [x for name, value in given.items() for x in (f"--{name}", str(value))]
    subprocess.run([sys.executable, str(ROOT / "jobs" / f"{job}.py"), *args], check=True, env=env, capture_output=True, timeout=300)


def test_command_lines(spark, papers):
    (papers / "plain.json").write_text(json.dumps(PLAIN))
    _command("candidate_catalogue", documents=papers / "docs", references=papers / "refs", output=papers / "out", config=papers / "plain.json")
    assert _rows(spark.read.parquet(str(papers / "out"))) == _rows(_run(spark, papers))
    _command("evidence_ledger", documents=papers / "docs", output=papers / "ledger", checkpoint=papers / "mark")
    assert config_of(None, evidence_ledger.CONFIG)["techniques"]
    assert spark.read.parquet(str(papers / "ledger/documents")).count() == 6
