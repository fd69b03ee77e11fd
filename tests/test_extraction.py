from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from sievework.operators import merging
from sievework.operators import evaluation
from sievework.plans import extraction
from sievework.sources import readers, writers

PAGE = """PMID: 123
The peptide MKTLLVWC-
DEAAK was sequenced by Edman degradation in soybean.
Abbreviations: QWERTYWK, keyboard; X, y

1 ACDEFG 6
7 HIKLMN
Peptide table
name  RSTVWYACD  4
References
The peptide NNNQQQRRRKK is cited."""


def test_papers_to_verified_result(spark, tmp_path):
    def save(frame, name):
        frame.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    (tmp_path / "supp").mkdir()
    (tmp_path / "supp/123_s1.csv").write_text("name,seq\npeptide,WWKKLLMMNN\npeptide,MKTLLVWCDEAAK\n")
    pages = spark.createDataFrame([("p/a.pdf", 1, PAGE), ("p/77.pdf", 1, "nothing here"), ("p/77.pdf", 2, "peptide ACDEFGHIKK")], "path string, page int, text string")
    ocr = spark.createDataFrame([("p/a.pdf", 1, 1, "the peptide MKTLLVWCDEAAK and peptide GGHH1LLKKW")], "path string, page int, img_no int, text string")
    stages = extraction.prepare(pages, ocr, readers.supplementary(spark, str(tmp_path / "supp")), save)
    assert {(r.path, r.pmid) for r in stages["documents"].collect()} == {("p/a.pdf", "123"), ("p/77.pdf", "77")}
    main = {(r.path, r.sequence): r for r in stages["candidates"].collect()}
    assert {s for p, s in main if p == "p/a.pdf"} == {"MKTLLVWCDEAAK", "ACDEFGHIKLMN", "RSTVWYACD", "GGHHLLKKW"}
    assert {s for p, s in main if p == "p/77.pdf"} == {"ACDEFGHIKK"}
    merged = {(r.path, r.sequence): r for r in stages["merged"].collect()}
    assert ("p/a.pdf", "WWKKLLMMNN") in merged and len(merged) == len(main) + 1
    assert {r.technique for r in stages["techniques"].collect()} == {"Edman Sequencing"}
    assert stages["evidence"].count() == len(merged)

    def model():
        def answer(prompt):
            if "Named in it" in prompt:
                return json.dumps({"species_confirmed": True, "confidence": 0.9, "verified_species": "Glycine max (soybean)"})
            if "Technique:" in prompt:
                return json.dumps({"technique_confirmed": True, "confidence": 0.9, "evidence_line": "line"})
            return json.dumps({"valid_sequence": "WWKK" not in prompt, "confidence": 0.95, "support_type": "strong", "is_synthesized": False})

        return answer

    refs = spark.createDataFrame([("MKTLLVWCDEAAK",), ("ACDEFGHIKLMN",), ("WWKKLLMMNN",)], "seq string")
    gold = spark.createDataFrame([("123", "MKTLLVWCDEAAK")], "pmid string, sequence string")
    result, log = extraction.run(stages, refs, model, save, lambda: lambda texts: [[1.0, 0.0] for _ in texts], gold=gold)
    rows = {(r.PMID, r.Sequence): r for r in result.collect()}
    assert rows["123", "MKTLLVWCDEAAK"].Gold_Standard_Match == "True" and rows["123", "MKTLLVWCDEAAK"].Species == "Glycine max (soybean)"
    assert "Edman Sequencing" in rows["123", "MKTLLVWCDEAAK"].Techniques
    assert ("123", "WWKKLLMMNN") not in rows and len(result.columns) == 13
    assert {r.type for r in log.collect()} >= {"sequence_verification", "species_verification"}
    writers.csv(result, str(tmp_path / "out"), one_file=True)
    back = readers.verified_csv(spark, str(tmp_path / "out"))
    counts = evaluation.confusion(evaluation.gold_pairs(back, "PMID", "Sequence"), evaluation.gold_pairs(gold))
    assert {r.pmid: (r.tp, r.fn) for r in counts.collect()}["123"] == (1, 0)


def test_prefixes_of_many_lengths(spark):
    keys = spark.createDataFrame([("é" * n,) for n in range(1, 301)] + [("b",), (None,)], "key string")
    files = spark.createDataFrame([("é" * 299 + ".csv",), ("b.csv",), ("é.csv",), ("c",), ("",), (None,)], "name string")
    got = [(r.name, r.key) for r in merging.join_by_prefix(files, keys, "name", "key").collect()]
    assert sorted(got) == sorted([("é" * 299 + ".csv", "é" * n) for n in range(1, 300)] + [("b.csv", "b"), ("é.csv", "é")])


def test_folders_to_all_outputs(spark, tmp_path):
    """Text files stand for papers, their pages parted by form feeds, lines that begin with # for images."""
    papers, calls = tmp_path / "papers", tmp_path / "calls"
    papers.mkdir()
    (tmp_path / "supp").mkdir()
    calls.touch()
    (papers / "a.pdf").write_text(PAGE + "\f#the peptide GGHHKLLKKW is here")
    (papers / "77.PDF").write_text("nothing here\fpeptide ACDEFGHIKK")
    (papers / "bad.pdf").write_bytes(b"\xff")
    (papers / "note.txt").write_text("peptide WWWWKKKKLLLL")
    (tmp_path / "supp/123_s1.csv").write_text("name,seq\npeptide,WWKKLLMMNN\n")
    (tmp_path / "refs.fasta").write_text(">r1\nMKTLLVWCDEAAK\n>r2\nACDEFGHIKLMN\n>r3\nWWKKLLMMNN\n")
    (tmp_path / "gold.json").write_text(json.dumps([{"pmid": "123", "sequence": "MKTLLVWCDEAAK"}, {"pmid": "123", "sequence": "CCCCCCC"}]))

    def called(what):
        with open(calls, "a") as f:
            f.write(f"{what}\n")

    def parse(content):
        called("parse")
        return [(i, p) for i, p in enumerate(content.decode().split("\f"), 1) if not p.startswith("#")]

    def images(content):
        return [(i, 1, p[1:].encode()) for i, p in enumerate(content.decode().split("\f"), 1) if p.startswith("#")]

    def read(image):
        called("read")
        return image.decode()

    def model(lost=False):
        def load():
            def answer(prompt):
                called("ask")
                if "Named in it" in prompt:
                    if lost:
                        raise SystemExit(1)
                    return json.dumps({"species_confirmed": True, "confidence": 0.9, "verified_species": "Glycine max (soybean)"})
                if "Technique:" in prompt:
                    return json.dumps({"technique_confirmed": True, "confidence": 0.9, "evidence_line": "line"})
                return json.dumps({"valid_sequence": True, "confidence": 0.95, "support_type": "strong"})

            return answer

        return load

    def go(lost=False):
        return extraction.run_folders(spark, str(papers), str(tmp_path / "out"), str(tmp_path / "supp"), parse, images, read, references=str(tmp_path / "refs.fasta"), model=model(lost), gold=str(tmp_path / "gold.json"))

    with pytest.raises(Exception):  # noqa: B017  the model's machine is gone in the last pass
        go(lost=True)
    asked = calls.read_text().split().count("ask")
    out = go()
    assert set(out) >= {"pages", "images", "ocr", "documents", "techniques", "candidates", "supplementary", "merged", "evidence", "chunks", "metadata", "result", "audit", "metrics"}
    stem = lambda path: path.rsplit("/", 1)[1]
    assert {(stem(r.path), r.error is None) for r in out["pages"].collect()} == {("a.pdf", True), ("77.PDF", True), ("bad.pdf", False)}
    assert {(stem(r.path), r.sequence) for r in out["candidates"].collect()} == {("a.pdf", s) for s in ("MKTLLVWCDEAAK", "ACDEFGHIKLMN", "RSTVWYACD", "GGHHKLLKKW")} | {("77.PDF", "ACDEFGHIKK")}
    assert {(stem(r.path), r.page_count, r.image_count, r.supplementary_count) for r in out["metadata"].collect()} == {("a.pdf", 1, 1, 1), ("77.PDF", 2, 0, 0)}
    result = {(r.PMID, r.Sequence): r for r in out["result"].collect()}
    assert ("123", "WWKKLLMMNN") in result and result["123", "MKTLLVWCDEAAK"].Gold_Standard_Match == "True" and result["123", "MKTLLVWCDEAAK"].Species == "Glycine max (soybean)"
    assert {(r.pmid, r.tp, r.fn) for r in out["metrics"].collect() if r.pmid == "123"} == {("123", 1, 1)}
    assert "Total True Positives (TP): 1" in [r.value for r in spark.read.text(str(tmp_path / "out/report")).collect()]
    assert out["audit"].where("type = 'species_verification'").count() >= 1
    said = calls.read_text().split()
    assert said.count("parse") == 3 and said.count("read") == 1  # 3 files, 1 image, whatever failed later
    # of the first run's answers only those of the batch that was lost are asked for again
    kinds = out["audit"].groupBy("type").count().collect()
    assert said.count("ask") - asked <= sum(r["count"] for r in kinds if r.type.startswith("species"))
    shown = sorted(map(str, out["result"].collect()))
    assert sorted(map(str, go()["result"].collect())) == shown and calls.read_text().split() == said


def test_a_table_of_many_papers_is_no_folder_each(spark, tmp_path):
    rows = spark.range(3000).select(F.col("id").cast("string").alias("pmid"), F.lit("S").alias("sequence"))
    writers.table(rows, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).select("pmid").distinct().count() == 3000
    assert sum(1 for _ in (tmp_path / "t").rglob("*.parquet")) <= 64
