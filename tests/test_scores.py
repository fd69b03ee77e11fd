from __future__ import annotations

import difflib
import hashlib
import http.server
import json
import math
import random
import threading
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.operators import evaluation, scoring, verification
from sievework.sources import readers, writers
from sievework.streaming import incremental


def test_length_score_and_validity(spark):
    row = spark.range(1).select(scoring.length_score(F.lit(10.0), F.lit(20.0)).alias("a"), scoring.validity(F.lit("MKXB")).alias("b")).first()
    assert (row.a, row.b) == (0.5, 0.5)


def test_sequence_scores(spark):
    refs = spark.createDataFrame([("MKTLLV",), ("MKTLLV",), ("ACDEFG",), ("AC",)], "seq string")
    queries = spark.createDataFrame([("mktllv",), ("",), ("WW",), ("MKTLLW",), (None,)], "seq string")
    got = {r.seq: r for r in scoring.sequence_scores(queries, refs).collect()}
    assert got["MKTLLV"].exact and got["MKTLLV"].sequence_score == 1.0
    assert got[""].sequence_score == 0.0
    assert got["WW"].nearest == 0.0 and got["WW"].composition == 0.0

    def vector(s, known=None):
        grams = [s[i : i + 3].lower() for i in range(len(s) - 2)]
        df = {g: sum(g in {r[i : i + 3].lower() for i in range(len(r) - 2)} for r in {"MKTLLV", "ACDEFG", "AC"}) for g in set(grams)}
        v = {g: grams.count(g) * (math.log(4 / (1 + df[g])) + 1) for g in grams if df[g]}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {g: x / norm for g, x in v.items()}

    q, r = vector("MKTLLW"), vector("MKTLLV")
    assert got["MKTLLW"].nearest == pytest.approx(sum(x * r.get(g, 0) for g, x in q.items()))


@pytest.mark.parametrize("postings", [scoring.POSTINGS, -1])
def test_empty_references_give_no_neighbour(spark, postings):
    none = spark.createDataFrame([], "seq string")
    assert scoring.nearest(spark.createDataFrame([("ABC",)], "seq string"), none, postings=postings).first().nearest == 0.0


def test_a_broadcast_index_finds_what_the_join_finds(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("ACDE") for _ in range(rng.randint(0, 12)))
    queries = spark.createDataFrame([(word(),) for _ in range(300)] + [("",), ("WWWW",)], "seq string")
    refs = spark.createDataFrame([(word(),) for _ in range(60)], "seq string")
    got = [{r.seq: round(r.nearest, 9) for r in scoring.nearest(queries, refs, postings=n).collect()} for n in (scoring.POSTINGS, 0)]
    assert got[0] == got[1] and len(set(got[0].values())) > 20


def test_references_beyond_the_cap_are_those_of_least_digest(spark):
    refs = spark.createDataFrame([(f"S{i % 50}",) for i in range(200)], "seq string")
    least = sorted({f"S{i}" for i in range(50)}, key=lambda s: hashlib.md5(s.encode()).hexdigest())
    assert {r.seq for r in scoring.capped(refs, rows=7).collect()} == set(least[:7])
    assert scoring.capped(refs, rows=50).count() == 50


def test_context_scores_with_an_encoder(spark):
    def load():
        return lambda texts: [[float(len(t)), 1.0] for t in texts]

    rows = scoring.encode(spark.createDataFrame([("a", "xx"), ("b", None)], "k string, t string"), "t", load)
    refs = scoring.encode(spark.createDataFrame([("xx",)], "t string"), "t", load)
    got = {r.k: r.bio_score for r in scoring.context_scores(rows, "k", refs).collect()}
    assert got["a"] == pytest.approx(1.0) and 0 < got["b"] < 1


@pytest.mark.parametrize(
    ("text", "error"),
    [
        ('noise {"valid_sequence": true, "confidence": "0.9", "support_type": "weak", "a": {"b": 1}} tail', None),
        ('{"valid_sequence": "true", "support_type": "weak"}', "valid_sequence"),
        ('{"valid_sequence": true, "confidence": 1.2, "support_type": "weak"}', "confidence"),
        ('{"valid_sequence": true, "confidence": "NaN", "support_type": "weak"}', "confidence"),
        ('{"valid_sequence": true, "support_type": "some"}', "support_type"),
        ('{"valid_sequence": true, "support_type": "weak", "linked_techniques": "x"}', "linked_techniques"),
        ('{"valid_sequence": true, "support_type": "weak", "reason": 3}', "reason"),
        ("[1, 2]", "no object"),
        ("nothing", "no object"),
        (None, "no object"),
    ],
)
def test_read_verdict(spark, text, error):
    v = spark.createDataFrame([(text,)], "t string").select(verification.read_verdict(F.col("t")).alias("v")).first().v
    assert v.error == error and v.ok is (error is None)
    if error is None:
        assert (v.valid_sequence, v.confidence, v.support_type, v.linked_techniques) == (True, 0.9, "weak", [])


def test_read_confirmations(spark):
    row = spark.createDataFrame([('{"technique_confirmed": true, "species_confirmed": true, "confidence": 0.5, "verified_species": null}',)], "t string").select(verification.read_technique(F.col("t")).alias("a"), verification.read_species(F.col("t")).alias("b")).first()
    assert row.a.ok and row.a.confidence == 0.5 and row.a.evidence_line == ""
    assert row.b.ok and row.b.verified_species is None


def test_scores_gate_nulls_pass(spark):
    rows = spark.createDataFrame([(0.59, 0.9), (None, None), (0.6, None)], "sequence_score double, bio_score double")
    assert [r[0] for r in rows.select(verification.final_validity(F.lit(True))).collect()] == [False, True, True]


def test_verify_asks_each_prompt_once_and_retries(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.touch()

    def load():
        def model(prompt):
            with calls.open("a") as f:
                f.write("x\n")
            if "Named in it" in prompt:
                return '{"species_confirmed": true, "confidence": 0.75, "verified_species": "Zea mays"}'
            if "Technique:" in prompt:
                return json.dumps({"technique_confirmed": "NMR" in prompt, "confidence": 0.8, "evidence_line": "e"})
            return '{"valid_sequence": true, "confidence": 0.9, "support_type": "strong", "is_synthesized": true, "synthesized_line": "made"}' if "MKTLLV" in prompt else "garbage"

        return model

    schema = "id string, pmid string, sequence string, sequence_line string, source string, context string, techniques array<string>, technique_lines array<string>, evidence_score double, sequence_score double, bio_score double"
    rows = [("1", "7", "MKTLLV", "l", "csv", "c", ["NMR", "HPLC"], ["n", "h"], 6.0, 0.9, None), ("2", "7", "ACDEFG", "l", "csv", "c", [], [], 1.0, 0.9, 0.9), ("3", "7", "WWWWWW", "l", "csv", "c", [], [], 1.0, 0.1, 0.9)]
    docs = spark.createDataFrame([("7", ["Zea mays (maize)"], "head")], "pmid string, species array<string>, head string")

    def save(frame, name):
        frame.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    verified, log = verification.verify(spark.createDataFrame(rows, schema), docs, load, save)
    row = verified.collect()
    assert [(r.id, r.verified_techniques, r.technique_scores, r.verified_species, r.species_confidence) for r in row] == [("1", ["NMR"], [0.8], "Zea mays", 0.75)]
    # one call for 1, three for 2, none for 3; two techniques; one species
    assert len(calls.read_text().split()) == 1 + 3 + 2 + 1
    assert sorted(r.attempt for r in log.collect()) == [1, 1, 1, 1, 3]
    marked = verification.with_synthesized(verified).first()
    assert marked.verified_techniques == ["NMR", "synthesized"] and marked.technique_evidence_lines == ["e", "made"]


def test_metrics_of_published_counts(spark):
    counts = spark.createDataFrame([("a", 56, 7, 8)], "pmid string, tp long, fp long, fn long")
    row = evaluation.micro(counts).first()
    assert (round(row.precision, 4), round(row.recall, 4), round(row.f1, 4)) == (0.8889, 0.8750, 0.8819)
    row = evaluation.micro(counts.where("false")).first()
    assert (row.tp, row.precision, row.recall, row.f1) == (0, 0.0, 0.0, 0.0)


def test_sources(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s/1_a.fasta").write_text(">p1 some > thing\nmkt\nLLV W\n>p2\nACDEFGH\n")
    (tmp_path / "s/1_b.csv").write_text('name,seq\n"a, b",MKTLLVW\n,NA\n')
    (tmp_path / "s/1_c.tsv").write_text("name\tseq\nx\tQWERTYW\n")
    (tmp_path / "s/1_d.txt").write_bytes(b"text \xff MKTLLVW")
    (tmp_path / "s/1_e.bin").write_text("?")
    (tmp_path / "s/1_f.CSV").write_text("a;b\nQQQ\n")
    got = {(r.source, r.id, tuple(r.cells), r.context) for r in readers.supplementary(spark, str(tmp_path / "s")).collect()}
    assert got == {
        ("fasta", "p1", ("MKTLLVW",), "p1 some > thing"),
        ("fasta", "p2", ("ACDEFGH",), "p2"),
        ("csv", None, ("a, b", "MKTLLVW"), "a, b | MKTLLVW"),
        ("csv", None, ("", "NA"), " | NA"),
        ("tsv", None, ("x", "QWERTYW"), "x | QWERTYW"),
        ("txt", None, ("text  MKTLLVW",), "text  MKTLLVW"),
        ("csv", None, ("QQQ",), "QQQ"),
    }
    order = readers.supplementary(spark, str(tmp_path / "s")).where("path like '%b.csv' or path like '%.fasta'").orderBy("path", "row").collect()
    assert [(r.row, r.cells[-1]) for r in order] == [(1, "MKTLLVW"), (2, "ACDEFGH"), (0, "MKTLLVW"), (1, "NA")]


def test_records(spark, tmp_path):
    (tmp_path / "12").mkdir()
    (tmp_path / "12/sequence_candidates.json").write_text('[{"sequence": "MKT", "score": 3}, {"sequence": "ACD", "techniques": ["NMR"], "evidence_score": 4.0}]')
    got = {r.sequence: r for r in readers.candidates(spark, str(tmp_path / "12/sequence_candidates.json")).collect()}
    assert (got["MKT"].techniques, got["MKT"].evidence_score, got["MKT"].sequence_line) == ([], 1.0, "")
    assert [r.pmid for r in readers.parsed_papers(spark, str(tmp_path)).collect()] == ["12"]
    (tmp_path / "gold.txt").write_text("PMID: 5\nMKTL\nxx\nACD\n\nPMID 6\nQWER\n")
    stanzas = evaluation.gold_stanzas(readers.gold_lines(spark, str(tmp_path / "gold.txt")), ["path"], "ln", "line")
    assert sorted((r.pmid, r.sequence) for r in stanzas.collect()) == [("5", "MKTL"), ("6", "QWER")]
    (tmp_path / "ref.json").write_text('[{"sequence_source": "a"}, {"validation_statement": "b"}]')
    assert [r.context for r in readers.reference_contexts(spark, str(tmp_path / "ref.json")).collect()] == ["b"]


def test_parsers_keep_going_after_a_bad_file(spark, tmp_path):
    for name, content in (("a.pdf", b"one\x0ctwo"), ("b.pdf", b"bad")):
        (tmp_path / name).write_bytes(content)

    def parse(content):
        if content == b"bad":
            raise ValueError("bad file")
        return [(i, p) for i, p in enumerate(content.decode().split("\x0c"), 1)]

    pages = readers.pdf_pages(readers.files(spark, str(tmp_path), "*.pdf"), parse)
    assert sorted((r.page, r.text, r.error) for r in pages.where("error is null").collect()) == [(1, "one", None), (2, "two", None)]
    assert pages.where("error is not null").first().error == "bad file"
    assert {r.raw_text for r in readers.joined_pages(pages.where("error is null"), ["path"], ["page"]).collect()} == {"one\ntwo"}


def test_csv_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([('a "b", c', "x\ny")], "p string, q string")
    writers.csv(rows, str(tmp_path / "o"), one_file=True)
    assert tuple(readers.verified_csv(spark, str(tmp_path / "o")).first()) == ('a "b", c', "x\ny")


def test_new_files_are_mined_once(spark, tmp_path):
    docs = lambda ids: spark.createDataFrame([(i, "t") for i in ids], "doc_id long, text string")
    start = lambda: incremental.mine_new(spark, "doc_id long, text string", str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"), lambda b: b.select("doc_id")).awaitTermination()
    docs([1, 2]).write.parquet(str(tmp_path / "in"))
    start()
    docs([3]).write.mode("append").parquet(str(tmp_path / "in"))
    start()
    assert sorted(r.doc_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3]


def test_graded_answers(spark):
    texts = ['x {"verified": true, "confidence": 0.8, "evidence_strength": "High", "reason": "Synthetic one"}', '{"valid_sequence": true, "evidence_strength": "Low"}', "none"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", verification.read_graded(F.col("t")).alias("v")).orderBy("i").collect()
    assert [(r.v.ok, r.v.valid_sequence, r.v.confidence, r.v.support_type, r.v.is_synthesized) for r in rows] == [(True, True, 0.8, "strong", True), (True, True, 0.0, "weak", False), (False, False, 0.0, "reject", False)]


def test_similar_to_gold(spark):
    rows = spark.createDataFrame([("1", "MKTLLVWCDE"), ("1", "MKTLLVWCDEAAAAA"), ("2", "MKTLLVWCDE"), ("1", "mktllvwcdf")], "pmid string, sequence string")
    gold = spark.createDataFrame([("1", "MKTLLVWCDF")], "pmid string, sequence string")
    got = {(r.pmid, r.sequence): r.similar for r in evaluation.similar_to_gold(rows, gold).collect()}
    assert got == {("1", "MKTLLVWCDE"): True, ("1", "MKTLLVWCDEAAAAA"): False, ("2", "MKTLLVWCDE"): False, ("1", "mktllvwcdf"): True}


def test_context_scores_beyond_one_block_of_references(spark):
    rng = random.Random(3)
    vectors = [[rng.gauss(0, 1) for _ in range(4)] for _ in range(60)]
    rows = [*enumerate(vectors), (7, vectors[7]), (7, vectors[8]), (None, vectors[1]), (90, None), (91, [0.0] * 4)]
    frame = spark.createDataFrame(rows, "id long, embedding array<double>")
    refs = spark.createDataFrame([(v,) for v in [*vectors[20:], vectors[20], None]], "embedding array<double>")
    wanted = sorted(((r.id, round(r.bio_score, 9)) for r in scoring.context_scores(frame, "id", refs).collect()), key=str)
    assert len(wanted) == len(rows)
    for most in (1, 7, 39):
        got = scoring.context_scores(frame, "id", refs, most=most)
        assert sorted(((r.id, round(r.bio_score, 9)) for r in got.collect()), key=str) == wanted, most


def test_an_index_in_blocks_finds_what_all_products_give(spark, monkeypatch):
    """Common grams, equal sequences, none shared; blocks of both sides; MaxScore against every product."""
    rng = random.Random(11)
    word = lambda letters, n: "".join(rng.choice(letters) for _ in range(rng.randint(0, n)))
    queries = [(word("ACD", 15),) for _ in range(150)] + [(word("ACDEFGHIKL", 25),) for _ in range(150)] + [("",), ("WWWW",)]
    refs = [(word("ACD", 15),) for _ in range(90)] + [(word("ACDEFGHIKL", 25),) for _ in range(90)]
    frames = [spark.createDataFrame(x, "seq string") for x in (queries, refs)]
    wanted = {r.seq: round(r.nearest, 9) for r in scoring.nearest(*frames).collect()}
    monkeypatch.setattr(scoring, "BLOCK", 25)
    monkeypatch.setattr(scoring, "TOGETHER", 13)
    assert {r.seq: round(r.nearest, 9) for r in scoring.nearest(*frames, postings=0).collect()} == wanted
    assert len(set(wanted.values())) > 50


def test_best_of_an_index():
    rng = random.Random(6)
    for _ in range(300):
        names = [f"g{i}" for i in range(rng.randint(1, 12))]
        vectors = []
        for _ in range(rng.randint(1, 30)):
            own = rng.sample(names, rng.randint(0, len(names)))
            vectors.append((own, [rng.choice([0.1, 0.5, 1.0]) * rng.random() for _ in own]))
        index = scoring.Index(*scoring.Index.build(vectors))
        for _ in range(3):
            own = rng.sample([*names, "none"], rng.randint(0, len(names)))
            weights = [rng.random() for _ in own]
            wanted = max([sum(w * v[1][v[0].index(g)] for g, w in zip(own, weights, strict=True) if g in v[0]) for v in vectors], default=0.0)
            assert index.best(own, weights) == pytest.approx(wanted)


def test_pooled_tokens(spark):
    vectors = np.array([[0.0, 0.0], [1.0, 3.0], [3.0, 1.0], [9.0, 9.0]])
    encoder = scoring.token_encoder(lambda t: [int(c) for c in t], lambda ids, mask: vectors[ids], most=3)
    assert encoder(["12", "", "1113333", "3"]) == [[2.0, 2.0], [0.0, 0.0], [1.0, 3.0], [9.0, 9.0]]
    tokens = np.arange(24.0).reshape(2, 3, 4)
    assert scoring.pooled(tokens, np.array([[True, False, True], [False] * 3])).tolist() == [[4.0, 5.0, 6.0, 7.0], [0.0] * 4]
    rows = spark.createDataFrame([("12",), ("",), (None,)], "t string")
    out = scoring.encode(rows, "t", lambda: encoder).collect()
    assert [r.embedding for r in out] == [[pytest.approx(0.5**0.5)] * 2, [0.0, 0.0], [0.0, 0.0]]


def test_vectors_that_score_nothing(spark):
    rows = [(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0]), (5, [1.0, float("nan")]), (6, [float("inf"), 1.0]), (7, [-1.0, 0.0]), (8, [1.0, None])]
    frame = spark.createDataFrame(rows, "id long, embedding array<double>")
    refs = spark.createDataFrame([([2.0, 0.0],), ([2.0, 0.0],), (None,), ([3.0, 3.0],), ([0.0, 0.0],), ([float("nan"), 1.0],)], "embedding array<double>")
    for most in (4096, 2, 1):
        got = {r.id: r.bio_score for r in scoring.context_scores(frame, "id", refs, most=most).collect()}
        assert got == {k: pytest.approx(1.0) if k == 1 else 0.0 for k, _ in rows}, most
    assert scoring.context_scores(frame, "id", refs.limit(0)).agg(F.max("bio_score")).first()[0] == 0.0


def test_cap_of_many_references_is_a_sort(spark):
    """Ten million rows of a million texts: the counts by head pick what a whole sort would."""
    refs = spark.range(10_000_000, numPartitions=16).select(F.concat(F.lit("S"), (F.col("id") % 1_000_000).cast("string")).alias("seq"))
    for rows in (1, 777, 40_000):
        got = scoring.capped(refs, rows=rows)
        own = spark.range(1_000_000).select(F.concat(F.lit("S"), F.col("id").cast("string")).alias("seq")).orderBy(F.md5("seq")).limit(rows)
        assert got.count() == rows and got.exceptAll(own).count() == 0, rows


def test_similar_to_gold_against_every_pair(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("ACDE") for _ in range(rng.randint(0, 14)))
    gold = {(str(d), w) for d in range(4) for w in (word() for _ in range(12)) if w}
    rows = [(str(rng.randint(0, 5)), "".join(rng.choice("ACDE") if rng.random() < 0.1 else c for c in rng.choice(sorted(gold))[1])) for _ in range(300)] + [("1", ""), ("1", None), (None, "ACDE")]
    frame = spark.createDataFrame(rows, "pmid string, sequence string")
    got = evaluation.similar_to_gold(frame, spark.createDataFrame(sorted(gold), "pmid string, sequence string")).collect()
    ratio = lambda a, b: difflib.SequenceMatcher(None, a, b).ratio()
    assert len(got) == len(rows)
    for r in got:
        assert r.similar == any(d == r.pmid and r.sequence and ratio(r.sequence, g) >= 0.85 for d, g in gold), r
    pairs = spark.createDataFrame([(word(), word()) for _ in range(400)], "a string, b string").select("a", "b", evaluation.ratio_bound(F.col("a"), F.col("b")).alias("x")).collect()
    assert all(r.x >= ratio(r.a, r.b) - 1e-12 for r in pairs)


def test_model_over_http(spark):
    class Answer(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            body = json.dumps({"response": json.dumps({"technique_confirmed": asked["model"] == "m" and asked["options"]["temperature"] == 0, "confidence": 1, "evidence_line": asked["prompt"]})}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Answer)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        prompts = spark.createDataFrame([("a",), ("b",), ("a",)], "prompt string")
        got = verification.ask(prompts, verification.http_model(f"http://127.0.0.1:{server.server_port}/", "m"), "technique", 2).collect()
        assert sorted((r.prompt, r.attempt, r.ok, json.loads(r.response)["evidence_line"]) for r in got) == [("a", 1, True, "a"), ("b", 1, True, "b")]
        down = verification.ask(prompts, verification.http_model("http://127.0.0.1:1", "m", 1), "technique", 2).collect()
        assert sorted((r.prompt, r.attempt, r.ok) for r in down) == [(p, k, False) for p in "ab" for k in (1, 2)]
    finally:
        server.shutdown()


def test_encoder_takes_no_longer_with_the_words_it_has_seen():
    from sievework.plans import scoring as plans

    encoder, took = plans.letter_encoder(), []
    for k in range(60):
        texts = [" ".join(chr(97 + k % 26) + "".join(chr(97 + int(c)) for c in str(n)) + chr(97 + k // 26) for n in range(300 * i, 300 * i + 300)) for i in range(16)]
        began = time.process_time()
        out = encoder(texts)
        took.append(time.process_time() - began)
        for text, vector in ((texts[0], out[0]), (texts[-1], out[-1])):
            words = text.split()[:256]
            assert vector == pytest.approx([sum(1 + w.count(c) for w in words) / 256 for c in "aeinst"])
    assert sum(took[-10:]) < 3 * sum(took[:10])


def test_unit_divides_by_a_norm_that_is_computed_once(spark):
    frame = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), (None,)], "v array<double>")
    unit = frame.select(scoring.unit(F.col("v")).alias("v"))
    assert [r.v for r in unit.collect()] == [[0.6, 0.8], [0.0, 0.0], None]
