from __future__ import annotations

import random
import re
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sievework.functions import kernels
from sievework.functions import lexicons as lex
from sievework.functions import text as T
from sievework.operators import merging, mining


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'int' if isinstance(v, int) else 'string'}" for k, v in values.items()) or "x int"
    return spark.createDataFrame([tuple(values.values()) or (1,)], schema).select(column.alias("v")).first()[0]


@pytest.mark.parametrize(("given", "wanted"), [("MKT-\n  LLV", "MKTLLV"), ("A-\nC-\nD", "ACD"), ("AB-\nC", "AB-\nC"), (None, None), ("", "")])
def test_join_hyphens(spark, given, wanted):
    assert one(spark, T.join_hyphens(F.col("t")), t=given) == wanted


def test_join_hyphens_is_the_fixpoint_of_pairwise_joins(spark):
    rng, pair = random.Random(7), re.compile(rf"([{lex.AA}]+)-\s*\n\s*([{lex.AA}]+)")

    def slowly(text):
        while (new := pair.sub(r"\1\2", text)) != text:
            text = new
        return text

    texts = ["".join(rng.choice("ACB-\n ") for _ in range(14)) for _ in range(3000)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", T.join_hyphens(F.col("t")).alias("v"))
    assert {r.i: r.v for r in frame.collect()} == {i: slowly(t) for i, t in enumerate(texts)}


def test_ocr_letters(spark):
    assert one(spark, T.ocr_letters(F.col("t")), t="0o1I") == "QQIL"
    assert one(spark, T.candidate_letters(F.col("t"), F.lit("csv")), t="mk t1 o") == "MKT1O"


@pytest.mark.parametrize(("given", "wanted"), [("SDS-PAGE", "SDS-PAGE"), ("SDS-AB-CD", "SDS-AB-CD"), ("AB-CD-EF", "ABCDEF"), ("SDS-\nPAGE", "SDSPAGE"), ("M K T L", "MKTL"), (None, None)])
def test_reconstruct(spark, given, wanted):
    assert one(spark, T.reconstruct(F.col("t")), t=given) == wanted


def test_rebuilt_texts_leave_a_task_in_pieces(spark, monkeypatch):
    """As many rows, keys and nulls as came; a piece is some texts, however many rows a batch has."""
    given = [(i, [None, "", "AB-CD-EF " * 400, "M K T L", "SDS-PAGE"][i % 5]) for i in range(5000)]
    frame = spark.createDataFrame(given, "i int, t string").coalesce(1)
    wanted = {i: None if t is None else T.rebuild(t, frozenset(lex.BLACKLIST)) for i, t in given}
    made = mining.rebuilt(frame, ["i"], "t")
    assert {r.i: r.t for r in made.collect()} == wanted
    runs, batch = [], pa.RecordBatch.from_arrays([pa.array([i for i, _ in given]), pa.array([t for _, t in given])], names=["i", "t"])
    monkeypatch.setattr(type(frame), "mapInArrow", lambda self, run, types: runs.append(run))
    mining.rebuilt(frame, ["i"], "t")
    pieces = list(runs[0](iter([batch])))
    assert len(pieces) == 4 and sum(p.num_rows for p in pieces) == 5000 and max(p.num_rows for p in pieces) < 1500


def test_texts_of_a_batch_are_not_all_in_memory_again(spark, monkeypatch):
    """A task holds the batch that came and what it found, not all texts as strings beside it."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000)), pa.array(["word " * 2000] * 2000)], names=["pmid", "text"])
    frame, runs = spark.createDataFrame([], "pmid long, text string"), []
    with monkeypatch.context() as patched:
        patched.setattr(type(frame), "mapInArrow", lambda self, run, types: runs.append(run) or self)
        kernels.table_matches(frame, "pmid", "text", lex.CANDIDATE, str, mining._LETTERS, lex.TABLE_HEADER, mining.judge())
        kernels.accepted(frame, ["pmid"], "text", lex.CANDIDATE, str, mining._LETTERS, mining.judge(), 3)
    for run in runs:
        tracemalloc.start()
        assert sum(b.num_rows for b in run(iter([batch]))) == 0
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 2_000_000, peak


@pytest.mark.parametrize(("lines", "wanted"), [(["1 MKTLL 5", "6 VVA"], ["MKTLLVVA"]), (["1 MKTLL", "7 VVA"], ["1 MKTLL", "7 VVA"]), (["x", "1 MKX", "4 AC", "6 DE 7", "y"], ["x", "1 MKX", "ACDE", "y"])])
def test_merge_numbered_lines(spark, lines, wanted):
    rows = spark.createDataFrame([("d", i, x) for i, x in enumerate(lines)], "d string, ln int, line string")
    assert [r.line for r in T.merge_numbered_lines(rows, ["d"]).orderBy("ln").collect()] == wanted


def test_join_numbered(spark):
    assert one(spark, T.join_numbered(F.col("t")), t="x MKT 10 LLV y\nAC DE") == "x MKTLLV y\nAC DE"


def test_join_numbered_takes_blocks_of_any_length(spark):
    assert one(spark, T.join_numbered(F.col("t")), t="x " + "MKT 10 " * 50_000 + "LLV y") == "x " + "MKT" * 50_000 + "LLV y"


def test_join_numbered_ends_a_block_where_python_does(spark):
    plain = re.compile(r"\b[ACDEFGHIKLMNPQRSTVWY]{3,}(?:[\s\d]+[ACDEFGHIKLMNPQRSTVWY]{3,})+\b")
    draw = random.Random(5)
    texts = ["".join(draw.choice(["MKT", "LLVA", "AC", "B", " ", "1", " 10 ", "_", "-", "x", "é"]) for _ in range(draw.randint(1, 14))) for _ in range(3000)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.join_numbered(F.col("t")).alias("j")).collect()
    assert [r.j for r in got] == [plain.sub(lambda m: re.sub(r"[\s\d]+", "", m[0]), r.t) for r in got]


def test_before_back_matter(spark):
    assert one(spark, T.before_back_matter(F.col("t")), t="a\nb\n 7. REFERENCES:\nc") == "a\nb"
    assert one(spark, T.before_back_matter(F.col("t")), t="a references\nb") == "a references\nb"


def test_abbreviations(spark):
    assert one(spark, T.abbreviations(F.col("t")), t="Abbreviations: ABC, alpha; D1 , delta; odd\n\nEF, not here") == ["ABC", "D1"]
    assert one(spark, T.abbreviations(F.col("t")), t="none") == []


def test_matches_have_offsets_of_python(spark):
    texts = ["ABC DEFG, HIJ 01A", "", "AAAA", "x ABC", "ÀÉ ABC 😀 DEF"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = sorted((r.i, r.start, r.match) for r in kernels.matches(frame, ["i"], "t", r"[A-Z]{3,}").collect())
    # Java counts UTF-16 units in neither split nor length here: offsets are code points
    assert got == sorted((i, m.start(), m[0]) for i, t in enumerate(texts) for m in re.finditer("[A-Z]{3,}", t))


def test_sentences_cells_and_lines(spark):
    assert one(spark, T.sentences(F.col("t")), t="One. Two!\nThree? ") == ["One.", "Two!", "Three?"]
    assert one(spark, T.cells(F.col("t")), t="a b\tc  d") == ["a b", "c", "d"]
    assert one(spark, T.cells(F.col("t")), t="a b c") == ["a", "b", "c"]
    assert one(spark, T.lines(F.col("t")), t="a\r\nb\x0cc\x1cd\n") == ["a", "b", "c", "d"]
    assert one(spark, T.first_line_with(F.col("t"), F.lit("b")), t="a\n  b c \nb") == "b c"
    assert one(spark, T.first_line_with(F.col("t"), F.lit("z")), t="a\nb") == ""


@pytest.mark.parametrize(
    ("seq", "context", "wanted"),
    [("MKTLL0", "", False), ("AAAAAAAAA", "", False), ("STALENT", "", False), ("MKTLLVW", "the gene locus", False), ("MKTLLVW", "the gene peptide", True), ("MKTLLVW", "", True), ("MKTLL", "", False), ("METHQDS", "", True), ("DISCUSSION", "", False), ("REFERENCE", "", False)],
)
def test_likely_peptide(spark, seq, context, wanted):
    assert one(spark, mining.likely_peptide(F.col("s"), F.col("c")), s=seq, c=context) is wanted


def test_candidate_score(spark):
    score = mining.candidate_score(F.col("s"), F.col("c"), F.lit("pdf_text"), F.lit(1), F.lit(False))
    assert one(spark, score, s="MKTLLVW", c="peptide MKTLLVW") == 9


def test_words_next_to_a_sequence(spark):
    rng, near = random.Random(2), kernels.Near(lex.WORDS_BEFORE, lex.WORDS_AFTER)
    some = ["MKTLLVW", "mktllvw", " ", "  ", ", ", "peptide", "Residues", "isolated", "x", "-", "\n", " " * 15]
    texts = ["".join(rng.choice(some) for _ in range(rng.randint(1, 9))) for _ in range(2000)]
    one_ = lambda c: mining.candidate_score(F.lit("MKTLLVW"), F.col("t"), F.lit("x"), F.lit(1), F.lit(False), [], [], near=c)
    plain = mining._ahead(F.lit("MKTLLVW"), F.col("t"), lex.WORDS_BEFORE), mining._behind(F.lit("MKTLLVW"), F.col("t"), lex.WORDS_AFTER)
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", plain[0].alias("a"), plain[1].alias("b"), one_(plain).alias("s")).collect()
    assert all(near.of(r.t, "MKTLLVW") == (r.a, r.b) and r.s == 6 * r.a + 6 * r.b for r in rows) and sum(r.a and r.b for r in rows) > 5


def test_evidence_is_the_first_sentence_of_the_first_pattern():
    rng = random.Random(3)
    patterns = (("A", (r"\bab\b", r"b[\-\s]c")), ("B", (r"x+y", r"ab")), ("C", ("Q",)))
    model = kernels.Evidence(patterns, (("A", ("C",)),))
    assert [t[2] for t in model.tries] == ["ab", "b", "y", "ab", "q"]
    for _ in range(3000):
        text = "".join(rng.choice(["ab", "b-c", " ", ". ", "! ", "xxy", "q", "Q\n", "z"]) for _ in range(rng.randint(0, 14)))
        parts = [s.strip() for s in re.split(r"(?<=[.!?])\s+", text.replace("\n", " ")) if s.strip()]
        wanted = []
        for name, own in patterns:
            line = next((s for p in own for s in parts if re.search(p, s, re.IGNORECASE)), None)
            if line is not None:
                wanted.append((name, line))
        if any(n == "A" for n, _ in wanted):
            wanted = [w for w in wanted if w[0] != "C"]
        assert model.pairs(text) == wanted, text


def test_stretches_of_a_text_have_the_evidence_of_their_own_and_its_sentences_are_read_once():
    rng = random.Random(4)
    model = kernels.Evidence((("A", (r"\bab\b", r"b[\-\s]c")), ("B", (r"x+y", r"ab")), ("C", ("Q",))), (("A", ("C",)),))
    for _ in range(2000):
        text = "".join(rng.choice(["ab", "b-c", " ", ". ", ".\n", "!", "  ", "xxy", "q", "Q\n", "z", "é"]) for _ in range(rng.randint(1, 14)))
        own = kernels.Stretches(model, text)
        for _ in range(4):
            begin = rng.randrange(len(text))
            end = rng.randint(begin + 1, len(text))
            assert own.pairs(begin, end) == model.pairs(text[begin:end]), (text, begin, end)
    text, read = " ".join(f"Sentence {i} with ab." for i in range(400)), []
    of, model.of = model.of, lambda x: read.append(x) or of(x)
    own = kernels.Stretches(model, text)
    for begin in range(0, len(text) - 2000, 10):
        own.pairs(begin, begin + 2000)
    # each sentence once, and two that are cut a stretch: not all that lie in each
    assert len(read) <= 400 + 2 * len(range(0, len(text) - 2000, 10))


def test_matches_are_passed_over_by_characters_that_no_sequence_has():
    for source in ("pdf_text", "ocr"):
        never = re.compile(mining._no_letter(source))
        for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ01":
            assert bool(never.search(c)) == (T.letters_of(c, source == "ocr") not in lex.AA), c


def test_rebuild_is_its_rules_repeated_whatever_is_passed_over():
    rng, blocked = random.Random(5), frozenset(lex.BLACKLIST)

    def slowly(text):
        text = re.sub(lex.HYPHEN_BREAK, "", text)
        while True:
            new = re.sub(lex.HYPHENATED, lambda m: m[0] if m[1] in blocked or m[2] in blocked else m[1] + m[2], text)
            new = re.sub(lex.SPACED_OUT, lambda m: re.sub(r"[ \t\-]+", "", m[0]), new)
            new = re.sub(lex.BROKEN, r"\1\2", new)
            if new == text:
                return text
            text = new

    some = ["A", "C", "MK", "TT", "PCR", "DNA", "a", "é", "x1", "0", "9", "_", "-", "-", "-", "- ", "\n", "-\n", "- \n ", " ", "  ", "\t", ". ", "\x85"]
    for _ in range(20000):
        text = "".join(rng.choices(some, k=rng.randint(1, 14)))
        assert T.rebuild(text, blocked) == slowly(text), text


@pytest.mark.parametrize(("names", "wanted"), [([], 1.0), (["Agarose Gel"], 1.0), (["HPLC", "HPLC", "NMR"], 6.0)])
def test_evidence_score(spark, names, wanted):
    assert one(spark, mining.evidence_score(F.col("t")), t=names) == wanted


def test_technique_lines_suppress_general_ones(spark):
    got = one(spark, mining.technique_lines(F.col("t")), t="First. Purified by RP-HPLC here. Then NMR.")
    assert [(p.technique, p.line) for p in got] == [("RP-HPLC", "Purified by RP-HPLC here."), ("NMR", "Then NMR.")]
    assert one(spark, mining.technique_names(F.col("t")), t="RP-HPLC and NMR") == ["RP-HPLC", "HPLC", "NMR"]


def test_species_and_document_techniques(spark):
    rows = spark.createDataFrame([("1", "In soybean and A. thaliana.\n We ran RACE-PCR twice.")], "pmid string, text string")
    assert mining.document_species(rows, "pmid", "text").first().species == ["Arabidopsis thaliana", "Glycine max (soybean)"]
    assert mining.document_techniques(rows, "pmid", "text").first().techniques == {"RACE-PCR": "We ran RACE-PCR twice."}


def test_mine_end_to_end(spark):
    text = "The peptide MKTLLVWCDE was sequenced by Edman degradation. Abbreviations: QQRSTVW, none.\nPeptide QQRSTVWQQ too. MKTLLVW-\nCDE again."
    rows = spark.createDataFrame([("1", text)], "pmid string, text string")
    got = {r.sequence: r for r in mining.mine(rows, "pmid", "text").collect()}
    assert set(got) == {"MKTLLVWCDE", "QQRSTVW", "QQRSTVWQQ"}
    assert got["MKTLLVWCDE"].techniques == ["Edman Sequencing"] and got["MKTLLVWCDE"].evidence_score == 5.0
    assert got["MKTLLVWCDE"].sequence_line.startswith("The peptide MKTLLVWCDE")
    bad = mining.abbreviation_words(rows, "pmid", "text")
    assert {r.sequence for r in mining.mine(rows, "pmid", "text", bad_words=bad).collect()} == {"MKTLLVWCDE", "QQRSTVWQQ"}


def test_mine_tables(spark):
    rows = spark.createDataFrame([("1", "Peptide list\nid  MKTLLVW  3\nname\tQWERTYW\n")], "pmid string, text string")
    assert {r.sequence for r in mining.mine_tables(rows, "pmid", "text").collect()} == {"MKTLLVW", "QWERTYW"}


def _fold(cands):
    """The merge as a fold, one candidate after the other."""
    kept = None
    for i, (score, techs, lines) in enumerate(cands):
        if kept is None or score > kept[0]:
            kept = [score, list(techs), list(lines), i]
        else:
            kept[1] = sorted(set(kept[1]) | set(techs))
            kept[2] += [x for k, x in enumerate(lines) if x not in kept[2] and x not in lines[:k]]
    return tuple(kept)


def test_merge_is_the_ordered_fold(spark):
    rng, groups = random.Random(3), {}
    for g in range(200):
        groups[g] = [(rng.randint(0, 3), rng.sample("ABCD", rng.randint(0, 3)), rng.sample(["x", "y", "z"], rng.randint(0, 3))) for _ in range(rng.randint(1, 5))]
    data = [(g, i, s, t, x, 0.0) for g, rows in groups.items() for i, (s, t, x) in enumerate(rows)]
    frame = spark.createDataFrame(data, "g int, i int, score int, techniques array<string>, technique_lines array<string>, evidence_score double")
    got = {r.g: (r.score, r.techniques, r.technique_lines, r.i) for r in merging.merge_candidates(frame, ["g"], ["i"]).collect()}
    assert got == {g: _fold(rows) for g, rows in groups.items()}


def test_aligned_merge_keeps_lines_beside_techniques(spark):
    data = [("s", 0, 5, ["C"], ["l1"], 1.0), ("s", 1, 5, ["A", "C"], ["l2", "l3"], 1.0)]
    frame = spark.createDataFrame(data, "g string, i int, score int, techniques array<string>, technique_lines array<string>, evidence_score double")
    row = merging.merge_candidates(frame, ["g"], ["i"], aligned=True).first()
    assert list(zip(row.techniques, row.technique_lines, strict=True)) == [("C", "l1"), ("A", "l2")]


def test_prefix_join_pairs_every_key_that_begins_the_name(spark):
    files = spark.createDataFrame([("1234_x.csv",), ("99.csv",)], "name string")
    keys = spark.createDataFrame([("123",), ("1234",), ("7",)], "pmid string")
    assert sorted(tuple(r) for r in merging.join_by_prefix(files, keys, "name", "pmid").collect()) == [("1234_x.csv", "123"), ("1234_x.csv", "1234")]


def test_lines_that_show_techniques():
    patterns = {"A": [r"\bheat\b", r"\bhand"], "B": [r"\bthat\b|\bque\b"], "C": [r"(?!x)that", "at$"]}
    draw = random.Random(7)
    model = kernels.Evidence(*kernels.listed(patterns, {}))
    for _ in range(2000):
        text = "".join(draw.choice(["heat", "Hand", "that", "que", " ", "\n", "\r\n", "x", "é", "\u2028", "."]) for _ in range(draw.randint(0, 15)))
        wanted = []
        for name, own in patterns.items():
            found = [x for p in own for x in kernels.Lines(text).all() if re.search(p, x, re.IGNORECASE)]
            wanted += [(name, found[0].strip())] if found else []
        assert model.lines(text) == wanted
