from __future__ import annotations

import os
import random
import re

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from sievework.llm import quality_rules
from sievework.llm.common import store

from . import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    verdict = {r.doc_id: r.kept for r in quality_rules.judge(docs).collect()}
    assert all(not verdict[i] for i, t in rows.items() if brute.base_failed(t))

    docs = store(corpus_pipeline.quality(spark, docs, SF), "q")
    rows = {i: t for i, t in rows.items() if verdict[i]}
    assert docs.columns == columns and {r.doc_id: r.text for r in docs.collect()} == rows

    docs = store(corpus_pipeline.near_duplicates(spark, docs, SF), "n")
    found = brute.near_duplicates(list(rows.items()))
    rows = {i: t for i, t in rows.items() if found[i][1] == i}
    assert docs.columns == columns and {r.doc_id: r.text for r in docs.collect()} == rows

    docs = store(corpus_pipeline.repeats(spark, docs, SF), "r")
    kept = brute.without_passages(list(rows.items()), 200, 51)
    got = {r.doc_id: r for r in docs.collect()}
    assert docs.columns == columns and {i: r.text for i, r in got.items()} == kept
    assert all(r.n_chars == len(r.text) for r in got.values()) and kept != rows

    docs = store(corpus_pipeline.personal(spark, docs, SF), "p")
    rows = {r.doc_id: r.text for r in docs.collect()}
    assert docs.columns == columns and set(rows) == set(got)
    assert not any(brute.personal(t) for t in rows.values())
    assert sum(rows[i] == got[i].text for i in rows if not re.search("[0-9@]", got[i].text)) >= 0.98 * len(rows) - sum(bool(re.search("[0-9@]", r.text)) for r in got.values())

    packed = corpus_pipeline.packed(spark, docs, SF).collect()
    lengths: dict[int, int] = {}
    for r in packed:
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    assert lengths == {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in rows.items()}


def test_run_applies_the_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = store(stage(spark, docs, SF), "s")
    key = lambda frame: sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in frame.collect())
    assert key(corpus_pipeline.run(spark, SF)) == key(docs)


def test_odd_rows_pass_all_stages(spark):
    text = " ".join(f"word{i} is" for i in range(40))
    rows = [(1, None, None, "s", None), (2, "", "en", None, 0), (3, text, "en", "s", 1), (3, text, "en", "s", 1), (None, text, "en", "s", 1), (5, text + " a@b.co", None, "s", 2), (6, "x" * 20000, "en", "s", 2)]
    names = ["kept", "component_id", "_key", "_mark", "code", "vote", "key", "text_key", "node", "n", "__repeat_key", "_spans", "_row", "length", "piece"]
    docs = spark.createDataFrame([(*r, *range(len(names))) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in names))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and {tuple(r)[5:] for r in out.collect()} <= {tuple(range(len(names)))}
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            frame = store(stage(spark, frame, SF), "odd")
        frame.collect()


def test_passages_of_over_fifty_words_go_and_shorter_ones_stay(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstu") for _ in range(rng.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(n) for n in (51, 52, 55, 60, 60)] + [" ".join(rng.choice(["ab", "cde", "fghi"]) for _ in range(60))]
    short = [text(n) for n in (20, 40, 49)]
    rows = [(i, f"{text(150)} {p} {text(60)}") for i, p in enumerate((passages + short) * 3)]
    rows += [(100 + i, text(200)) for i in range(30)]
    out = {r.doc_id: r.text for r in corpus_pipeline.repeats(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()}
    for i, given in rows:
        mine = [p for p in passages if p in given]
        assert (out[i] == given) if not mine else (mine[0] not in out[i] and len(out[i].split()) >= 209), i


def test_long_texts_pass_all_stages(spark):
    rng = random.Random(6)
    long = " ".join("".join(rng.choice("aeiourstln") for _ in range(rng.randint(1, 8))) for _ in range(700_000))
    line = "".join(rng.choice("aeiourstln") for _ in range(3_000_000))
    rows = [(1, long, "en"), (2, long[1_000_000:] + long[:1_000_000], "en"), (3, line, "en"), (4, "word " * 600_000, "en")] + [(10 + i, long[i * 5000 : i * 5000 + 900], "en") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for stage in (corpus_pipeline.quality, corpus_pipeline.near_duplicates):
        docs = store(stage(spark, docs, SF), "long")
    left = {r.doc_id for r in docs.collect()}
    assert 1 in left and not left & {2, 4}
    docs = store(corpus_pipeline.repeats(spark, docs, SF), "long")
    assert {r.doc_id for r in docs.collect()} == left
    pieces = corpus_pipeline.packed(spark, corpus_pipeline.personal(spark, docs, SF), SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == left


def test_near_duplicates_are_judged_by_row(spark):
    base = [" ".join(f"t{k}w{i}" for i in range(60)) for k in range(5)]
    near = [t + " more" for t in base]
    rows = [
        (1, base[0]), (None, near[0]),  # the row without doc_id goes
        (None, "nothing like the others in any of its words"), (None, ""), (None, ""), (None, None),
        (2, base[1]), (7, near[1]), (7, "its own words and no one else has them"),  # one text of doc_id 7 goes
        (None, base[2]), (None, near[2]), (None, near[2]),  # a class without doc_id keeps one
        (9, base[3]), (9, near[3]), (9, near[3]),  # a class of one doc_id keeps one
        (None, base[4]), (None, near[4]), (11, near[4] + " still"), (12, base[4]),
    ]
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, label int")
    out = corpus_pipeline.near_duplicates(spark, docs, SF)
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert out.columns == docs.columns and len(set(got)) == len(got)
    sure = [(1, base[0]), rows[2], (None, ""), (None, None), (2, base[1]), rows[8], (11, near[4] + " still")]
    assert set(sure) <= set(got)
    left = set(got) - set(sure)
    assert sorted(i or 0 for i, _ in left) == [0, 9]
    assert {t for i, t in left if i is None} <= {base[2], near[2]} and {t for i, t in left if i == 9} <= {base[3], near[3]}
