from __future__ import annotations

import random

from pyspark.sql import functions as F

from sievework.functions import kernels
from sievework.operators import merging, mining

SCHEMA = "g int, i int, score int, techniques array<string>, technique_lines array<string>, evidence_score double"


def test_a_hundred_thousand_rows_of_one_sequence(spark):
    """One key with all rows: the winner far in, lines that come again and again."""
    i = F.col("id").cast("int")
    rows = spark.range(100_000).select(F.lit(1).alias("g"), i.alias("i"), F.when(i == 40_000, 9).otherwise(i % 7).alias("score"), F.array(F.concat(F.lit("T"), i % 30)).alias("techniques"), F.array(F.concat(F.lit("l"), (i % 1000).cast("string")), F.lit("same")).alias("technique_lines"), F.lit(0.0).alias("evidence_score"))
    row = merging.merge_candidates(rows, ["g"], ["i"]).collect()
    assert len(row) == 1 and row[0].i == 40_000 and row[0].score == 9
    assert row[0].techniques == sorted(f"T{k}" for k in range(30))
    assert row[0].technique_lines == ["l0", "same", *[f"l{k}" for k in range(1, 1000)]]


def test_aligned_merge_takes_the_first_line_of_each_technique(spark):
    rng, groups = random.Random(8), {}
    for g in range(150):
        groups[g] = []
        for _ in range(rng.randint(1, 5)):
            names = rng.sample("ABCD", rng.randint(0, 3))
            groups[g].append((rng.randint(0, 3), names, [f"{n}{rng.randint(0, 9)}" for n in names]))
    data = [(g, i, s, t, x, 0.0) for g, rows in groups.items() for i, (s, t, x) in enumerate(rows)]
    got = {r.g: list(zip(r.techniques, r.technique_lines, strict=True)) for r in merging.merge_candidates(spark.createDataFrame(data, SCHEMA), ["g"], ["i"], aligned=True).collect()}
    for g, rows in groups.items():
        top = max(s for s, _, _ in rows)
        k = next(k for k, r in enumerate(rows) if r[0] == top)
        wanted: dict = {}
        for _, names, lines in rows[k:]:
            for n, x in zip(names, lines, strict=True):
                wanted.setdefault(n, x)
        assert got[g] == list(wanted.items())


def test_rows_without_a_key_are_one_group(spark):
    rows = spark.createDataFrame([(None, 1, 5, ["B"], ["x"], 1.0), (None, 2, 3, ["A"], ["y", "x"], 1.0), (3, 1, 0, [], [], 1.5)], SCHEMA)
    got = sorted(((r.g, r.i, r.techniques, r.technique_lines) for r in merging.merge_candidates(rows, ["g"], ["i"]).collect()), key=str)
    assert got == [(3, 1, [], []), (None, 1, ["A", "B"], ["x", "y"])]
    assert merging.merge_candidates(rows.limit(0), ["g"], ["i"]).collect() == []


def test_first_page_is_the_least_that_holds_either(spark, monkeypatch):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("ABC") for _ in range(rng.randint(0, 4)))
    pages = [(rng.randint(1, 4), p, rng.choice([None, "", " ".join(word() for _ in range(8))])) for p in range(60)]
    wanted = [(rng.randint(1, 5), word(), rng.choice([None, word()]), k) for k in range(300)]
    frames = spark.createDataFrame(wanted, "pmid int, sequence string, original_sequence string, k int"), spark.createDataFrame(pages, "pmid int, page int, text string")

    def page_of(doc, one, other):
        return min((p for d, p, t in pages if d == doc and t is not None and (one in t or (other is not None and other in t))), default=None)

    expected = sorted((k, page_of(d, s, o)) for d, s, o, k in wanted)
    for together in (5000, 3):
        monkeypatch.setattr(mining, "TOGETHER", together)
        out = mining.first_page(*frames, "pmid", rebuild=False)
        assert out.columns == ["pmid", "sequence", "original_sequence", "k", "page"]
        assert sorted(((r.k, r.page) for r in out.collect())) == expected


def test_lines_found_by_automaton_and_by_search(monkeypatch):
    rng = random.Random(9)
    for _ in range(100):
        text = "".join(rng.choices("ab \n", k=rng.randint(0, 60)))
        targets = ["".join(rng.choices("ab \n", k=rng.randint(0, 4))) for _ in range(10)]
        found = []
        for most in (0, 10**9):
            monkeypatch.setattr(kernels, "SEARCHED", most)
            found.append(kernels.Lines(text).firsts(targets))
        assert found[0] == found[1] == [kernels.Lines(text).first_with(t) for t in targets]
