from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.llm import fim, line_dedup

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = "This line is long enough to count"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ------------------------------------------------------------------ lines


def lines_by_force(rows: list[tuple], least: int = 20, documents: int = 3) -> list[tuple]:
    key = lambda line: line.strip(SPACE).translate(LOWER)
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                holders[key(line)].add(-1 if doc is None else doc)
    out = []
    for doc, text in rows:
        own = (text or "").split("\n")
        kept = [x for x in own if len(key(x)) < least or len(holders[key(x)]) < documents or max(holders[key(x)]) == (-1 if doc is None else doc)]
        out.append((doc, len(own), len(own) - len(kept), sha("\n".join(kept))))
    return sorted(out, key=repr)


def lines_of(spark, rows: list[tuple], partitions: int = 3) -> list[tuple]:
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, keep string, h1 int").repartition(partitions)
    return sorted([tuple(r) for r in line_dedup.digests(docs).collect()], key=repr)


CASES = {
    "none": [],
    "null and empty": [(1, None), (2, ""), (3, "\n"), (4, "\n\n x")],
    "white space and case": [(1, f"  {LONG}\t"), (2, LONG.upper() + "\r"), (3, f"a\n\x0b{LONG}\nb"), (4, LONG + " ")],
    "twenty code points": [(i, "é" * 20 + "\n" + "é" * 19 + "\n" + "ü" * 10) for i in range(4)],
    "upper case outside A-Z stays": [(i, ("Ä" if i else "ä") * 25) for i in range(3)],
    "two documents are too few": [(1, LONG), (2, LONG), (2, LONG + "\nx")],
    "repeated inside": [(1, f"{LONG}\n{LONG}"), (2, LONG), (9, f"{LONG}\nb\n{LONG}\n{LONG}")],
    "repeated rows": [(1, LONG), (1, LONG), (2, LONG), (2, LONG), (3, LONG), (3, LONG)],
    "no doc_id": [(None, LONG), (None, "x\n" + LONG), (5, LONG), (6, LONG), (None, None)],
    "only without doc_id": [(None, LONG + "\n" + str(i)) for i in range(5)],
    "zero bytes": [(i, "\x00" * 25 + "\nab") for i in range(4)],
}


@pytest.mark.parametrize("name", CASES)
def test_lines_of_cases(spark, name):
    assert lines_of(spark, CASES[name]) == lines_by_force(CASES[name])


def test_lines_whatever_the_ranges(spark, monkeypatch):
    """A key that most rows share, dealt over many ranges, with rows that are held and handed on."""
    rng = random.Random(5)
    pool = [f"line number {i} of those that are long" for i in range(40)]
    rows = [(rng.randint(1, 250) if rng.random() < 0.9 else None, "\n".join([LONG] * (i % 3 > 0) + rng.choices(pool, k=rng.randint(0, 6)) + [f"own line of the row with number {i}"])) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = lines_by_force(rows)
    for partitions in ("1", "7", "60"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            assert sorted([tuple(r) for r in line_dedup.digests(docs).collect()], key=repr) == expected, partitions
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_rows_of_one_document_beyond_what_is_held(monkeypatch):
    monkeypatch.setattr(line_dedup, "HELD", 2)
    runs = line_dedup.Runs(3)
    runs.add((0, 0, 9, 1, 1, [0]))
    rows = [(1, 1, 8, 1, 1, [0]), *[(1, 1, 7, k, 1, [0]) for k in range(5)], (1, 1, 6, 1, 1, [0])]
    for r in rows:
        runs.add(r)
    runs.add((2, 2, 1, 1, 1, [0]))
    runs.close(last=True)
    kinds = [r[0] for r in runs.out]
    assert kinds.count(line_dedup.GOES) == 0 and kinds.count(line_dedup.OPEN) == 7  # the first key's row and all but the first of the second
    assert {r[1]: (r[3], r[8]) for r in runs.out if r[0] == line_dedup.TOTAL} == {0: (9, 1), 1: (8, 3), 2: (1, 1)}


def test_long_texts_of_lines(spark):
    rows = [(1, "\n".join(f"line {i % 5000} of a very long text" for i in range(60_000))), (2, "x" * 3_000_000), (3, "\n".join(f"line {i} of a very long text" for i in range(5000))), (4, "line 17 of a very long text\n" + "x" * 3_000_000)]
    rows += [(5, "x" * 3_000_000)]
    assert lines_of(spark, rows) == lines_by_force(rows)


def test_lines_by_row_or_by_broadcast(spark, monkeypatch):
    rows = [(i, f"{LONG}\n{LONG} {i % 4}\n{i}") for i in range(50)]
    few = lines_of(spark, rows)
    monkeypatch.setattr(line_dedup, "BITMAPS", 3)
    assert lines_of(spark, rows) == few == lines_by_force(rows)


def test_texts_without_lines_that_go(spark):
    docs = spark.createDataFrame([(i, None if i == 3 else f"{LONG}\n{i}é", i) for i in range(5)], "doc_id long, text string, n_chars int")
    out = {r.doc_id: r for r in line_dedup.remove_lines(docs).collect()}
    assert [out[i].text for i in range(5)] == ["0é", "1é", "2é", None, f"{LONG}\n4é"]
    assert [out[i].n_chars for i in range(5)] == [2, 2, 2, None, len(LONG) + 3]


def test_bitmaps():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randint(1, 300)
        gone = sorted(rng.sample(range(n), rng.randint(1, n)))
        keep = line_dedup.stays(line_dedup.bitmap(gone), n).tolist()
        assert [i for i in range(n) if not keep[i]] == gone
    assert len(line_dedup.bitmap(list(range(0, 1_000_000, 2)))) < 1000


# ------------------------------------------------------------------ middles


def middle_by_force(doc: int | None, text: str | None) -> tuple:
    text, digest = text or "", hashlib.sha256(b"1:" + (b"" if doc is None else str(doc).encode())).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(text) + 1) for x in h[:2])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc, len(text), "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return doc, len(text), "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc, len(text), "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def check_middles(spark, rows: list[tuple]) -> list[str]:
    docs = spark.createDataFrame([(d, t, "clash") for d, t in rows], "doc_id long, text string, Output string")
    expected = sorted([middle_by_force(*r) for r in rows], key=repr)
    out = fim.restore(fim.transform(docs))
    got = out.collect()
    assert sorted([(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got], key=repr) == expected
    assert all(r.restored == (r.text or "") for r in got)
    shown = sorted([tuple(r) for r in fim.digests(docs).collect()], key=repr)
    assert shown == sorted([(*e[:5], sha(e[5]), sha(t or "")) for e, (_, t) in zip([middle_by_force(*r) for r in rows], rows, strict=True)], key=repr)
    return [r.form for r in got]


def test_middles_of_cases(spark):
    texts = [None, "", "a", "é", "😀", "<", "<P", "<P>", "x<S>", "<M", ">", "<<P>>", "<P<P", "<S >", "P>", "a<M>b", "\x00<\x00", "𐍈<é>P" * 30, "<P" * 700, "né" * 900, "word " * 3000, "😀" * 2000 + "<M", "x" * 1023 + "<P>", "x" * 1022 + "<P>", "é" * 511 + "x<S>"]
    rows = [(7 * i + 40, t) for i, t in enumerate(texts)] + [(i, f"text {i} of many ü") for i in range(120)] + [(None, "no number"), (None, None), (5, "twice"), (5, "twice")]
    assert set(check_middles(spark, rows)) == {"plain", "psm", "spm"}
    assert fim.digests(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_middles_of_long_texts(spark):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choices("ab<>PSM é😀中\n", weights=[9, 9, 1, 1, 1, 1, 1, 5, 2, 2, 2, 1], k=rng.choice([10, 1000, 40_000])))) for i in range(40)]
    rows += [(100, "é<" * 900_000), (101, "z" * 2_500_000 + "<M>"), (102, "z" * 2_500_000)]
    check_middles(spark, rows)


def test_scan_counts_as_decoding_does():
    rng = random.Random(1)
    for _ in range(40):
        texts = ["".join(rng.choices("a<PSM>é中😀", k=rng.choice([0, 1, 5, 1500, 4000]))) for _ in range(6)]
        raw = [t.encode() for t in texts]
        data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(r) for r in raw]))
        found = fim.Scanned(data, offsets)
        assert found.n.tolist() == [len(t) for t in texts]
        assert found.marked.tolist() == [any(s in t for s in ("<P>", "<S>", "<M>")) for t in texts]
        which = np.array([i for i, t in enumerate(texts) for _ in range(4)], np.int64)
        char = np.array([rng.randint(0, len(t)) for t in texts for _ in range(4)], np.int64)
        assert found.places(which, char).tolist() == [int(offsets[i]) + len(texts[i][:c].encode()) for i, c in zip(which.tolist(), char.tolist(), strict=True)]


def test_nothing_moves_between_tasks_for_middles(spark):
    plan = fim.digests(spark.range(3).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
