"""Patterns mean the same in Spark as in Python, on all of Unicode."""

from __future__ import annotations

import random
import re
import sys

import pytest
from pyspark.sql import functions as F

from sievework.functions import kernels, patterns
from sievework.functions import lexicons as lex
from sievework.functions import text as T
from sievework.operators import mining

LISTED = [p for own in (*lex.TECHNIQUES.values(), *lex.SPECIES.values(), *lex.DOCUMENT_TECHNIQUES.values()) for p in own]
GAPS = [" ", "  ", "\u00a0", "\u2003", "\n", "\x1c", "\x1f", "\u0085", "\u3000", "\u202f", "\u200b", "\t ", "-", ""]
EDGES = ["", " ", "é", "α", "_", "-", "\u0301", "²", "½", "ⅷ", "٣", "中", ".", "(", "\u00a0", "x", "😀", "\ufffd"]
FOLDED = {"s": "ſ", "k": "\u212a", "i": "ıİ", "S": "ſ", "K": "\u212a", "I": "ıİ", "m": "M", "e": "é"}


def shown(pattern: str, rng: random.Random) -> str:
    """A text that a pattern nearly or wholly matches."""
    own, _ = patterns.tokens(pattern)
    out, depth = "", 0
    for token in own:
        depth += (token.kind == "open") - (token.kind == "close")
        if token.kind == "char":
            c = token.value
            out += rng.choice(FOLDED[c]) if c in FOLDED and rng.random() < 0.06 else c.swapcase() if rng.random() < 0.2 else c
        elif token.kind in ("class", "set"):
            out += rng.choice(GAPS)
    return rng.choice(EDGES) + out + rng.choice(EDGES)


def agree(spark, tried: list[str], texts: list[str], flags: int = re.IGNORECASE) -> None:
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    hits = F.array(*[F.col("t").rlike(patterns.java(p, bool(flags & re.IGNORECASE))) for p in tried])
    found = {r.i: r.h for r in rows.select("i", hits.alias("h")).collect()}
    own = [re.compile(p, flags) for p in tried]
    wrong = [(p.pattern, t) for i, t in enumerate(texts) for p, hit in zip(own, found[i], strict=True) if hit != bool(p.search(t))]
    assert not wrong, wrong[:5]


def test_lexicon_over_texts_of_all_kinds(spark):
    rng = random.Random(7)
    texts = [" ".join(shown(rng.choice(LISTED), rng) for _ in range(rng.randint(1, 3))) for _ in range(400)] + [shown(p, rng) for p in LISTED for _ in range(4)]
    agree(spark, LISTED, texts)
    assert sum(bool(re.search(p, t, re.I)) for p, t in zip([p for p in LISTED for _ in range(4)], texts[400:], strict=True)) > 60


def test_every_construct(spark):
    tried = [r"a.c", r"^ab$", r"\Aab\Z", r"\bab\b", r"\Bb", r"[^\s\d]x", r"[\W_]+z", r"\S\D\W", r"a{,2}b", r"(a|b)+?c", r"(?<=\s)a", r"(?<!\w)a(?!\s)", r"[a-f]x", r"[&\[\]^-]q", r"\x41\u00e9", r"a*\b", r"x?\by", r"[]a]k", r"(?:a|\b)b", r"\d+\b\s*\d", r"s[k-m]i", r"[\b]", r"\.\-\t"]
    rng = random.Random(3)
    texts = ["".join(rng.choices("abcxyzq kſ\u212aıiİsSKI\n\r\u0085\u2028\u00a0\x1c\x1d_-&[]^.\té²٣1Aλ中\b", k=rng.randint(0, 9))) for _ in range(3000)]
    agree(spark, tried, texts)
    agree(spark, tried, texts, 0)
    agree(spark, [r"(?m)^b$", r"(?s)a.b", r"(?i)k"], texts, 0)


@pytest.mark.parametrize("one", [r"\s", r"\d", r"\w", r"\S", r"\W"])
def test_classes_over_all_characters(spark, one):
    every = spark.range(sys.maxunicode + 1).where("id < 55296 or id > 57343").select("id", F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')").alias("c"))
    known = every.where(F.col("c").rlike(r"\A\P{Cn}\z"))  # those that Java's Unicode knows
    got = {r.id for r in known.where(F.col("c").rlike(rf"\A(?:{patterns.java(one)})\z")).select("id").collect()}
    asked = {r.id for r in known.select("id").collect()}
    assert len(asked) > 140_000
    assert got == {c for c in asked if re.fullmatch(one, chr(c))}


def test_what_is_refused():
    for bad in (r"(?P<n>a)", r"(a)\1", r"(?i:a)", r"(?(1)a|b)", r"\N{DASH}", r"(?x)a"):
        with pytest.raises(ValueError):
            patterns.java(bad)


def test_literals_and_widths():
    assert patterns.literal(r"\bEdman\s+degradation\b") == "degradation"
    assert patterns.literal(r"a|b") == "" and patterns.literal(r"(?:ab|c)de") == "de" and patterns.literal(r"abc?d") == "ab"
    assert patterns.literal(r"\bX[\-]ray\s+crystal\w*\b") == "crystal"
    assert patterns.width("peptide|sequence|residues?") == 8
    assert patterns.width("a{2,5}(?:bc|d)") == 7 and patterns.width(r"a\s+b") is None and patterns.width("a{3,}") is None and patterns.width(r"(?<=xx)a\b") == 1
    for p in LISTED:
        assert patterns.literal(p) in re.sub(r"\\.|[\[\](?:!.*)]", " ", p).lower() or patterns.literal(p)


def test_techniques_are_the_same_in_both_engines(spark):
    text = "By Edman\u00a0degradation of Zea\u00a0mays. We used SDS\u2003PAGE!\u00a0Also maldi\u00a0tof and ELİSA."
    row = spark.createDataFrame([(1, text)], "k int, t string")
    names = row.select(mining.technique_names(F.col("t"))).first()[0]
    lines = row.select(mining.technique_lines(F.col("t"))).first()[0]
    assert names == ["MALDI-TOF", "Edman Sequencing", "SDS-PAGE", "ELISA"] == [p.technique for p in lines]
    assert mining.document_species(row, "k", "t").first().species == ["Zea mays (maize)"]
    assert row.select(T.sentences(F.col("t"))).first()[0] == [s.strip() for s in re.split(r"(?<=[.!?])\s+", text)]
    assert kernels.Evidence(tuple((n, tuple(p)) for n, p in lex.TECHNIQUES.items()), ()).pairs(text)[0][0] == "MALDI-TOF"
