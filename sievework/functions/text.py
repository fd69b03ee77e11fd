"""Text functions over Columns, all inside the JVM but for the one that runs to a fixpoint.

Text is taken as it is. Patterns are written for Python and mean in Spark what they mean
there (see `patterns`): white space, digits and word boundaries are those of Unicode.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import lexicons as lex
from . import patterns as P

LINE_BREAK = r"\R|[\x1c-\x1e]"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A[{P.SPACE}]+|[{P.SPACE}]+\z", "")


def fold(text: Column) -> Column:
    """Every character outside ASCII as x: regular expressions of all engines then agree."""
    return F.regexp_replace(text, r"[^\x00-\x7F]", "x")


def lines(text: Column, at: str = LINE_BREAK) -> Column:
    """Lines of a text; a break at its end makes no further line."""
    parts = F.split(text, at)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def sentences(text: Column) -> Column:
    parts = F.split(F.regexp_replace(text, "\n", " "), P.java(r"(?<=[.!?])\s+"))
    return F.filter(F.transform(parts, strip), lambda s: s != "")


def cells(row: Column) -> Column:
    """Cells between tabs or wide gaps; words where there is one cell or none."""
    wide = F.filter(F.transform(F.split(row, P.java(r"\t|\s{2,}")), strip), lambda c: c != "")
    return F.when(F.size(wide) >= 2, wide).otherwise(F.filter(F.split(strip(row), P.java(r"\s+")), lambda c: c != ""))


def replace_each(text: Column, pattern: str, change: Callable[[Column], Column]) -> Column:
    """Every match of pattern replaced by change(match)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    made = F.concat(F.transform(found, change), F.array(F.lit("")))
    return F.array_join(F.zip_with(F.split(text, pattern, -1), made, lambda gap, m: F.concat(gap, F.coalesce(m, F.lit("")))), "")


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# ------------------------------------------------------------------ identifiers and repairs


def pmid(text: Column, otherwise: Column, patterns: list[str] = lex.PMID_PATTERNS) -> Column:
    """The first pattern's first group that occurs anywhere, else the given value."""
    tries = [F.nullif(F.regexp_extract(text, P.java(p, ignore_case=True), 1), F.lit("")) for p in patterns]
    return F.coalesce(*tries, otherwise)


def letters_only(seq: Column) -> Column:
    return F.regexp_replace(F.upper(seq), "[^A-Z]", "")


def join_hyphens(text: Column, letters: str = lex.AA) -> Column:
    """Sequences hyphenated at a line end in one piece; a single pass is the fixpoint."""
    return F.regexp_replace(text, P.java(lex.HYPHEN_BREAK.replace(lex.AA, letters)), "")


def before_back_matter(text: Column, headings: list[str] = lex.BACK_MATTER) -> Column:
    """The lines before the first that is a back-matter heading."""
    heads = "|".join(map(re.escape, headings))
    stop = P.java(rf"\A\s*(?:\[?\d+\]?\.?\s*)?(?:{heads})[.:\s]*\Z", ignore_case=True)
    own = lines(text)
    at = F.array_position(F.transform(own, lambda x: x.rlike(stop)), True)
    return F.array_join(F.when(at > 0, F.slice(own, 1, (at - 1).cast("int"))).otherwise(own), "\n")


def abbreviations(text: Column, heading: str = "Abbreviations") -> Column:
    """Abbreviations listed after the heading, up to a blank line: TERM, meaning; TERM, meaning."""
    body = F.element_at(F.split(F.regexp_extract(text, P.java(rf"(?s){heading}\s*:\s*(.*)", ignore_case=True), 1), "\n\n"), 1)
    terms = F.transform(F.split(body, ";"), lambda p: F.regexp_extract(strip(p), P.java(r"^([A-Za-z0-9]+)\s*,"), 1))
    return F.array_distinct(F.filter(terms, lambda t: t != ""))


def ocr_letters(seq: Column) -> Column:
    """Letters that OCR confuses: 0 and O for Q, 1 for I, I for L."""
    return F.translate(F.upper(seq), lex.OCR_CONFUSED, lex.OCR_MEANT)


def letters_of(match: str, ocr: bool) -> str:
    """candidate_letters of one match, for the kernels."""
    plain = "".join(match.upper().split())
    if not (plain.isascii() and plain.isalpha()):
        plain = _NO_LETTER.sub("", plain)
    return plain.translate(_OCR) if ocr else plain


def candidate_letters(seq: Column, source: Column) -> Column:
    plain = F.regexp_replace(F.upper(seq), "[^A-Z01]", "")
    return F.when(source == "ocr", ocr_letters(plain)).otherwise(plain)


def join_numbered(text: Column, letters: str = lex.AA, at: str = LINE_BREAK, space: str = r"\s") -> Column:
    """Sequence blocks with numbers or spaces between them, joined within a line.

    at: where lines end; space: what counts as a space, as it stands in a class.

    A block is words with gaps between, up to the last word that ends at a boundary. As a
    plain repeat of gap and word, which takes blocks back one by one, Java's search goes
    a few calls deeper with each word, and a long block overflows the stack. Gaps and words
    have no character in common, so nothing within a repeat need be taken back if each
    ends at a boundary: words up to there are those with a digit right behind them.
    """
    word = rf"[{letters}]{{3,}}+"
    block, gap = P.java(rf"\b{word}(?:[{space}\d]++{word}(?:\d[{space}\d]*+{word})*+(?!\w))++"), P.java(rf"[{space}\d]+")
    return F.array_join(F.transform(lines(text, at), lambda x: replace_each(x, block, lambda m: F.regexp_replace(m, gap, ""))), "\n")


_HYPHEN_BREAK, _HYPHEN, _SPACED, _BREAK = (re.compile(p) for p in (lex.HYPHEN_BREAK, lex.HYPHENATED, lex.SPACED_OUT, lex.BROKEN))
_NO_LETTER = re.compile("[^A-Z01]")
_OCR = str.maketrans(lex.OCR_CONFUSED, lex.OCR_MEANT)


#: What texts have that the last and the third of these patterns match in; joining makes none of it where there is none.
_MAY_BREAK, _MAY_SPACE = re.compile(r"-\s*\n"), re.compile(r"[ \t\-][A-Z01][ \t\-]+[A-Z01][ \t\-]")
#: Words with hyphens between, each up to what is neither: no hyphenated sequence reaches beyond.
_HYPHENS = re.compile(r"\b\w++(?:-\w++)++")


def rebuild(text: str, blocked: frozenset[str]) -> str:
    """Hyphenated and spaced-out sequences in one piece, repeated until nothing changes."""
    hyphens = "-" in text
    if not hyphens and " " not in text and "\t" not in text:  # nothing that could be joined
        return text

    def joined(m: re.Match) -> str:
        return m[0] if m[1] in blocked or m[2] in blocked else m[1] + m[2]

    def run(m: re.Match) -> str:
        old, new = m[0], _HYPHEN.sub(joined, m[0])
        while new != old:
            old, new = new, _HYPHEN.sub(joined, new)
        return new

    broken = hyphens and _MAY_BREAK.search(text) is not None
    if broken:
        text = _HYPHEN_BREAK.sub("", text)
    spaced = _MAY_SPACE.search(text) is not None
    if not broken and not spaced:  # runs of hyphens have nothing to do with one another
        return _HYPHENS.sub(run, text) if hyphens else text
    while True:
        new = _HYPHEN.sub(joined, text) if hyphens else text
        new = _SPACED.sub(lambda m: re.sub(r"[ \t\-]+", "", m[0]), new) if spaced else new
        new = _BREAK.sub(r"\1\2", new) if broken else new
        if new == text:
            return text
        text = new


#: Characters of rebuilt texts that are held as strings at once.
HELD = 1_000_000


def rebuilt(texts: pa.Array, blocked: frozenset[str]) -> pa.Array:
    """rebuild of each text; a few texts at a time are strings, the others lie in Arrow's buffers."""
    done, new, held = [], [], 0
    for x in texts:
        t = x.as_py()
        new.append(None if t is None else rebuild(t, blocked))
        held += len(t or "") + 64
        if held > HELD:
            done.append(pa.array(new, pa.string()))
            new, held = [], 0
    return pa.concat_arrays([*done, pa.array(new, pa.string())])


def reconstruct(text: Column, blacklist: list[str] = lex.BLACKLIST) -> Column:
    """rebuild over a column. Each pass depends on what the one before made, so this is an Arrow UDF."""
    blocked = frozenset(blacklist)

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        return rebuilt(column, blocked)

    return run(text)


def merge_numbered_lines(rows: DataFrame, keys: list[str], line: str = "line", number: str = "ln") -> DataFrame:
    """Numbered sequence lines that follow on from one another as one line (gaps and islands).

    rows has one line a row; a line reads START LETTERS [END]. A line continues the one
    before if its START is that one's START plus its length. Returns keys, ln (of the
    first line) and line.
    """
    form = P.java(lex.NUMBERED_LINE)
    seq = F.regexp_replace(F.regexp_extract(line, form, 2), P.java(r"\s+"), "")
    ordered = Window.partitionBy(*keys).orderBy(number)
    parsed = rows.withColumn("_valid", F.col(line).rlike(form) & seq.rlike(rf"^[{lex.AA}]+$")).withColumn("_seq", F.when(F.col("_valid"), seq))
    parsed = parsed.withColumn("_start", F.when(F.col("_valid"), F.regexp_extract(line, form, 1).try_cast("bigint")))
    expected = F.lag(F.col("_start") + F.length("_seq")).over(ordered)
    parsed = parsed.withColumn("_joins", F.coalesce(F.col("_start") == expected, F.lit(False)))
    parsed = parsed.withColumn("_island", F.sum((~F.col("_joins")).cast("int")).over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    parts = F.array_sort(F.collect_list(F.struct(F.col(number).alias("n"), F.col("_seq").alias("s"))))
    merged = parsed.groupBy(*keys, "_island").agg(F.min(number).alias(number), F.count("*").alias("_n"), F.min_by(line, number).alias("_line"), F.array_join(F.transform(parts, lambda p: p.s), "").alias("_whole"))
    return merged.select(*keys, number, F.when(F.col("_n") > 1, F.col("_whole")).otherwise(F.col("_line")).alias(line))


def first_line_with(text: Column, target: Column) -> Column:
    """The first line that holds target, stripped; empty where none does."""
    return F.coalesce(strip(F.get(F.filter(lines(text), lambda x: x.contains(target)), F.lit(0))), F.lit(""))
