"""Mining candidate sequences, their contexts and techniques out of text."""

from __future__ import annotations

import functools
import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions import lexicons as lex
from ..functions import patterns as P
from ..functions import text as T

Patterns = dict[str, list[str]]

#: Sources that are files of sequences, and those whose rows are tables.
FILE_SOURCES = ("fasta", "csv", "tsv", "xlsx", "txt")
TABLE_SOURCES = ("csv", "tsv", "xlsx", "fasta")


# ------------------------------------------------------------------ predicates


def distinct_letters(seq: Column) -> Column:
    return F.size(F.array_distinct(F.split(seq, "")))


def contains_any(text: Column, words: list[str]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | text.contains(w)
    return found


def simple(seq: Column) -> Column:
    """Too few kinds of letters: two at most in more than eight, or a short run of common ones."""
    return ((distinct_letters(seq) <= 2) & (F.length(seq) > 8)) | (seq.rlike(f"^[{lex.COMMON_LETTERS}]+$") & (F.length(seq) < 8))


def gene_like(seq: Column, context: Column) -> Column:
    """Named like a gene, or in a context about genes and not about peptides."""
    return seq.rlike(lex.GENE_NAME) | about_genes(context)


def about_genes(context: Column) -> Column:
    return T.bound(F.lower(context), lambda low: contains_any(low, lex.GENE_TERMS) & ~contains_any(low, lex.PEPTIDE_TERMS))


def plausible(seq: Column, blacklist: list[str] = lex.BLACKLIST, titles: list[str] = lex.SECTION_TITLES) -> Column:
    """The checks of a sequence that need no context."""
    sized = F.length(seq).between(lex.MIN_LENGTH, lex.MAX_LENGTH)
    return sized & ~seq.isin(*blacklist) & ~seq.isin(*titles) & seq.rlike(f"^[{lex.AA}]+$") & ~simple(seq)


def likely_peptide(seq: Column, context: Column, **lists: list[str]) -> Column:
    return plausible(seq, **lists) & ~gene_like(seq, context)


#: In a line, a tab or two blanks between two characters that are neither.
_CELLS = r"[^ \t\n\x0B\f\r\x1c-\x1e\x85\u2028\u2029](?:\t|[ \t]{2})[ \t]*[^ \t\n\x0B\f\r\x1c-\x1e\x85\u2028\u2029]"


def table_like(context: Column, keywords: list[str] = lex.TABLE_KEYWORDS) -> Column:
    """A word about tables, or a line of two cells or more."""
    rows = (context.contains("\t") | context.contains("  ")) & context.rlike(_CELLS)
    return T.bound(F.lower(context), lambda low: contains_any(low, keywords)) | rows


def candidate_score(
    seq: Column, context: Column, source: Column, occurrences: Column, is_table: Column, peptide: list[str] = lex.PEPTIDE_KEYWORDS, table: list[str] = lex.TABLE_KEYWORDS, before: str = lex.WORDS_BEFORE, after: str = lex.WORDS_AFTER, near: tuple[Column, Column] | None = None
) -> Column:
    """How much speaks for a sequence: words around it, repeats, its source and its letters.

    near: whether words of before and after stand next to it, where that is known already.
    """
    one = lambda c: F.coalesce(c, F.lit(False)).cast("int")

    def words(low: Column) -> Column:
        said = F.lit(0)
        for weight, listed in ((3, peptide), (5, table)):
            for w in listed:
                said = said + weight * one(low.contains(w))
        return said

    score = T.bound(F.lower(context), words)
    ahead, behind = near or (_ahead(seq, context, before), _behind(seq, context, after))
    letters = distinct_letters(seq)
    rich = F.when((F.length(seq) >= 20) & (letters >= 10), 4).when((F.length(seq) >= 15) & (letters >= 8), 2).otherwise(0)
    score = score + 8 * one(is_table) + 6 * one(ahead) + 6 * one(behind) + 4 * one(source.isin(*FILE_SOURCES)) - one(source == "ocr")
    return F.greatest(score + 2 * F.least(F.greatest(occurrences - 1, F.lit(0)), F.lit(5)).cast("int") + rich, F.lit(0))


def _ahead(seq: Column, context: Column, words: str) -> Column:
    return F.regexp_like(context, F.concat(F.lit("(?iu)" + P.java(rf"\b(?:{words})\W{{0,20}}", True)), seq, F.lit(rf"(?![{P.WORD}])")))


def _behind(seq: Column, context: Column, words: str) -> Column:
    return F.regexp_like(context, F.concat(F.lit(f"(?iu)(?<![{P.WORD}])"), seq, F.lit(P.java(rf"\W{{0,30}}(?:{words})\b", True))))


# ------------------------------------------------------------------ techniques


def technique_names(context: Column, patterns: Patterns = lex.TECHNIQUES) -> Column:
    """Names of techniques that occur anywhere, in lexicon order."""
    tries = [F.when(context.rlike(P.any_of(own)), F.lit(name)) for name, own in patterns.items()]
    return F.array_compact(F.array(*tries))


def technique_lines(context: Column, patterns: Patterns = lex.TECHNIQUES, supersedes: dict[str, list[str]] = lex.SUPERSEDES) -> Column:
    """array<struct<technique, line>>: each technique with its evidence sentence, in lexicon order.

    The first pattern that any sentence matches decides, then the first such sentence.
    General techniques go where a specific one that covers them is there.
    """
    return kernels.evidence(context, patterns, supersedes)


def evidence_score(techniques: Column, weights: dict[str, float] = lex.EVIDENCE_WEIGHTS) -> Column:
    """Sum of the weights of distinct techniques; 1 where there are none or none has a weight."""
    table = F.create_map(*[F.lit(x) for pair in weights.items() for x in (pair[0], float(pair[1]))])
    total = F.aggregate(F.array_distinct(techniques), F.lit(0.0), lambda a, t: a + F.coalesce(F.try_element_at(table, t), F.lit(0.0)))
    return F.when(total > 0, total).otherwise(F.lit(1.0))


def technique_hits(rows: DataFrame, keys: list[str], text: str, source: Column, patterns: Patterns = lex.TECHNIQUES) -> DataFrame:
    """Distinct (keys, technique, statement, source) of sentences that match any pattern of a technique."""
    each = rows.select(*keys, F.explode(T.sentences(F.col(text))).alias("statement"), source.alias("source"))
    return each.select(*keys, "statement", "source", F.explode(technique_names(F.col("statement"), patterns)).alias("technique")).dropDuplicates([*keys, "technique", "statement"])


def first_per_technique(hits: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of hits from several sources the first of each (technique, statement), sources in the given order."""
    rank = F.array_position(F.array(*map(F.lit, order)), F.col("source"))
    return hits.groupBy(*keys, "technique", "statement").agg(F.min_by("source", rank).alias("source"))


def document_species(rows: DataFrame, key: str, text: str, patterns: Patterns = lex.SPECIES) -> DataFrame:
    """(key, species): names whose patterns occur in the text, sorted."""
    return rows.select(key, F.array_sort(technique_names(F.col(text), patterns)).alias("species"))


def document_techniques(rows: DataFrame, key: str, text: str, patterns: Patterns = lex.DOCUMENT_TECHNIQUES) -> DataFrame:
    """(key, techniques): technique to the first line that matches its first matching pattern."""
    return rows.select(key, F.map_from_entries(kernels.line_evidence(F.col(text), patterns)).alias("techniques"))


# ------------------------------------------------------------------ candidates


#: What a sequence looks like before anything else is asked of it.
_LETTERS = f"[{lex.AA}]{{{lex.MIN_LENGTH},{lex.MAX_LENGTH}}}"


def sequences(rows: DataFrame, keys: list[str], text: str, source: str = "pdf_text", pattern: str = lex.CANDIDATE, reach: int = 1000, lines: bool = False, near: tuple[str, str] | None = None, rebuild: bool = False, first: bool = False) -> DataFrame:
    """keys, once for each plausible sequence of a text: sequence, source, occurrences, places (see kernels.sequences)."""
    normal, prepare = _reading(source, rebuild)
    found = kernels.sequences(rows, keys, text, pattern, normal, _LETTERS, reach, lines, near, prepare, first)
    return found.where(plausible(F.col("sequence"))).withColumn("source", F.lit(source))


def _reading(source: str, rebuild: bool) -> tuple:
    """How a source's matches become sequences, and what is done to its texts before they are searched."""
    ocr, blocked = source == "ocr", frozenset(lex.BLACKLIST)
    return (lambda m: T.letters_of(m, ocr)), ((lambda t: T.rebuild(t, blocked)) if rebuild else None)


def rebuilt(rows: DataFrame, keys: list[str], text: str, blacklist: list[str] = lex.BLACKLIST) -> DataFrame:
    """keys and text of rows, hyphenated and spaced-out sequences of the text in one piece."""
    blocked = frozenset(blacklist)
    return kernels.rewritten(rows, keys, text, lambda t: T.rebuild(t, blocked))


def _no_letter(source: str) -> str:
    """Characters that no match has whose sequence is of letters of amino acids alone."""
    return "[" + "".join(c for c in string.ascii_uppercase + "01" if T.letters_of(c, source == "ocr") not in lex.AA) + "]"


def judge(source: str = "pdf_text", keywords: dict | None = None) -> kernels.Judge:
    """What candidate_score and gene_like ask of a place, for the kernels. keywords: other word lists (peptide, table, before, after)."""
    words = {"peptide": lex.PEPTIDE_KEYWORDS, "table": lex.TABLE_KEYWORDS, "before": lex.WORDS_BEFORE, "after": lex.WORDS_AFTER} | (keywords or {})
    return kernels.Judge(words["peptide"], words["table"], (words["before"], words["after"]), lex.GENE_TERMS, lex.PEPTIDE_TERMS, lex.GENE_NAME, 4 * (source in FILE_SOURCES) - (source == "ocr"))


def without_words(found: DataFrame, key: str, words: DataFrame | None) -> DataFrame:
    """found without the sequences that words (key, sequence) lists for their document."""
    return found if words is None else found.join(words, [key, "sequence"], "left_anti")


def scored(rows: DataFrame, keys: list[str], text: str, source: str = "pdf_text", keywords: dict | None = None, least: int | None = None, rebuild: bool = False, evidence: kernels.Listed | None = None) -> DataFrame:
    """keys, once for each plausible sequence of a text: its first accepted place with its score, or without `least` its first place (see kernels.accepted)."""
    normal, prepare = _reading(source, rebuild)
    found = kernels.accepted(rows, keys, text, lex.CANDIDATE, normal, _LETTERS, judge(source, keywords), least, evidence, prepare=prepare, never=_no_letter(source))
    return found.where(plausible(F.col("sequence"))).withColumn("source", F.lit(source))


def mine(rows: DataFrame, key: str, text: str, source: str = "pdf_text", bad_words: DataFrame | None = None, rebuild: bool = True, least: int = 3, techniques: Patterns = lex.TECHNIQUES, supersedes: dict[str, list[str]] = lex.SUPERSEDES, keywords: dict | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Candidates of running text: one row per document and sequence, its first accepted occurrence.

    A text is searched, scored and looked through for techniques in one pass of its row;
    only accepted places leave it. keywords: other word lists for candidate_score, of
    which `table` also tells tables. keep: columns of rows that go along.
    """
    found = scored(rows, [key, *keep], text, source, keywords, least, rebuild, kernels.listed(techniques, supersedes))
    return _finished(without_words(found, key, bad_words).withColumnRenamed("pairs", "_pairs"), [key, *keep])


def mine_tables(rows: DataFrame, key: str, text: str, source: str = "pdf_text", bad_words: DataFrame | None = None, header: str = lex.TABLE_HEADER, techniques: Patterns = lex.TECHNIQUES) -> DataFrame:
    """Candidates of cells in the 19 lines below a header line, with seven lines of context; one row per row of rows and sequence."""
    normal, prepare = _reading(source, True)
    found = kernels.table_matches(rows, key, text, lex.CANDIDATE, normal, _LETTERS, header, judge(source), prepare=prepare)
    found = without_words(found.where(plausible(F.col("sequence"))), key, bad_words).withColumn("source", F.lit(source))
    return _finished(found.withColumn("_pairs", technique_lines(F.col("context"), techniques)), key)


def mine_cells(rows: DataFrame, keys: list[str], cells: Column, context: Column, source: Column, whole: bool = False, techniques: Patterns = lex.TECHNIQUES) -> DataFrame:
    """Candidates of supplementary rows: every match in every cell, or each cell as a whole."""
    found = rows.select(*keys, context.alias("context"), source.alias("source"), F.posexplode(cells).alias("start", "_cell"))
    match = F.array(F.upper("_cell")) if whole else F.transform(F.regexp_extract_all("_cell", F.lit(lex.CANDIDATE), F.lit(0)), F.upper)
    found = found.withColumn("match", F.explode(match)).withColumn("sequence", T.candidate_letters(F.col("match"), F.col("source")))
    found = found.where(likely_peptide(F.col("sequence"), F.col("context")))
    found = found.withColumn("score", candidate_score(F.col("sequence"), F.col("context"), F.col("source"), F.lit(1), F.col("source").isin(*TABLE_SOURCES)))
    return _finished(found.withColumn("sequence_line", F.lit("from supplementary")).withColumn("_pairs", technique_lines(F.col("context"), techniques)), keys)


def _finished(found: DataFrame, keys: str | list[str]) -> DataFrame:
    """Found places with their techniques (_pairs) as candidates."""
    keys = [keys] if isinstance(keys, str) else keys
    names = F.transform("_pairs", lambda p: p["technique"])
    return found.select(
        *keys,
        "start",
        "sequence",
        F.col("match").alias("original_sequence"),
        F.col("sequence").alias("normalized_sequence"),
        F.length("sequence").alias("length"),
        "score",
        "source",
        "context",
        names.alias("techniques"),
        F.transform("_pairs", lambda p: p["line"]).alias("technique_lines"),
        "sequence_line",
        evidence_score(names).alias("evidence_score"),
    )


#: Sequences of a document that one automaton looks for.
TOGETHER = 5_000


def first_page(candidates: DataFrame, pages: DataFrame, key: str, page: str = "page", text: str = "text", rebuild: bool = True) -> DataFrame:
    """candidates with the first page of their document that holds the sequence; null where none does.

    A document's sequences meet its pages as one list (a list for each TOGETHER of them),
    and an automaton of them reads each page once: no page is multiplied by candidates.
    """
    words = ["sequence", "original_sequence"]
    each = candidates.select(key, *words).where(F.col(key).isNotNull()).distinct()
    parts = F.ceil(F.count("*").over(Window.partitionBy(key)) / TOGETHER)
    listed = each.withColumn("_part", F.pmod(F.xxhash64(*words), parts)).groupBy(key, "_part").agg(F.collect_list(F.struct(*words)).alias("_wanted"))
    met = pages.select(key, F.col(page).alias("_page"), F.col(text).alias("_body")).join(listed, key)
    blocked = frozenset(lex.BLACKLIST)
    hits = kernels.pages_with(met, [key, "_part"], "_page", "_body", "_wanted", (lambda t: T.rebuild(t, blocked)) if rebuild else None)
    first = hits.groupBy(key, *words).agg(F.min("_page").alias("page"))
    # an original sequence may be null
    same = [F.col(f"_f.{c}").eqNullSafe(F.col(f"_c.{c}")) for c in (key, *words)]
    out = candidates.alias("_c").join(first.alias("_f"), functools.reduce(lambda x, y: x & y, same), "left")
    return out.select("_c.*", "_f.page")


def llm_candidates(candidates: DataFrame, pages: DataFrame, key: str = "pmid") -> DataFrame:
    """The columns a verifier needs, with the page."""
    return first_page(candidates, pages, key).select(key, "sequence", "original_sequence", "normalized_sequence", "score", "context", "sequence_line", "techniques", "technique_lines", "evidence_score", "source", "page")


def evidence(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates as evidence records; missing techniques and lines are found anew in the context."""
    none = lambda c: F.coalesce(F.size(c), F.lit(0)) == 0
    names = F.when(none("techniques"), technique_names(F.col("context"))).otherwise(F.col("techniques"))
    again = F.transform(technique_lines(F.col("context")), lambda p: p["line"])
    lines = F.when(none("technique_lines") & ~none(names), again).otherwise(F.col("technique_lines"))
    return candidates.select(*keys, "sequence", "original_sequence", "normalized_sequence", "sequence_line", names.alias("techniques"), lines.alias("technique_lines"), F.coalesce("evidence_score", evidence_score(names)).alias("evidence_score"), F.col("context").alias("evidence_text"), "score", "source")


def chunks(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates as evidence chunks: keys, sequence, source and context."""
    return candidates.select(*keys, "sequence", "source", "context")


def abbreviation_words(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, sequence) of each document's own abbreviations."""
    return rows.select(key, F.explode(T.abbreviations(F.col(text))).alias("sequence"))
