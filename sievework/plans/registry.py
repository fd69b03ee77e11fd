"""Where queries and the SQL that checks them are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

#: Lexicons in words of the driver's texts, which know nothing of the domain.
TECHNIQUES = {"Alpha": [r"\bthing\b", r"\bhand\b"], "Beta": [r"\bthat\b"], "Gamma": [r"\bheat\b", r"\bwhat\b", r"\bque\b"], "Delta": [r"\bunter\b"]}
SUPERSEDES = {"Alpha": ["Beta"]}
WEIGHTS = {"Alpha": 4, "Beta": 2, "Gamma": 3}
SPECIES = {"Prima": [r"\bthing\b", r"\bles\b"], "Secunda": [r"\bund\b"], "Tertia": [r"\bdel\b", r"\bhand\b"]}
#: The same for texts as they are.
RAW_TECHNIQUES = {"Alpha": [r"\bthing\b", r"\bhand\b"], "Beta": [r"\bthat\b", r"\bfür\b"], "Gamma": [r"\bheat\b", r"\béou\b", r"\bque\b"], "Delta": [r"\bunter\b", r"\bétion\b"]}
PEPTIDE_WORDS = ["thing", "hand"]
TABLE_WORDS = ["heat", "reand"]
HEADINGS = ["Les", "Thing", "Die", "Of onthshes"]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLE_SQL[name] = sql
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def upper(text: str = "text") -> Column:
    return F.upper(T.fold(F.col(text)))


def folded(spark: SparkSession, sf_dir: str, how: Column | None = None) -> DataFrame:
    """(doc_id, lang, text): documents with every character outside ASCII as x."""
    return table(spark, sf_dir, "documents").select("doc_id", "lang", (T.fold(F.col("text")) if how is None else how).alias("text"))


# ------------------------------------------------------------------ SQL

FOLD = r"regexp_replace(text, '[^\x00-\x7F]', 'x', 'g')"
UP = f"upper({FOLD})"
AA = "ACDEFGHIKLMNPQRSTVWY"
TOKEN = f"[{AA}]{{6,}}"


def sql_any(text: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


def sql_list(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def sql_letters(seq: str) -> str:
    return f"len(list_distinct(string_split({seq}, '')))"


def sql_simple(seq: str) -> str:
    return f"(({sql_letters(seq)} <= 2 AND length({seq}) > 8) OR (regexp_full_match({seq}, '[AEILNSTR]+') AND length({seq}) < 8))"


def sql_plausible(seq: str, blacklist: list[str], titles: list[str]) -> str:
    return f"(length({seq}) BETWEEN 6 AND 120 AND {seq} NOT IN ({sql_list([*blacklist, *titles])}) AND regexp_full_match({seq}, '[{AA}]+') AND NOT {sql_simple(seq)})"


def sql_gene(seq: str, context: str, genes: list[str], peptides: list[str]) -> str:
    return f"(regexp_full_match({seq}, '[A-Z]{{2,6}}[0-9]{{1,3}}[A-Z]?') OR ({sql_any(f'lower({context})', genes)} AND NOT {sql_any(f'lower({context})', peptides)}))"


LINES = "string_split({0}, chr(10))"
SENTENCES = r"list_filter(list_transform(string_split(regexp_replace(replace({0}, chr(10), ' '), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: trim(s)), lambda s: s <> '')"


def sql_technique(context: str, patterns: dict[str, list[str]]) -> str:
    """A list of the names whose patterns occur in a text."""
    return "list_filter([" + ", ".join(f"CASE WHEN regexp_matches({context}, '(?i){'|'.join(p)}') THEN '{n}' END" for n, p in patterns.items()) + "], lambda x: x IS NOT NULL)"


def sql_bounded(pattern: str) -> str:
    r"""RE2's word boundaries know ASCII alone: a pattern \bword\b with those of Unicode."""
    inner = pattern.removeprefix(r"\b").removesuffix(r"\b")
    return rf"(?i)(?:^|[^\pL\pN_]){inner}(?:$|[^\pL\pN_])"


def sql_hits(text: str, patterns: dict[str, list[str]]) -> str:
    """A list of the patterns that a text matches, as {name, name_no, pattern_no}."""
    tries = [f"CASE WHEN regexp_matches({text}, '{sql_bounded(p)}') THEN {{'name': '{n}', 'name_no': {i}, 'pattern_no': {j}}} END" for i, (n, own) in enumerate(patterns.items()) for j, p in enumerate(own)]
    return f"list_filter([{', '.join(tries)}], lambda x: x IS NOT NULL)"


def sql_names(text: str, patterns: dict[str, list[str]]) -> str:
    """A list of the names whose patterns occur in a text, whatever its script."""
    return "list_filter([" + ", ".join("CASE WHEN " + " OR ".join(f"regexp_matches({text}, '{sql_bounded(p)}')" for p in own) + f" THEN '{n}' END" for n, own in patterns.items()) + "], lambda x: x IS NOT NULL)"
