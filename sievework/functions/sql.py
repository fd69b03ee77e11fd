"""The functions for SQL: text and score functions as SQL expressions, parsing of FASTA as a table function."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import lexicons as lex


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


_WEIGHTS = ", ".join(f"{_quoted(k)}, {float(v)}D" for k, v in lex.EVIDENCE_WEIGHTS.items())

#: Name and parameters, type, and the expression.
FUNCTIONS = [
    ("normalize_sequence(s STRING)", "STRING", "regexp_replace(upper(s), '[^A-Z]', '')"),
    ("ocr_letters(s STRING)", "STRING", f"translate(upper(s), '{lex.OCR_CONFUSED}', '{lex.OCR_MEANT}')"),
    ("normalize_candidate(s STRING, source STRING)", "STRING", f"CASE WHEN source = 'ocr' THEN translate(regexp_replace(upper(s), '[^A-Z01]', ''), '{lex.OCR_CONFUSED}', '{lex.OCR_MEANT}') ELSE regexp_replace(upper(s), '[^A-Z01]', '') END"),
    ("join_hyphens(t STRING)", "STRING", f"regexp_replace(t, {_quoted(lex.HYPHEN_BREAK)}, '')"),
    ("split_sentences(t STRING)", "ARRAY<STRING>", r"filter(transform(split(replace(t, '\n', ' '), '(?<=[.!?])\\s+'), x -> trim(x)), x -> x <> '')"),
    ("length_score(n DOUBLE, median DOUBLE)", "DOUBLE", "greatest(0D, 1 - abs(n - median) / greatest(median, 1D))"),
    ("sequence_validity(s STRING)", "DOUBLE", f"CASE WHEN s = '' THEN NULL ELSE length(regexp_replace(s, '[^{lex.AA}]', '')) / length(s) END"),
    ("evidence_score(techniques ARRAY<STRING>)", "DOUBLE", f"CASE aggregate(array_distinct(techniques), 0D, (a, t) -> a + coalesce(try_element_at(map({_WEIGHTS}), t), 0D)) WHEN 0D THEN 1D ELSE aggregate(array_distinct(techniques), 0D, (a, t) -> a + coalesce(try_element_at(map({_WEIGHTS}), t), 0D)) END"),
]


class _Fasta:
    """Records of a FASTA text; lines before the first header make a record without one."""

    def eval(self, text: str) -> Iterator[tuple[str, str, str]]:
        head, parts = "", []
        for line in [*(text or "").splitlines(), ">"]:
            if not line.startswith(">"):
                parts.append("".join(line.split()).upper())
                continue
            if seq := "".join(parts):
                yield (head.split() or [""])[0], head, seq
            head, parts = line[1:], []


def register(spark: SparkSession) -> None:
    """Makes the functions known to a session's SQL, and the table function fasta(text)."""
    for head, kind, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS {kind} RETURN {body}")
    spark.udtf.register("fasta", F.udtf(_Fasta, returnType="id string, description string, seq string"))
