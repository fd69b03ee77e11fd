"""Comparing what was found with a gold standard."""

from __future__ import annotations

import difflib
import string

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicons as lex
from ..functions import text as T


def gold_pairs(rows: DataFrame, pmid: str = "pmid", seq: str = "sequence") -> DataFrame:
    """Distinct (pmid, sequence), letters only, without empty values."""
    out = rows.select(F.trim(F.col(pmid).cast("string")).alias("pmid"), T.letters_only(F.col(seq)).alias("sequence"))
    return out.where("pmid <> '' and sequence <> ''").distinct()


def gold_stanzas(lines: DataFrame, keys: list[str], order: str, line: str, head: str = r"(?i)^PMID[:\s]+(\d+)", body: str = r"^[ACDEFGHIKLMNPQRSTVWY]{4,}$") -> DataFrame:
    """(keys, pmid, sequence) of lines below a `PMID: n` line, which opens a block."""
    text = T.strip(F.col(line))
    mark = F.nullif(F.regexp_extract(text, head, 1), F.lit(""))
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    filled = lines.withColumn("pmid", F.last(mark, ignorenulls=True).over(upto)).withColumn("sequence", text)
    return filled.where(mark.isNull() & F.col("pmid").isNotNull() & F.col("sequence").rlike(body)).select(*keys, "pmid", "sequence").distinct()


def gold_match(rows: DataFrame, gold: DataFrame, pmid: str = "pmid", seq: str = "sequence") -> DataFrame:
    """rows with gold_match: true or false, null where the document has no gold."""
    hits = gold.select(F.col("pmid").alias("_p"), F.col("sequence").alias("_s"), F.lit(True).alias("_hit")).distinct()
    known = gold.select(F.col("pmid").alias("_k")).distinct()
    out = rows.join(hits, (F.col(pmid) == F.col("_p")) & (F.upper(seq) == F.col("_s")), "left").join(known, F.col(pmid) == F.col("_k"), "left")
    return out.withColumn("gold_match", F.when(F.col("_k").isNotNull(), F.coalesce("_hit", F.lit(False)))).drop("_p", "_s", "_hit", "_k")


def confusion(found: DataFrame, gold: DataFrame, keys: tuple[str, str] = ("pmid", "sequence")) -> DataFrame:
    """(pmid, tp, fp, fn) of every document in either; duplicates count once."""
    both = found.select(*keys).distinct().withColumn("_f", F.lit(1)).join(gold.select(*keys).distinct().withColumn("_g", F.lit(1)), list(keys), "full")
    hit = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0)).cast("long")
    f, g = F.col("_f").isNotNull(), F.col("_g").isNotNull()
    return both.groupBy(keys[0]).agg(hit(f & g).alias("tp"), hit(f & ~g).alias("fp"), hit(~f & g).alias("fn"))


def ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def micro(counts: DataFrame) -> DataFrame:
    """One row: totals, precision, recall and F1; 0 where nothing is there to divide by."""
    total = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("tp", "fp", "fn")])
    total = total.withColumn("precision", ratio(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", ratio(F.col("tp"), F.col("tp") + F.col("fn")))
    return total.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def rolled_up(counts: DataFrame) -> DataFrame:
    """Counts by document and, with a null pmid, in all."""
    return counts.rollup("pmid").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])


def report(totals: DataFrame) -> DataFrame:
    """The totals as lines of a report (value)."""
    counts = [F.format_string(f"{name}: %d", c) for name, c in zip(lex.REPORT_COUNTS, ("tp", "fp", "fn"), strict=True)]
    shares = [F.format_string(f"{name}: %.4f", c) for name, c in zip(lex.REPORT_SHARES, ("precision", "recall", "f1"), strict=True)]
    lines = [*map(F.lit, lex.REPORT_HEAD), *counts, F.lit(""), *shares, *map(F.lit, lex.REPORT_TAIL)]
    return totals.select(F.posexplode(F.array(*lines)).alias("no", "value")).select("value")


def ratio_bound(a: Column, b: Column) -> Column:
    """What the matching-blocks ratio of two texts of the letters A to Z can be at most: by the letters they share, however ordered."""
    times = lambda text: F.array(*[F.length(text) - F.length(F.replace(text, F.lit(c), F.lit(""))) for c in string.ascii_uppercase])
    shared = F.aggregate(F.zip_with(times(a), times(b), lambda x, y: F.least(x, y)), F.lit(0), lambda n, x: n + x)
    whole = F.length(a) + F.length(b)
    return F.when(whole > 0, 2 * shared / whole).otherwise(F.lit(1.0))


def similar_to_gold(rows: DataFrame, gold: DataFrame, least: float = 0.85, pmid: str = "pmid", seq: str = "sequence") -> DataFrame:
    """rows with similar: whether a gold sequence of the document is nearly the same (matching-blocks ratio).

    Lengths, then letters, bound the ratio from above; blocks are matched only in pairs
    that can reach it. A gold sequence of the same letters needs no matching.
    """

    @F.pandas_udf("double")
    def ratio_of(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")

    own = rows.select(pmid, F.col(seq).alias("_a"), T.letters_only(F.col(seq)).alias("_l")).distinct()
    known = gold.select(F.col("pmid").alias("_p"), F.col("sequence").alias("_b")).distinct()
    a, b = F.col("_l"), F.col("_b")
    fits = (F.col(pmid) == F.col("_p")) & (2 * F.least(F.length(a), F.length(b)) >= least * (F.length(a) + F.length(b)))
    pairs = own.join(known, fits).where((a == b) | (ratio_bound(a, b) >= least))
    same = pairs.where(a == b)
    near = pairs.where(a != b).withColumn("_r", ratio_of(a, b)).where(F.col("_r") >= least).drop("_r").unionByName(same)
    near = near.select(F.col(pmid).alias("_p"), "_a").distinct().withColumn("_near", F.lit(True))
    return rows.join(near, (F.col(pmid) == F.col("_p")) & (F.col(seq) == F.col("_a")), "left").withColumn("similar", F.coalesce("_near", F.lit(False))).drop("_p", "_a", "_near")
