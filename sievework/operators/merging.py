"""Merging candidates of one sequence from several lists."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import store
from .mining import evidence_score


def merge_candidates(rows: DataFrame, keys: list[str], order: list[str], aligned: bool = False) -> DataFrame:
    """One row per keys: the first with the highest score, with techniques of those after it.

    A better row takes the place of all before it, with what they had gathered; rows
    after the winner add their techniques (sorted, if any row came after) and lines they
    do not have yet. So only the winner and later rows count. The winner is the least of
    (score from the top, place), later techniques are a set and later lines the least
    place of each: all of them states that Spark merges before it shuffles, so a sequence
    may have any number of rows. rows are stored, since they are read twice.
    aligned keeps lines beside their techniques instead: (technique, line) pairs, first wins.
    """
    rows = store(rows, "candidates")
    place = F.struct(*order)
    winners = rows.groupBy(*keys).agg(F.min_by(F.struct(*rows.columns), F.struct((-F.col("score")).alias("score"), *order)).alias("_won"))
    first = winners.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.struct(*[F.col(f"_won.{c}") for c in order]).alias("_first"))
    same = lambda own: functools.reduce(lambda x, y: x & y, [F.col(f"_k{i}").eqNullSafe(F.col(k)) for i, k in enumerate(own)])
    later = rows.select(*keys, place.alias("_place"), "techniques", "technique_lines").join(first, same(keys)).where(F.col("_place") > F.col("_first"))

    def in_order(each: DataFrame, value: Column, name: str) -> DataFrame:
        """(keys, name): the distinct values of each row of (keys, _place, _at, value) as they first came, each with its line."""
        once = each.groupBy(*keys, value.alias("_v")).agg(F.min_by("_line", F.struct("_place", "_at")).alias("_line"), F.min(F.struct("_place", "_at")).alias("_when"))
        return once.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_when", "_v", "_line"))).alias(name))

    if aligned:
        pairs = later.select(*keys, "_place", F.posexplode(F.arrays_zip("techniques", "technique_lines")).alias("_at", "_p")).select(*keys, "_place", "_at", F.col("_p.techniques").alias("_v"), F.col("_p.technique_lines").alias("_line"))
        added = in_order(pairs, F.col("_v"), "_lines")
    else:
        lines = later.select(*keys, "_place", F.posexplode("technique_lines").alias("_at", "_v")).withColumn("_line", F.col("_v"))
        added = in_order(lines, F.col("_v"), "_lines")
    names = later.select(*keys, F.explode_outer("techniques").alias("_t")).groupBy(*keys).agg(F.collect_set("_t").alias("_names"))
    out = winners
    for table in (names, added):
        renamed = table.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], table.columns[-1])
        out = out.join(renamed, same(keys), "left").drop(*[f"_k{i}" for i in range(len(keys))])
    kept = out.select(*[F.col(f"_won.{c}") for c in rows.columns], "_names", "_lines")
    more, found = F.col("_names").isNotNull(), F.coalesce("_lines", F.array().cast(added.schema["_lines"].dataType))
    if aligned:
        own = F.arrays_zip("techniques", "technique_lines")
        own = F.filter(own, lambda p, i: F.array_position(F.col("techniques"), p["techniques"]) == i + 1)
        new = F.filter(found, lambda x: ~F.array_contains("techniques", x["_v"]))
        pairs = F.concat(F.transform(own, lambda p: F.struct(p["techniques"].alias("t"), p["technique_lines"].alias("l"))), F.transform(new, lambda x: F.struct(x["_v"].alias("t"), x["_line"].alias("l"))))
        kept = kept.withColumn("_pairs", pairs).withColumn("techniques", F.transform("_pairs", lambda p: p["t"])).withColumn("technique_lines", F.transform("_pairs", lambda p: p["l"])).drop("_pairs")
    else:
        lines = F.concat("technique_lines", F.array_except(F.transform(found, lambda x: x["_v"]), F.col("technique_lines")))
        kept = kept.withColumn("technique_lines", F.when(more, lines).otherwise(F.col("technique_lines"))).withColumn("techniques", F.when(more, F.array_sort(F.array_union("techniques", "_names"))).otherwise(F.col("techniques")))
    kept = kept.withColumn("evidence_score", F.when(more, evidence_score(F.col("techniques"))).otherwise(F.col("evidence_score")))
    return kept.drop("_names", "_lines")


def ranked(rows: DataFrame, keys: list[str], first: str) -> DataFrame:
    """rows with a rank from 1 within keys: score descending, then first appearance."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc(first))))


def first_of(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each keys."""
    nth = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_nth", F.row_number().over(nth)).where("_nth = 1").drop("_nth")


def join_by_prefix(files: DataFrame, keys: DataFrame, name: str, key: str) -> DataFrame:
    """Files whose name starts with a key, one row per such key.

    A name is cut to each length that keys have and joined on equality, so no pair is
    compared that doesn't match; lengths are whole numbers up to that of the longest key.
    """
    sizes = [r[0] for r in keys.where(F.col(key).isNotNull()).select(F.length(key)).distinct().orderBy(F.length(key)).collect()]
    if not sizes:
        return files.join(keys, F.lit(False))
    fitting = F.filter(F.array(*map(F.lit, sizes)), lambda n: n <= F.length(name))
    return files.withColumn("_prefix", F.explode(F.transform(fitting, lambda n: F.substring(name, F.lit(1), n)))).join(keys, F.col("_prefix") == F.col(key)).drop("_prefix")
