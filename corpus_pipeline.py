"""Documents to training sequences: filter, deduplicate, redact, pack.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept;
what it returns is written as Parquet and read again for the next.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import packing, pii, quality_rules, setjoin, suffix_dedup
from sievework.llm.common import bounded, has_rows, join_hot, row_key, settled, store, unused

#: Rows of a decision table that is broadcast at most (16 bytes each).
BROADCAST = 2_000_000
#: A passage of so many words that stands elsewhere too is cut, if it has so many bytes.
PASSAGE_WORDS, PASSAGE_BYTES = 51, 200


#: Rows that go to a worker together while a stage decides: several stages share an executor's memory.
TOGETHER = 2_000


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Fewer rows in an Arrow batch for what is run inside; the session's setting comes back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(TOGETHER))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _without(docs: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return docs.join(F.broadcast(gone) if bounded(gone, BROADCAST) else gone, keys, "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep: enough words, few repeats, neither too surprising nor too predictable.

    Rows are known by 128 bits of doc_id, text and language: equal rows are judged alike,
    rows without doc_id, text or language are judged one by one, columns of any name stay.
    Null and empty texts are too short to stay. An empty table stays empty.
    """
    keys = [unused("_key", docs.columns), unused("_mark", docs.columns)]
    keyed = docs.withColumn(keys[0], row_key("doc_id", "text", "lang")).withColumn(keys[1], row_key("text", "lang", "doc_id", seed=1))
    with _small_batches(spark):
        rejected = settled(spark, "rejected", lambda: quality_rules.judge(keyed, keep=tuple(keys)).where("not kept").select(*keys).distinct())
    return _without(keyed, rejected, keys).select(*[keyed[c] for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the smallest doc_id, then the least key of its text.

    A row is known by doc_id and text (128 bits), so rows that share a doc_id or lack it
    are judged one by one; only a class without any doc_id keeps a row without. Rows equal
    in doc_id and text (null is not the empty text) stay once, wordless ones too. Columns of any name stay.
    Texts of any length are compared whole. An empty table stays empty.
    """
    keys = [unused("_key", docs.columns), unused("_mark", docs.columns)]

    def keyed(text: list[Column]) -> list[Column]:
        return [F.xxhash64("doc_id", text[0]).alias(keys[0]), F.xxhash64(F.lit(1), text[1], "doc_id").alias(keys[1])]

    rows = docs.select("*", *keyed(setjoin.text_keys("text")))

    def others() -> DataFrame:
        """Keys of rows that go, and (n = 2) of those that stay once."""
        classes = store(setjoin.classes_of_rows(docs.select("doc_id", "text")), "classes")
        own = keyed([F.col("text_key"), F.col("text_mark")])
        linked = classes.where("label is not null")
        first = F.min(F.when(F.col("doc_id").eqNullSafe(F.col("component_id")), F.struct("text_key", "text_mark"))).alias("first")
        chosen = store(linked.groupBy("label").agg(first, F.count("*").alias("rows")), "chosen")
        gone = join_hot(linked, chosen, "label", "rows", "inner").where("not (doc_id <=> component_id) or struct(text_key, text_mark) <> first")
        again = classes.groupBy(*own).agg(F.count("*").alias("n")).where("n > 1")
        return gone.select(*own).distinct().withColumn("n", F.lit(1)).unionByName(again.withColumn("n", F.lit(2)))

    with _small_batches(spark):
        found = settled(spark, "others", others)
    kept = _without(rows, found.where("n = 1").drop("n"), keys)
    again = found.where("n = 2").drop("n")
    if has_rows(again):
        small = F.broadcast(again) if bounded(again, BROADCAST) else again
        kept = kept.join(small, keys, "left_anti").unionByName(kept.join(small, keys, "left_semi").dropDuplicates([*keys, "text"]).select(*kept.columns))
    return kept.select(*[F.col(c) for c in docs.columns])


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of over 50 words that occur elsewhere too.

    A run of repeated bytes is a passage if it holds 51 whole words or more and 200 bytes,
    wherever its copies stand; shorter repeats are left alone. All copies go, as they do
    in the operator. Null texts stay null, repeated rows lose what they share. Texts of any
    length are read whole; columns of any name stay. An empty table stays empty.
    """
    with _small_batches(spark):
        return suffix_dedup.remove_repeats(docs, PASSAGE_BYTES, PASSAGE_BYTES // 2, PASSAGE_WORDS)


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; null texts stay null, rows and other columns as they are.

    Texts of any length are searched whole, repeated rows alike. An empty table stays empty.
    """
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 2048 tokens; every row is packed, null text as its end marker.

    Very long texts are tokenised whole and cut; repeated rows are packed once each;
    columns named like those of pieces give way to them. An empty table gives no pieces.
    """
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), 2048)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeats),
    ("PII", personal),
    ("best-fit packing", packed),
]

#: No SQL says all stages; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settled(spark, name.replace(" ", "-"), lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
