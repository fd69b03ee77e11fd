"""The contract's queries over the driver's tables, with SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, crf, fim, lattice, line_dedup, packing, pii, quality_rules, setjoin, sharding, suffix_dedup, warc
from .oracles import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES = {}


def _query(build):
    QUERIES[build.__name__] = build
    return build


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(docs, public_tokenizers.path("word_bpe_49k.json"))


@_query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), 2048)


@_query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality_rules.judge(docs)


@_query
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return setjoin.near_duplicates(docs)


@_query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.digests(docs)


@_query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("link")


@_query
def op10_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_vectors(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))



@_query
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query
def op7_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", crf.held_out())
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality")
    return crf.score(docs, crf.fit(docs, labels), keep=("doc_id", "held_out"))


@_query
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query
def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(_table(spark, sf_dir, "documents").select("doc_id", "text"))
