from __future__ import annotations

import os

import pytest

from sievework.plans import catalogue

from . import oracle

SF, LARGE = "/root/testdata/sf0.001", "/root/testdata/sf0.1"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_matches_sql(spark, con, name):
    oracle.assert_same(catalogue.QUERIES[name](spark, SF), con, catalogue.ORACLE_SQL[name])


@pytest.mark.skipif(not os.path.isdir(LARGE), reason="no larger tables")
@pytest.mark.parametrize("name", ["supp_dispatch", "candidate_json", "gold_json", "reference_contexts", "paper_files", "txt_files", "fasta_files"])
def test_file_query_takes_all_rows_of_larger_tables(spark, name):
    oracle.assert_same(catalogue.QUERIES[name](spark, LARGE), oracle.connect(LARGE), catalogue.ORACLE_SQL[name])


def test_numbered_join_matches_sql_on_odd_texts(spark, tmp_path):
    texts = [None, "", "\n", "\n\n", " ", "the hand\n", *[t.replace("@", c) for c in "\n\r\v\f\x1c\x1d\x1e\x1f\t\x85\xa0" for t in ("the hand@thing lead@", "the@hand 10 thing\n@lead 1")]]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'en' AS lang").write.parquet(f"{tmp_path}/documents.parquet")
    con = oracle.connect("none")
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    oracle.assert_same(catalogue.QUERIES["numbered_join"](spark, str(tmp_path)), con, catalogue.ORACLE_SQL["numbered_join"])


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_query_without_sql_gives_rows(spark, name):
    assert catalogue.QUERIES[name](spark, SF).limit(1).count() == 1


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(catalogue.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_more_rows_are_more_files(spark, con, monkeypatch):
    from sievework.plans import files
    from sievework.sources import readers
    from sievework.streaming import incremental

    monkeypatch.setattr(files, "_FILE_ROWS", 30)
    monkeypatch.setattr(files, "_STREAM_ROWS", 20)
    seen, supplementary, mine_new = {}, readers.supplementary, incremental.mine_new
    monkeypatch.setattr(readers, "supplementary", lambda s, path: seen.update(supp=readers.listing(s, path, "*.csv").count()) or supplementary(s, path))
    monkeypatch.setattr(incremental, "mine_new", lambda s, schema, source, *more, **named: seen.update(stream=readers.listing(s, source, "*.parquet").count()) or mine_new(s, schema, source, *more, **named))
    for name in ("supp_dispatch", "mined_stream"):
        oracle.assert_same(catalogue.QUERIES[name](spark, SF), con, catalogue.ORACLE_SQL[name])
    assert seen["supp"] >= 200 / 30 and seen["stream"] >= 200 / 20
