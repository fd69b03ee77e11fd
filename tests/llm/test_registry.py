from __future__ import annotations

import os

import pytest

from sievework.llm import registry
from tests import oracle

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    oracle.assert_same(registry.QUERIES[name](spark, SF), oracle.connect(SF), registry.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_query_covers_its_table(spark, name):
    rows = registry.QUERIES[name](spark, SF)
    assert rows.select("doc_id").distinct().count() == spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").distinct().count()
