"""Every registered query against its DuckDB twin on the sf0.001 test tables."""

import pytest

from oracle_check import compare, duck

from __spark_entry__ import entry
from fieldrank.plans.catalog import oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(oracle_sql()) == set(queries())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["query_id", "rank", "page_id", "url", "score"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    info = compare(spark, name, SF, con)
    assert info["match"], info
