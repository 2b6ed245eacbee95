"""Registered operator queries against their DuckDB twins."""

import pytest

from oracle_check import compare, duck

from fieldrank.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    for d in ("sf0.001", "sf0.01"):
        sf = f"/root/testdata/{d}"
        info = compare(spark, name, sf, duck(sf))
        assert info["match"], info


def test_all_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
