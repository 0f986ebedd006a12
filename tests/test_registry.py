"""Every registered query against its DuckDB oracle on the smallest driver tables,
plus the driver contract of ``__spark_entry__``."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tools.oracle_check import compare, duck
from conftest import SF_SMALL

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duck(SF_SMALL)
    yield c
    c.close()


def test_contract_shapes(spark):
    assert set(ORACLE) <= set(QUERIES)
    df = entry.entry(spark)
    assert df.columns[:2] == ["origin_zone", "destination_zone"]
    assert df.count() >= 0


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    if key not in ORACLE:
        assert QUERIES[key](spark, SF_SMALL).count() >= 0
        return
    res = compare(spark, con, key, QUERIES[key], ORACLE[key], SF_SMALL)
    assert res["status"].startswith("OK"), res
