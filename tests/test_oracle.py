"""Every registered query against its DuckDB oracle on the driver tables.

Runs at sf0.001 by default (set TILLROLL_ORACLE_SF_DIR for another scale; the
driver checks sf0.01).
"""

import os

import pytest
from oracle_check import compare, duck

import __spark_entry__ as entry
from tillroll.plans import catalog

SF_DIR = os.environ.get("TILLROLL_ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = catalog.queries()
ORACLE = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, name, QUERIES[name], ORACLE[name], SF_DIR, con)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["rank", "country", "revenue", "revenue_share_pct"]
    assert df.count() > 0
