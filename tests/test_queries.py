"""Every registered query against its SQL at the smallest scale."""

import os

import pytest
from compare import compare, duck

from wakeline.queries import CHECKS, QUERIES

FOLDER = os.environ.get("WAKELINE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    status, _n, detail = compare(spark, con, name, FOLDER)
    assert status == ("ok" if name in CHECKS else "rows-only"), detail


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
