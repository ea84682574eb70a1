"""Queries of the operators against their SQL at the smallest scale; the others by their rows."""

import pytest
from compare import duck, rows_of

from wakeline.llm.queries import CHECKS, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_matches_sql(spark, name):
    got = QUERIES[name](spark, FOLDER)
    want = duck(FOLDER).execute(CHECKS[name])
    assert rows_of(got.columns, got.collect()) == rows_of([d[0] for d in want.description], want.fetchall())


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
