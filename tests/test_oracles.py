"""Every registered query with an oracle, cell by cell, on whole tables."""

import pytest
from compare import compare

import __spark_entry__ as entry

SQL = entry.oracle_sql()
QUERIES = entry.queries()


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_oracle(spark, con, sf_dir, name):
    assert compare(con, SQL[name], QUERIES[name](spark, sf_dir)) == []


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 5
    assert all(r["count"] == r["true_negatives"] + r["false_positives"] + r["false_negatives"] + r["true_positives"] for r in rows)
