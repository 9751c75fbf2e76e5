"""Every registered query against its SQL on the small tables."""

from __future__ import annotations

import oracle
import pytest

import __spark_entry__ as entry_point

SQL = entry_point.oracle_sql()
QUERIES = entry_point.queries()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, name):
    assert oracle.compare(spark, sf_dir, QUERIES[name], SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_text_vectors_have_unit_length(spark, sf_dir):
    rows = QUERIES["text_embedding"](spark, sf_dir).select("width", "norm").distinct().collect()
    assert {r["width"] for r in rows} == {768}
    assert all(abs(r["norm"] - 1) < 1e-5 or r["norm"] == 0 for r in rows)
