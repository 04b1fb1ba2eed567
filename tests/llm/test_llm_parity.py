"""Queries of the package that SQL can express, against their DuckDB text: values, names and types."""

import oracle
import pytest

from despacho.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_agrees_with_text(spark, name):
    types, rows = oracle.actual(queries.queries()[name](spark, SF))
    want_types, want_rows = oracle.expected(oracle.duckdb_over(SF), queries.oracle_sql()[name])
    assert types == want_types
    assert rows == want_rows and rows
