"""Every registered query against its DuckDB text: values, names and types."""

from __future__ import annotations

import functools

import oracle
import pytest
from conftest import TESTDATA

import __spark_entry__ as entry_points
from despacho.sources.sample import sample_tables

QUERIES = {name: entry_points.queries()[name] for name in (*entry_points.PLANS, "coordinate_texts")}
TEXTS = {name: text for name, text in entry_points.oracle_sql().items() if name in QUERIES}

pytestmark = pytest.mark.skipif(not TESTDATA.exists(), reason="needs the test tables")


@functools.cache
def database(scale):
    return oracle.duckdb_over(str(TESTDATA / scale))


def test_every_query_has_a_text():
    assert QUERIES.keys() == TEXTS.keys()


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_text(spark, name, scale):
    types, rows = oracle.actual(QUERIES[name](spark, str(TESTDATA / scale)))
    want_types, want_rows = oracle.expected(database(scale), TEXTS[name])
    assert types == want_types
    assert rows == want_rows
    assert rows


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[0] == "IdDistribuidor" and df.columns[-1] == "MotivoCR"
    assert df.count() == 21


KEYS = {
    "venta": ["comprobante", "fecha", "empresa_id"],
    "articulo": ["codigo"],
    "sinonimo": ["codigoart"],
    "cliente": ["codigo"],
    "ramo": ["codigo"],
    "ramo_equivalencia": ["codigo"],
    "tipo_cliente": ["id"],
    "vendedor": ["codigo"],
    "motivo": ["codigo"],
    "numeracion": ["sucursal", "tiponum", "letra", "empresa_id"],
    "configuracion": ["codigo"],
}


@pytest.mark.parametrize("name", KEYS)
def test_keys_of_the_sample_are_unique(spark, name):
    """A repeated key would multiply the sums, in the definitions too."""
    df = sample_tables(spark, str(TESTDATA / "sf0.01"))[name]
    assert df.groupBy(*KEYS[name]).count().filter("count > 1").isEmpty()
    if name == "numeracion":
        assert df.filter("tiponum = 'BD'").count() == 1
