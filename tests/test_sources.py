"""Base tables from parquet folders and the JDBC options."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from small import DAY, edge_rows, frames

from despacho.plans import stock
from despacho.sources.base import COLUMNS, conform, jdbc_options, jdbc_table, parquet_tables
from despacho.sources.sample import sample_tables


def test_parquet_tables(spark, tmp_path):
    tables = frames(spark, edge_rows())
    for name, df in tables.items():
        writer = df.withColumnRenamed("id_tipo", "OtherName").write
        (writer.partitionBy("fecha") if name == "stockhistorico" else writer).parquet(f"{tmp_path}/{name}")
    read = parquet_tables(spark, str(tmp_path), renames={"ramo_equivalencia": {"OtherName": "id_tipo"}})
    assert {name: tuple(df.columns) for name, df in read.items()} == COLUMNS

    def report(t):
        return stock.inventory_units(t, supplier=3, start=DAY, end=DAY)

    assert sorted(map(repr, report(read).collect())) == sorted(map(repr, report(tables).collect()))
    plan = report(read)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fecha" in plan


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="motivo lacks descripcion"):
        conform("motivo", spark.sql("select 1 as CODIGO"))


def test_conform_ignores_case_and_extra_columns(spark):
    df = conform("motivo", spark.sql("select 1 as CODIGO, 'x' as Descripcion, 2 as otra"))
    assert df.columns == ["codigo", "descripcion"]


def test_jdbc_options():
    options = jdbc_options("jdbc:sqlserver://host", "venta", user="u")
    assert options["queryTimeout"] == "3600" and options["dbtable"] == "venta" and options["user"] == "u"


def test_jdbc_table_reads_in_parallel(spark):
    """The reader is a stand-in that records its options; there is no database in the tests."""
    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def load(self):
            return spark.sql("select 1 as Codigo, 'x' as Descripcion")

    df = jdbc_table(
        SimpleNamespace(read=Reader()), "motivo", "jdbc:sqlserver://host", "dbo.motivo", split=("codigo", 0, 100, 8)
    )
    assert df.columns == ["codigo", "descripcion"]
    assert seen == {
        "format": "jdbc",
        "url": "jdbc:sqlserver://host",
        "dbtable": "dbo.motivo",
        "queryTimeout": "3600",
        "fetchsize": "10000",
        "partitionColumn": "codigo",
        "lowerBound": "0",
        "upperBound": "100",
        "numPartitions": "8",
    }


def test_sample_tables_open_only_what_is_used(spark):
    t = sample_tables(spark, "/nowhere")
    assert set(t) == set(COLUMNS)
    assert t["motivo"].count() == 2
