"""Extracts over tables whose texts compare without case and trailing blanks."""

from __future__ import annotations

import datetime as dt
import io
from contextlib import redirect_stdout
from decimal import Decimal

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F
from small import DAY, edge_rows, frames

from despacho.plans import customers, sales, stock
from despacho.sources.collation import collated, plain
from despacho.sources.sample import sample_tables


def rows(df):
    return sorted(map(repr, df.collect()))


def sold(t):
    return sales.sales_range(t, supplier=3, start=DAY, end=DAY + dt.timedelta(days=1))


def altered(t, name, **columns):
    return {**t, name: t[name].withColumns(columns)}


@pytest.fixture
def tables(spark):
    return frames(spark, edge_rows())


def test_clean_tables_give_the_same_rows_and_types(spark, tables):
    t = collated(tables)
    for extract in (
        sold,
        customers.customer_master,
        lambda t: stock.inventory_units(t, supplier=3, start=DAY, end=DAY),
        lambda t: sales.sales_by_alias(t, supplier=3, start=DAY, end=DAY),
        lambda t: sales.sales_since(t, supplier=3, start=DAY),
    ):
        assert plain(extract(t)).schema == extract(tables).schema
        assert rows(plain(extract(t))) == rows(extract(tables))


def test_lines_meet_vouchers_in_other_case_and_with_blanks(spark, tables):
    other = altered(tables, "item_venta", comprobante=F.concat(F.lower("comprobante"), F.lit("   ")))
    assert sold(other).isEmpty()
    shown = plain(sold(collated(other))).withColumn("NroComprobante", F.upper(F.rtrim("NroComprobante")))
    assert rows(shown) == rows(sold(tables))


def test_products_of_one_code_are_one_group(spark, tables):
    codes = F.when(F.col("codigo") % 2 == 0, "p ").otherwise("P")
    t = altered(tables, "articulo", codigoprov=codes)
    one = altered(tables, "articulo", codigoprov=F.lit("P"))

    def on_hand(t):
        return stock.inventory_units(t, supplier=3, start=DAY, end=DAY)

    assert on_hand(t).count() > on_hand(one).count() == 1
    assert rows(plain(on_hand(collated(t))).withColumn("IdProducto", F.lit("P"))) == rows(on_hand(one))
    total = sold(one).agg(F.sum("Cantidad")).first()[0]
    assert plain(sold(collated(t))).agg(F.sum("Cantidad")).first()[0] == total != Decimal(0)


def test_states_numbers_and_aliases(spark, tables):
    t = altered(tables, "cliente", estado=F.concat(F.lower("estado"), F.lit(" ")))
    t = altered(t, "numeracion", tiponum=F.lower("tiponum"), letra=F.concat(F.lower("letra"), F.lit("  ")))
    t = altered(t, "sinonimo", codigosinonimo=F.when(F.trim("codigosinonimo") == "", "    ").otherwise(F.col("codigosinonimo")))
    assert customers.customer_master(t).isEmpty()
    assert rows(plain(customers.customer_master(collated(t)))) == rows(customers.customer_master(tables))

    def by_alias(t):
        return sales.sales_by_alias(t, supplier=3, start=DAY, end=DAY)

    assert rows(plain(by_alias(collated(t)))) == rows(by_alias(tables))


@pytest.mark.skipif(not TESTDATA.exists(), reason="needs the test tables")
def test_dates_still_reach_the_scan(spark, tmp_path):
    t = dict(sample_tables(spark, str(TESTDATA / "sf0.001")))
    for name in ("venta", "stockhistorico"):
        t[name].write.parquet(f"{tmp_path}/{name}")
        t[name] = spark.read.parquet(f"{tmp_path}/{name}")
    shown = io.StringIO()
    with redirect_stdout(shown):
        sold(collated(t)).explain("formatted")
        stock.inventory_units(collated(t), supplier=3, start=DAY, end=DAY).explain("formatted")
    pushed = [line for line in shown.getvalue().splitlines() if "PushedFilters" in line and "GreaterThanOrEqual(fecha" in line or "EqualTo(fecha" in line]
    assert len(pushed) >= 2
