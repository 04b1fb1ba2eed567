"""Extracts against the brute-force definitions: edge rows, random rows with hot keys, either join strategy."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

import brute
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from small import DAY, edge_rows, frames, random_rows, records

from despacho.operators import joins
from despacho.plans import customers, sales, stock

NEXT = DAY + dt.timedelta(days=1)
ARTICLE = 100000072


def rows(df) -> Counter:
    return Counter(tuple(r) for r in df.collect())


def cases():
    yield "edge", edge_rows()
    for seed in range(4):
        yield f"random{seed}", random_rows(seed)


def check_all(spark, tables):
    t, r = frames(spark, tables), records(tables)
    checks = {
        "sales_range": (
            sales.sales_range(t, supplier=3, start=DAY, end=NEXT),
            brute.current_sales(r, 3, DAY, NEXT, ARTICLE, True),
        ),
        "sales_since": (sales.sales_since(t, supplier=3, start=DAY), brute.current_sales(r, 3, DAY, None, None, False)),
        "sales_by_alias": (
            sales.sales_by_alias(t, supplier=3, start=DAY, end=DAY),
            brute.alias_sales(r, 3, DAY, DAY),
        ),
        "inventory_units": (
            stock.inventory_units(t, supplier=3, start=DAY, end=NEXT),
            brute.stock(r, 3, DAY, NEXT, ARTICLE, False, False),
        ),
        "inventory_boxes": (
            stock.inventory_boxes(t, supplier=3, start=DAY, end=DAY),
            brute.stock(r, 3, DAY, DAY, None, False, True),
        ),
        "inventory_alias_units": (
            stock.inventory_alias_units(t, supplier=3, start=DAY, end=DAY),
            brute.stock(r, 3, DAY, DAY, None, True, False),
        ),
        "inventory_alias_boxes": (
            stock.inventory_alias_boxes(t, supplier=3, start=DAY, end=DAY),
            brute.stock(r, 3, DAY, DAY, None, True, True),
        ),
        "customer_master": (customers.customer_master(t), brute.customers(r)),
    }
    for name, (df, want) in checks.items():
        assert rows(df) == want, name
    return {name: sum(want.values()) for name, (_, want) in checks.items()}


@pytest.mark.parametrize("name, tables", list(cases()), ids=lambda v: v if isinstance(v, str) else "")
def test_extracts_agree_with_brute_force(spark, name, tables):
    sizes = check_all(spark, tables)
    if name == "edge":
        assert all(sizes.values()), sizes


def test_extracts_agree_without_any_broadcast(spark, conf, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    check_all(spark, random_rows(9))


CURRENT_SALES = (
    "IdDistribuidor IdPaquete IdCliente IdTipoDeCliente IdVendedor NombreVendedor ApellidoVendedor IdProducto"
    " UnidadMedida Fecha TipoDocumento Cantidad NroComprobante NroComprobanteAsociado MotivoCR"
)
ALIAS_SALES = (
    "IdDistribuidor IdPaquete Fecha NroComprobante IdPedidoDinesys NroComprobanteAsociado IdCliente IdTipoDeCliente"
    " IdVendedor IdProducto Cantidad TipoDeComprobante MotivoNC"
)
CURRENT_STOCK = "IdDistribuidor IdPaquete IdProducto UnidadMedida Fecha IdTipoInventario Deposito Cantidad"
ALIAS_STOCK = "IdDistribuidor IdPaquete Fecha IdProducto Cantidad"
CUSTOMERS = (
    "IdDistribuidor IdPaquete IdCliente RazonSocial BannerText IdProvincia Localidad CodigoPostal Calle Numero CUIT"
    " Latitud Longitud IdTipoCliente"
)


def test_columns_come_in_the_receivers_order(spark):
    t, day = frames(spark, edge_rows()), {"supplier": 3, "start": DAY, "end": DAY}
    for df, columns in (
        (sales.sales_range(t, **day), CURRENT_SALES),
        (sales.sales_since(t, supplier=3, start=DAY), CURRENT_SALES),
        (sales.sales_by_alias(t, **day), ALIAS_SALES),
        (stock.inventory_units(t, **day), CURRENT_STOCK),
        (stock.inventory_boxes(t, **day), CURRENT_STOCK),
        (stock.inventory_alias_units(t, **day), ALIAS_STOCK),
        (stock.inventory_alias_boxes(t, **day), ALIAS_STOCK),
        (customers.customer_master(t), CUSTOMERS),
    ):
        assert df.columns == columns.split()


@pytest.mark.parametrize("copies", [0, 1, 2])
def test_numbering_rows_multiply_sales(spark, copies):
    tables = edge_rows()
    extra = [(9, "BD", "Z", 9, n) for n in range(1, copies)]
    if copies:
        tables["numeracion"] += extra
        want = brute.current_sales(records(tables), 3, DAY, DAY, ARTICLE, True)
    else:
        tables["numeracion"] = [n for n in tables["numeracion"] if n[1] != "BD"]
        want = Counter()
    assert rows(sales.sales_range(frames(spark, tables), supplier=3, start=DAY, end=DAY)) == want


def test_zero_divisor_is_an_error_only_where_it_is_reported(spark):
    tables = edge_rows()
    tables["articulo"].append((17, "P17", 3, 0, Decimal(1), Decimal(0)))
    tables["item_venta"].append(("RE6", DAY, 1, 17, Decimal(1), Decimal(1)))
    tables["item_venta"].append(("FA7", DAY, 1, 17, Decimal(1), Decimal(1)))  # customer of no known branch
    sales.sales_range(frames(spark, tables), supplier=3, start=DAY, end=DAY).collect()
    tables["item_venta"].append(("FA1", DAY, 1, 17, Decimal(1), Decimal(1)))
    with pytest.raises(PySparkException, match="division by zero"):
        sales.sales_range(frames(spark, tables), supplier=3, start=DAY, end=DAY).collect()


def test_zero_divisor_in_stock_is_an_error(spark):
    tables = edge_rows()
    tables["articulo"].append((17, "P17", 3, 0, Decimal(1), Decimal(0)))
    tables["stockhistorico"].append((17, DAY, 0, Decimal(1)))
    with pytest.raises(PySparkException, match="DIVIDE_BY_ZERO"):
        stock.inventory_boxes(frames(spark, tables), supplier=3, start=DAY, end=DAY).collect()


def test_ambiguous_package_number_is_an_error_and_a_missing_one_is_null(spark):
    tables = edge_rows()
    tables["numeracion"].append((1, "BD", "X", 1, 42))
    with pytest.raises(Exception, match="(?i)more than one row"):
        customers.customer_master(frames(spark, tables)).collect()
    tables["numeracion"] = []
    assert {r["IdPaquete"] for r in customers.customer_master(frames(spark, tables)).collect()} == {None}


def test_text_article_codes(spark):
    tables = edge_rows()
    want = brute.stock(records(tables), 3, DAY, DAY, ARTICLE, False, False)
    t = frames(spark, tables)
    t["articulo"] = t["articulo"].withColumn("codigo", F.col("codigo").cast("string"))
    t["stockhistorico"] = t["stockhistorico"].withColumn("articulo_codigo", F.col("articulo_codigo").cast("string"))
    assert rows(stock.inventory_units(t, supplier=3, start=DAY, end=DAY)) == want
