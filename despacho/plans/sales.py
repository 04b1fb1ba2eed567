"""Net sales by voucher and product.

Lines meet the products first, which leaves one supplier's lines, and are
summed per voucher and product before they are shuffled to the vouchers: a
voucher that holds a large part of all lines arrives as one row per product.
The join equates date and voucher number, so the conditions on them are put on
the lines as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from despacho.functions import vouchers
from despacho.functions.dates import Day, iso_text, within
from despacho.functions.quantities import TOTAL, try_converted
from despacho.operators.joins import Dimension, broadcast_small
from despacho.operators.lookups import distributor_code, numbering_copies, package_number
from despacho.plans.dimensions import (
    EXCLUDED_ARTICLE,
    Tables,
    aliased_products,
    customers,
    products,
    reasons,
    sellers,
    type_dimensions,
    with_type,
)

VOUCHER_KEY = ["comprobante", "fecha", "empresa_id"]

# Seller columns of the variant that looks no seller up.
SELLER_NAME, SELLER_SURNAME = "Nombre Vendedor", "Apellido Vendedor"


def _reported(start: Day | Column, end: Day | Column | None) -> Column:
    return within(F.col("fecha"), start, end) & vouchers.is_invoiced_kind(F.col("comprobante"))


def invoiced_vouchers(t: Tables, start: Day | Column, end: Day | Column | None) -> DataFrame:
    """Voucher headers of the reported kinds, invoiced, in the date range."""
    return (
        t["venta"]
        .filter(_reported(start, end) & F.col("fecha_factura").isNotNull())
        .select(*VOUCHER_KEY, "cod_cli", "cod_ven", "motivodev", "referencia")
    )


def net_lines(t: Tables, sold: Dimension, start: Day | Column, end: Day | Column | None) -> DataFrame:
    """Line quantities of reported vouchers summed per voucher and product of ``sold``."""
    quantity, per_box, per_purchase_box = F.col("cantidad"), F.col("uxb"), F.col("uxbcompra")
    # A zero divisor is an error only if its voucher is reported, so it is noted here and raised later.
    bad = (per_purchase_box == 0) & quantity.isNotNull() & per_box.isNotNull()
    lines = sold.thin(t["item_venta"].filter(_reported(start, end)), "cod_art")
    return (
        sold.join_to(lines, "cod_art")
        .groupBy(*VOUCHER_KEY, "IdProducto")
        .agg(
            F.sum(try_converted(quantity, per_box, per_purchase_box)).alias("converted"),
            F.sum("cantidad_uni").alias("units"),
            F.bool_or(bad).alias("zero_divisor"),
        )
    )


def _net_sales(sold_vouchers: DataFrame, copies: Column, *attributes: str) -> DataFrame:
    """Sums per voucher, product and looked-up attributes, times the numbering copies."""
    return (
        sold_vouchers.groupBy(
            "fecha", "comprobante", "referencia", "cod_cli", "cod_ven", "IdProducto", "motivo", "tipo", *attributes
        )
        .agg(
            F.sum("converted").alias("converted"),
            F.sum("units").alias("units"),
            F.bool_or("zero_divisor").alias("zero_divisor"),
        )
        .withColumn("copies", copies)
        .filter(F.col("copies") > 0)
        .withColumn("converted", F.col("converted") * F.col("copies"))
        .withColumn("units", F.col("units") * F.col("copies"))
    )


def _reported_rows(net: DataFrame, dropped: Column) -> DataFrame:
    """Rows that aren't dropped; a zero divisor in one is an error, whichever columns are read."""
    failure = F.raise_error(F.lit("division by zero: uxbcompra")).cast("boolean")
    return net.filter(F.when(dropped, False).when(F.col("zero_divisor"), failure).otherwise(True))


def _current_columns(t: Tables, net: DataFrame, name: Column, surname: Column) -> DataFrame:
    voucher = F.col("comprobante")
    return _reported_rows(net, F.coalesce(F.col("units") == 0, F.lit(True))).select(
        distributor_code(t["configuracion"]).alias("IdDistribuidor"),
        package_number(t["numeracion"], 1).alias("IdPaquete"),
        F.col("cod_cli").alias("IdCliente"),
        vouchers.customer_type_or_default(F.col("tipo")).alias("IdTipoDeCliente"),
        F.col("cod_ven").alias("IdVendedor"),
        name.alias("NombreVendedor"),
        surname.alias("ApellidoVendedor"),
        "IdProducto",
        F.lit("PC").alias("UnidadMedida"),
        iso_text(F.col("fecha")).alias("Fecha"),
        vouchers.document_type(F.col("converted"), voucher).alias("TipoDocumento"),
        F.round("units", 0).cast(TOTAL).alias("Cantidad"),
        voucher.alias("NroComprobante"),
        vouchers.associated_voucher(voucher, F.col("referencia")).alias("NroComprobanteAsociado"),
        F.col("motivo").alias("MotivoCR"),
    )


def _sold_vouchers(
    t: Tables,
    start: Day | Column,
    end: Day | Column | None,
    sold: Dimension,
    reason: Dimension,
    customer: Dimension,
    types: list[Dimension],
    type_required: bool,
) -> DataFrame:
    """Reported vouchers with their net lines; then reason and customer type, of known customers.

    Vouchers and lines are shuffled on the voucher key, which leaves one
    supplier's vouchers for the lookups. A customer that holds many vouchers
    matters only to a lookup that is itself a shuffle join.
    """
    met = invoiced_vouchers(t, start, end).join(net_lines(t, sold, start, end), VOUCHER_KEY)
    met = reason.join_to(customer.join_to(met, "cod_cli"), "motivodev", "left")
    return with_type(met, *types, required=type_required)


def sales_range(
    t: Tables,
    *,
    supplier: int,
    start: Day | Column,
    end: Day | Column,
    excluded_article: int | str | None = EXCLUDED_ARTICLE,
) -> DataFrame:
    """Net units per voucher and supplier product code, with the seller's name."""
    sold, seller, reason, customer, *types = broadcast_small(
        products(t, supplier, excluded_article), sellers(t), reasons(t), customers(t), *type_dimensions(t)
    )
    met = _sold_vouchers(t, start, end, sold, reason, customer, types, type_required=False)
    net = _net_sales(seller.join_to(met, "cod_ven", "left"), numbering_copies(t["numeracion"]), "vendedor")
    return _current_columns(t, net, F.col("vendedor"), F.col("vendedor"))


def sales_since(t: Tables, *, supplier: int, start: Day | Column) -> DataFrame:
    """As ``sales_range`` from a day on, every article, without seller lookup."""
    sold, reason, customer, *types = broadcast_small(
        products(t, supplier), reasons(t), customers(t), *type_dimensions(t)
    )
    met = _sold_vouchers(t, start, None, sold, reason, customer, types, type_required=False)
    net = _net_sales(met, numbering_copies(t["numeracion"]))
    return _current_columns(t, net, F.lit(SELLER_NAME), F.lit(SELLER_SURNAME))


def sales_by_alias(t: Tables, *, supplier: int, start: Day | Column, end: Day | Column) -> DataFrame:
    """Net quantity in purchase boxes per voucher and product alias; customer type required."""
    sold, reason, customer, *types = broadcast_small(
        aliased_products(t, supplier), reasons(t), customers(t), *type_dimensions(t)
    )
    met = _sold_vouchers(t, start, end, sold, reason, customer, types, type_required=True)
    net = _net_sales(met, numbering_copies(t["numeracion"]))
    voucher = F.col("comprobante")
    # The quantity itself decides whether a row is reported, so every bad divisor is an error.
    dropped = ~F.coalesce("zero_divisor", F.lit(False)) & F.coalesce(F.col("converted") == 0, F.lit(True))
    return _reported_rows(net, dropped).select(
        distributor_code(t["configuracion"]).alias("IdDistribuidor"),
        package_number(t["numeracion"], 0).alias("IdPaquete"),
        F.col("fecha").alias("Fecha"),
        voucher.alias("NroComprobante"),
        F.lit("").alias("IdPedidoDinesys"),
        vouchers.associated_voucher_legacy(F.col("referencia")).alias("NroComprobanteAsociado"),
        F.col("cod_cli").alias("IdCliente"),
        F.col("tipo").alias("IdTipoDeCliente"),
        F.col("cod_ven").alias("IdVendedor"),
        "IdProducto",
        F.round("converted", 2).cast(TOTAL).alias("Cantidad"),
        vouchers.document_type_legacy(F.col("converted"), voucher).alias("TipoDeComprobante"),
        F.col("motivo").alias("MotivoNC"),
    )
