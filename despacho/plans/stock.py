"""Stock on hand per product and day.

One shuffle where the products fit a broadcast: the snapshot rows of depot 0
and the date range meet them in place and are partly summed before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from despacho.functions.dates import Day, iso_text, within
from despacho.functions.quantities import fixed2, floored_at_zero, in_purchase_boxes
from despacho.operators.joins import broadcast_small
from despacho.operators.lookups import distributor_code, package_number
from despacho.plans.dimensions import EXCLUDED_ARTICLE, Tables, aliased_products, products

DEPOT = 0  # fixed value: the depot that is reported


def _on_hand(
    t: Tables, stocked: DataFrame, start: Day | Column, end: Day | Column, in_boxes: bool, scale: int
) -> DataFrame:
    """Quantity per product of ``stocked`` and day, rounded to ``scale`` and never below zero."""
    stock = F.col("stocktot")
    amount = in_purchase_boxes(stock, F.col("uxbcompra")) if in_boxes else fixed2(stock)
    snapshots = (
        t["stockhistorico"]
        .filter((F.col("deposito_id") == DEPOT) & within(F.col("fecha"), start, end))
        .withColumnRenamed("articulo_codigo", "cod_art")
    )
    if "copias" in snapshots.columns:
        # Equal rows are kept once (``stock_days``).
        copies = F.col("copias").cast("decimal(12,0)")
        stock, amount = stock * copies, amount * copies
    [dimension] = broadcast_small(stocked)
    return (
        dimension.join_to(snapshots, "cod_art")
        .groupBy("IdProducto", "fecha")
        .agg(F.sum(stock).alias("raw"), F.sum(amount).alias("amount"))
        .withColumn("Cantidad", floored_at_zero(F.col("raw"), F.round("amount", scale)))
    )


def _current_columns(t: Tables, on_hand: DataFrame) -> DataFrame:
    return on_hand.select(
        distributor_code(t["configuracion"]).alias("IdDistribuidor"),
        package_number(t["numeracion"], 1).alias("IdPaquete"),
        "IdProducto",
        F.lit("PC").alias("UnidadMedida"),
        iso_text(F.col("fecha")).alias("Fecha"),
        F.lit(1).alias("IdTipoInventario"),
        F.lit("UNI").alias("Deposito"),
        "Cantidad",
    )


def _alias_columns(t: Tables, on_hand: DataFrame) -> DataFrame:
    return on_hand.select(
        distributor_code(t["configuracion"]).alias("IdDistribuidor"),
        package_number(t["numeracion"], 0).alias("IdPaquete"),
        F.col("fecha").alias("Fecha"),
        "IdProducto",
        "Cantidad",
    )


def inventory_units(
    t: Tables,
    *,
    supplier: int,
    start: Day | Column,
    end: Day | Column,
    excluded_article: int | str | None = EXCLUDED_ARTICLE,
) -> DataFrame:
    """Whole units per supplier product code, never below zero."""
    stocked = products(t, supplier, excluded_article)
    return _current_columns(t, _on_hand(t, stocked, start, end, in_boxes=False, scale=0))


def inventory_boxes(t: Tables, *, supplier: int, start: Day | Column, end: Day | Column) -> DataFrame:
    """Whole purchase boxes per supplier product code; every article."""
    return _current_columns(t, _on_hand(t, products(t, supplier), start, end, in_boxes=True, scale=0))


def inventory_alias_units(t: Tables, *, supplier: int, start: Day | Column, end: Day | Column) -> DataFrame:
    """Units to two decimals per product alias."""
    return _alias_columns(t, _on_hand(t, aliased_products(t, supplier), start, end, in_boxes=False, scale=2))


def inventory_alias_boxes(t: Tables, *, supplier: int, start: Day | Column, end: Day | Column) -> DataFrame:
    """Purchase boxes to two decimals per product alias."""
    return _alias_columns(t, _on_hand(t, aliased_products(t, supplier), start, end, in_boxes=True, scale=2))
