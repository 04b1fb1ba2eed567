"""Filtered dimensions shared by the sales and stock extracts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from despacho.operators.joins import Dimension

Tables = Mapping[str, DataFrame]

EXCLUDED_ARTICLE = 100000072  # fixed value: article left out of the unit-based extracts


def products(t: Tables, supplier: int, excluded_article: int | str | None = None) -> DataFrame:
    """Articles of a supplier still on sale, under the supplier's own product code."""
    articles = t["articulo"].filter((F.col("prove") == supplier) & (F.col("baja") == 0))
    if excluded_article is not None:
        code = F.lit(excluded_article).cast(articles.schema["codigo"].dataType)  # codes may be numbers or text
        articles = articles.filter(F.col("codigo") != code)
    return articles.select(
        F.col("codigo").alias("cod_art"), F.col("codigoprov").alias("IdProducto"), "uxb", "uxbcompra"
    )


def aliased_products(t: Tables, supplier: int) -> DataFrame:
    """As ``products`` under each alias of the article; articles without a filled alias drop out."""
    aliases = (
        t["sinonimo"]
        .filter(F.rtrim("codigosinonimo") != "")
        .select(F.col("codigoart").alias("cod_art"), F.col("codigosinonimo").alias("alias"))
    )
    return (
        products(t, supplier)
        .join(aliases, "cod_art")
        .select("cod_art", F.col("alias").alias("IdProducto"), "uxb", "uxbcompra")
    )


def customers(t: Tables) -> DataFrame:
    return t["cliente"].select(F.col("codigo").alias("cod_cli"), "ramo")


def type_dimensions(t: Tables) -> list[DataFrame]:
    """The three steps from a customer's branch to the receiver's type: branch, mapping, type."""
    return [
        t["ramo"].select(F.col("codigo").alias("ramo")),
        t["ramo_equivalencia"].select(F.col("codigo").alias("ramo"), "id_tipo"),
        t["tipo_cliente"].select(F.col("id").alias("id_tipo"), F.col("codigo").alias("tipo")),
    ]


def with_type(facts: DataFrame, branch: Dimension, mapping: Dimension, kind: Dimension, required: bool) -> DataFrame:
    """Facts of known branches with the type code; without one it is NULL, or the row drops out if ``required``."""
    how = "inner" if required else "left"
    return kind.join_to(mapping.join_to(branch.join_to(facts, "ramo"), "ramo", how), "id_tipo", how)


def reasons(t: Tables) -> DataFrame:
    return t["motivo"].select(F.col("codigo").alias("motivodev"), F.col("descripcion").alias("motivo"))


def sellers(t: Tables) -> DataFrame:
    return t["vendedor"].select(F.col("codigo").alias("cod_ven"), F.col("nombre").alias("vendedor"))
