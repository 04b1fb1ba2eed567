"""Customer master: one pruned scan, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from despacho.functions.quantities import coordinate_text, is_floating
from despacho.operators.lookups import distributor_code, is_code, package_number
from despacho.plans.dimensions import Tables

# Constant columns and the status of an active customer.
PROVINCE = 6
ACTIVE = "A"


def customer_master(t: Tables) -> DataFrame:
    """Active customers with a positive code."""
    kinds = t["cliente"].schema

    def coordinate(name: str) -> Column:
        return coordinate_text(F.col(name), is_floating(kinds[name].dataType))

    return (
        t["cliente"]
        .filter((F.col("codigo") > 0) & is_code(F.col("estado"), ACTIVE))
        .select(
            distributor_code(t["configuracion"]).alias("IdDistribuidor"),
            package_number(t["numeracion"], 1).alias("IdPaquete"),
            F.col("codigo").alias("IdCliente"),
            F.col("razon_social").alias("RazonSocial"),
            F.lit("").alias("BannerText"),
            F.lit(PROVINCE).alias("IdProvincia"),
            F.col("localidad").alias("Localidad"),
            F.col("cp").alias("CodigoPostal"),
            F.col("direccion").alias("Calle"),
            F.lit("").alias("Numero"),
            F.col("cuit").alias("CUIT"),
            coordinate("geoy").alias("Latitud"),
            coordinate("geox").alias("Longitud"),
            F.col("ramo").alias("IdTipoCliente"),
        )
    )
