"""Base tables from parquet folders or over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# The columns each base table must offer; anything further is pruned at the scan.
COLUMNS = {
    "venta": (
        "comprobante", "fecha", "empresa_id", "cod_cli", "cod_ven", "motivodev", "referencia", "fecha_factura",
    ),
    "item_venta": ("comprobante", "fecha", "empresa_id", "cod_art", "cantidad", "cantidad_uni"),
    "articulo": ("codigo", "codigoprov", "prove", "baja", "uxb", "uxbcompra"),
    "sinonimo": ("codigoart", "codigosinonimo"),
    "cliente": (
        "codigo", "razon_social", "localidad", "cp", "direccion", "cuit", "geoy", "geox", "ramo", "estado",
    ),
    "ramo": ("codigo",),
    "ramo_equivalencia": ("codigo", "id_tipo"),
    "tipo_cliente": ("id", "codigo"),
    "vendedor": ("codigo", "nombre"),
    "motivo": ("codigo", "descripcion"),
    "stockhistorico": ("articulo_codigo", "fecha", "deposito_id", "stocktot"),
    "numeracion": ("sucursal", "tiponum", "letra", "empresa_id", "numero"),
    "configuracion": (
        "codigo", "codigo_distribuidor", "codigo_proveedor", "fecha_inicio", "usuario", "hora_envio", "ult_envio",
    ),
}

FACTS = ("venta", "item_venta", "stockhistorico")  # the tables that grow by the day

QUERY_TIMEOUT_SECONDS = 3600  # fixed value


def conform(name: str, df: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """The required columns of a base table, after renaming ``{their name: our name}``."""
    for theirs, ours in (renames or {}).items():
        df = df.withColumnRenamed(theirs, ours)
    have = [c.lower() for c in df.columns]
    missing = [c for c in COLUMNS[name] if c not in have]
    if missing:
        raise ValueError(f"{name} lacks {', '.join(missing)}")
    return df if df.columns == list(COLUMNS[name]) else df.select(*COLUMNS[name])


def parquet_tables(
    spark: SparkSession,
    folder: str,
    paths: Mapping[str, str] | None = None,
    renames: Mapping[str, Mapping[str, str]] | None = None,
) -> dict[str, DataFrame]:
    """Every base table from ``folder/<name>``; ``paths`` names those that lie elsewhere.

    Store the large tables (venta, item_venta, stockhistorico) partitioned by
    ``fecha``: the date conditions then prune whole folders.
    """
    paths, renames = paths or {}, renames or {}
    return {
        name: conform(name, spark.read.parquet(paths.get(name, f"{folder}/{name}")), renames.get(name))
        for name in COLUMNS
    }


def jdbc_options(url: str, table: str, **extra: str) -> dict[str, str]:
    """Reader options for one table; credentials and the driver class come in ``extra``."""
    return {
        "url": url,
        "dbtable": table,
        "queryTimeout": str(QUERY_TIMEOUT_SECONDS),
        "fetchsize": "10000",
        **extra,
    }


def jdbc_table(
    spark: SparkSession,
    name: str,
    url: str,
    table: str,
    split: tuple[str, object, object, int] | None = None,
    renames: Mapping[str, str] | None = None,
    **extra: str,
) -> DataFrame:
    """A base table over JDBC; filters and pruned columns are pushed to the database.

    ``split`` is (column, lower, upper, partitions) and makes the read parallel,
    normally over ``fecha`` for the large tables.
    """
    options = jdbc_options(url, table, **extra)
    if split is not None:
        column, lower, upper, partitions = split
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return conform(name, spark.read.format("jdbc").options(**options).load(), renames)
