"""Vouchers and lines stored together: in buckets of their common key, so that they are joined where they lie."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from despacho.plans.dimensions import Tables
from despacho.plans.sales import VOUCHER_KEY

TOGETHER = ("venta", "item_venta")
# Within a bucket by date, so that a condition on dates skips parts of the file.
ORDER = ["fecha", "comprobante", "empresa_id"]


def write_bucketed(t: Tables, folder: str, buckets: int, prefix: str = "despacho") -> dict[str, str]:
    """Store vouchers and lines as tables of the session's catalog, by bucket of the voucher key; their names.

    As many buckets on both sides, some 128 MB to 1 GB of lines each. A day's new rows
    are a table of the same buckets, and a union of such tables is joined bucket by
    bucket only after it was written as one.
    """
    names = {}
    for name in TOGETHER:
        names[name] = f"{prefix}_{name}"
        # One task for each bucket, so that a bucket is one file.
        rows = t[name].repartition(buckets, *VOUCHER_KEY)
        writer = rows.write.bucketBy(buckets, *VOUCHER_KEY).sortBy(*ORDER).format("parquet").mode("overwrite")
        writer.option("path", f"{folder}/{name}").saveAsTable(names[name])
    return names


def bucketed_tables(spark: SparkSession, t: Tables, names: dict[str, str]) -> dict[str, DataFrame]:
    """The tables with vouchers and lines read from their buckets."""
    return {**t, **{name: spark.table(names[name]) for name in TOGETHER}}
