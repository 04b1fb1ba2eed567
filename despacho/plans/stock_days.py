"""Stock kept by article and day, from which all stock extracts and their controls are made.

The extracts differ in products, units and rounding, so sums would not do for all of
them; what they share is how often each article has which stock on a day, in the depot
that they report. That is kept in folders by day under a root that all executors share:

    <root>/stock/fecha=YYYY-MM-DD/      articulo_codigo, stocktot, copias
    <root>/stock-sources/fecha=.../     a digest of the files that the day was made from

A refresh reads the snapshots of the days whose files changed and replaces those days
alone. Sources are noted after the rows, so a refresh that breaks off is made again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from despacho.functions.dates import day
from despacho.plans.dimensions import Tables
from despacho.plans.stock import DEPOT
from despacho.sources.files import exists, remove

SOURCES = "fecha date, source string"


def _kept(root: str) -> str:
    return f"{root}/stock"


def _noted(root: str) -> str:
    return f"{root}/stock-sources"


def day_sources(snapshots: DataFrame) -> DataFrame:
    """Per day of snapshots stored by date a digest of its files: names, sizes and times, a row per file."""
    m = F.col("_metadata")
    files = snapshots.select("fecha", m["file_path"].alias("path"), m["file_size"].alias("size"), m["file_modification_time"].alias("time"))
    files = files.distinct().groupBy("fecha").agg(F.array_sort(F.collect_list(F.struct("path", "size", "time"))).alias("files"))
    return files.select("fecha", F.md5(F.to_json("files")).alias("source"))


def noted_sources(spark: SparkSession, root: str) -> DataFrame:
    if not exists(spark, _noted(root)):
        return spark.createDataFrame([], SOURCES)
    return spark.read.schema(SOURCES).parquet(_noted(root))


def changed_days(snapshots: DataFrame, root: str) -> list[dt.date]:
    """Days whose files aren't those that the kept rows were made from, or are gone: a value per day."""
    old = noted_sources(snapshots.sparkSession, root).withColumnRenamed("source", "old")
    both = day_sources(snapshots).join(old, "fecha", "full")
    return [r["fecha"] for r in both.filter(~F.col("source").eqNullSafe(F.col("old"))).select("fecha").sort("fecha").collect()]


def _replace(rows: DataFrame, path: str, days: Sequence[dt.date]) -> None:
    """Write the rows of some days in place of what is there of them."""
    spark = rows.sparkSession
    rows.write.partitionBy("fecha").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    found = spark.read.schema("fecha date").parquet(path) if exists(spark, path) else spark.createDataFrame([], "fecha date")
    wanted = {r["fecha"] for r in rows.select("fecha").distinct().collect()}
    for d in {r["fecha"] for r in found.distinct().collect()} & set(days) - wanted:
        remove(spark, f"{path}/fecha={d:%Y-%m-%d}")


def refresh(t: Tables, root: str, days: Sequence[dt.date] | None = None) -> list[dt.date]:
    """Make the kept rows of some days anew, of all changed ones by default; the days that were made."""
    snapshots = t["stockhistorico"]
    days = changed_days(snapshots, root) if days is None else sorted(days)
    if days:
        of_days = F.col("fecha").isin(*map(day, days))
        sources = day_sources(snapshots.filter(of_days))
        noted = sources.collect()  # as they were before the rows are read
        rows = snapshots.filter(of_days & (F.col("deposito_id") == DEPOT))
        rows = rows.groupBy("fecha", "articulo_codigo", "stocktot").agg(F.count(F.lit(1)).alias("copias"))
        _replace(rows.hint("rebalance", "fecha"), _kept(root), days)
        spark = snapshots.sparkSession
        _replace(spark.createDataFrame(noted, SOURCES).coalesce(1), _noted(root), days)
    return list(days)


def with_kept_stock(t: Tables, root: str) -> Tables:
    """The tables with the kept rows in place of the snapshots."""
    like = t["stockhistorico"].schema
    schema = ", ".join(f"{c} {like[c].dataType.simpleString()}" for c in ("articulo_codigo", "stocktot", "fecha"))
    kept = t["configuracion"].sparkSession.read.schema(f"{schema}, copias bigint").parquet(_kept(root))
    return {**t, "stockhistorico": kept.withColumn("deposito_id", F.lit(DEPOT).cast(like["deposito_id"].dataType))}
