"""Bookkeeping of runs: what is due, delivered or pending, the daily run itself, and the packages left behind."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Mapping
from dataclasses import asdict
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from despacho.functions.dates import Day, age_in_days, day
from despacho.operators.joins import remembered_sizes
from despacho.operators.lookups import (
    ADVANCED_SERIES,
    MAIN_CONFIG,
    PACKAGE_SERIES,
    Series,
    config_row,
    package_number,
)
from despacho.operators.limits import QUERY_SECONDS, time_limit
from despacho.plans import customers, sales, stock
from despacho.plans.delivery import (
    CUSTOMERS,
    SALES,
    SENT,
    STOCK,
    Kind,
    Transport,
    build_days,
    is_waiting,
    make,
    packages,
    read_records,
    send,
    steps,
    waiting,
)
from despacho.plans.dimensions import Tables
from despacho.sources.base import FACTS
from despacho.sources.files import publish_once

# How long an undelivered package stays pending, and which kinds are retried.
MAX_AGE_DAYS = 3
RETRIED_KINDS = (STOCK.name, SALES.name)

PACKAGE = ["kind", "business_date"]


def due(config: DataFrame, as_of: Day) -> DataFrame:
    """Configurations that did not run yet on the run date."""
    return config.filter(~F.col("ult_envio").eqNullSafe(day(as_of)))


def skip_delivered(planned: DataFrame, sent: DataFrame) -> DataFrame:
    """Packages without a ledger row."""
    return planned.join(sent.select(*PACKAGE), PACKAGE, "left_anti")


def pending(planned: DataFrame, sent: DataFrame, as_of: Day, max_age: int = MAX_AGE_DAYS) -> DataFrame:
    """Undelivered stock and sales packages created at most ``max_age`` days before the run date."""
    recent = planned.filter(
        F.col("kind").isin(*RETRIED_KINDS) & (age_in_days(as_of, F.col("created")) <= max_age)
    )
    return skip_delivered(recent, sent)


def calendar(
    spark: SparkSession,
    as_of: dt.date,
    day_offset: int = -1,
    max_age: int = MAX_AGE_DAYS,
    kinds: tuple[str, ...] = RETRIED_KINDS,
) -> DataFrame:
    """The packages that runs of the last ``max_age`` days and of the run date should have made."""
    return (
        spark.range(max_age + 1)
        .select(F.date_sub(day(as_of), F.col("id").cast("int")).alias("created"))
        .select(
            F.explode(F.array(*map(F.lit, kinds))).alias("kind"),
            F.date_add("created", day_offset).alias("business_date"),
            "created",
        )
    )


def mark_delivered(sent: DataFrame, now_sent: DataFrame) -> DataFrame:
    """The ledger with the new rows in place of older rows of the same packages."""
    return skip_delivered(sent, now_sent).unionByName(now_sent)


def stamp_run_date(config: DataFrame, as_of: Day) -> DataFrame:
    """Every configuration with the run date as its last run."""
    return config.withColumn("ult_envio", day(as_of))


def advance_sequence(numbering: DataFrame, series: Series = ADVANCED_SERIES, step: int = 1) -> DataFrame:
    """The numbering table with one series advanced."""
    return numbering.withColumn(
        "numero", F.when(series.matches(), F.col("numero") + step).otherwise(F.col("numero"))
    )


Extracts = Mapping[Kind, Callable[[], DataFrame]]
ExtractsOf = Callable[[Tables, int, dt.date], Extracts]


def units_extracts(t: Tables, supplier: int, first: dt.date, last: dt.date | None = None) -> Extracts:
    """The daily datasets in units of the business dates from ``first`` to ``last``, sales of each day alone."""
    days = {"supplier": supplier, "start": first, "end": last or first}
    return {
        SALES: lambda: sales.sales_range(t, **days),
        STOCK: lambda: stock.inventory_units(t, **days),
        CUSTOMERS: lambda: customers.customer_master(t),
    }


def boxes_extracts(t: Tables, supplier: int, first: dt.date, last: dt.date | None = None) -> Extracts:
    """The daily datasets with stock in purchase boxes, sales from the day on."""
    return {
        SALES: lambda: sales.sales_since(t, supplier=supplier, start=first),
        STOCK: lambda: stock.inventory_boxes(t, supplier=supplier, start=first, end=last or first),
        CUSTOMERS: lambda: customers.customer_master(t),
    }


# Datasets whose package of a business date holds later days as well.
OPEN_ENDED: Mapping[ExtractsOf, frozenset[str]] = {boxes_extracts: frozenset([SALES.name])}


def run_log(spark: SparkSession, root: str) -> DataFrame:
    """One row per run date and series: the number the series was advanced to."""
    columns = "sucursal int, tiponum string, letra string, empresa_id int, numero bigint, run_date date"
    return read_records(spark, columns, f"{root}/runs")


def config_at(config: DataFrame, root: str, as_of: dt.date) -> DataFrame:
    """The configuration with the last run up to ``as_of``, where the table has none later."""
    log = run_log(config.sparkSession, root).filter(F.col("run_date") <= day(as_of))
    last = log.agg(F.max("run_date").alias("run_date")).first()["run_date"]
    return config if last is None else config.withColumn("ult_envio", F.greatest("ult_envio", day(last)))


def numbering_at(
    numbering: DataFrame, root: str, as_of: dt.date, series: Series = ADVANCED_SERIES, before: bool = False
) -> DataFrame:
    """The numbering table with what the last run up to (or before) ``as_of`` advanced the series to."""
    run_date = F.col("run_date")
    log = run_log(numbering.sparkSession, root).filter(
        series.matches() & (run_date < day(as_of) if before else run_date <= day(as_of))
    )
    number = log.agg(F.max_by("numero", "run_date").alias("numero")).first()["numero"]
    if number is None:
        return numbering
    advanced = F.greatest("numero", F.lit(number).cast(numbering.schema["numero"].dataType))
    return numbering.withColumn("numero", F.when(series.matches(), advanced).otherwise(F.col("numero")))


def record_run(numbering: DataFrame, root: str, as_of: dt.date, series: Series) -> bool:
    """Stamp the run date and advance the series, in one step; False if that was done before.

    Of two runs of one day only one can publish the record.
    """
    number = numbering.select(package_number(advance_sequence(numbering, series), 0, series)).first()
    number = number[0] if number else None
    record = {**asdict(series), "numero": number, "run_date": as_of.isoformat()}
    name = "-".join(str(value) for value in asdict(series).values())
    return publish_once(numbering.sparkSession, f"{root}/runs/{name}/{as_of:%Y-%m-%d}.json", json.dumps(record))


def numbers_before(planned: DataFrame, log: DataFrame, numbering: DataFrame, series: Series = PACKAGE_SERIES) -> DataFrame:
    """The packages with ``numero``, their series' number as it was before the run that created them.

    The log has a row per run, so its history is one value.
    """
    run = F.struct("run_date", "numero")
    history = log.filter(series.matches()).agg(F.sort_array(F.collect_list(run)).alias("runs")).scalar()
    earlier = F.filter("runs", lambda r: r["run_date"] < F.col("created"))
    number = F.greatest(package_number(numbering, 0, series).cast("bigint"), F.get(earlier, F.size(earlier) - 1)["numero"])
    return planned.withColumn("runs", history).withColumn("numero", number).drop("runs")


def daily_run(
    spark: SparkSession,
    t: Tables,
    root: str,
    as_of: dt.date,
    day_offset: int = -1,
    extracts: ExtractsOf = units_extracts,
    series: Series = ADVANCED_SERIES,
    once_a_day: bool = True,
    file_format: str = "parquet",
    seconds: float | None = QUERY_SECONDS,
    transport: Transport | None = None,
) -> Mapping[str, Mapping[str, Decimal]]:
    """One run: gate, build what was not sent, send it, then the bookkeeping.

    Every dataset is built before the first is sent; run date and sequence move
    together, after all packages of the day are sent. A run that broke off can be
    repeated: the sequence is advanced from where it was before the run date. Of
    several runs at once each package is sent by one, and the run recorded by one.
    A dataset that takes longer than ``seconds`` ends the run, and nothing of it is
    seen. The base tables stay as they are; what runs change is kept under ``root``
    and laid over them. Returns the control totals of the packages sent, by kind.
    """
    config = config_at(t["configuracion"], root, as_of)
    numbering = t["numeracion"]
    for each in {PACKAGE_SERIES, series}:
        numbering = numbering_at(numbering, root, as_of, each, before=True)
    t = {**t, "configuracion": config, "numeracion": numbering}
    if once_a_day and due(config, as_of).filter(F.col("codigo") == MAIN_CONFIG).isEmpty():
        return {}
    settings = config_row(config)
    supplier, user = settings["codigo_proveedor"], settings["usuario"]
    business_date = as_of + dt.timedelta(days=day_offset)

    datasets = extracts(t, supplier, business_date)
    kinds = [kind.name for kind in datasets]
    known = packages(steps(spark, root, kinds, [business_date]))
    built = []
    with remembered_sizes():
        for kind, build in datasets.items():
            old = known.get((kind.name, business_date))
            if old is None or is_waiting(old):
                with time_limit(spark, seconds):
                    rows = build().withColumn("business_date", day(business_date))
                    built += build_days(rows, root, kind, [business_date], file_format, as_of)
    made = make(spark, root, built, {key: p.version for key, p in known.items()})
    sent = send(spark, root, made, user, transport)
    now = packages(steps(spark, root, kinds, [business_date]))
    if len(now) == len(kinds) and all(p.state == SENT for p in now.values()):
        record_run(numbering, root, as_of, series)
    return {p.kind: p.controls for p in sent}


def send_waiting(
    spark: SparkSession,
    root: str,
    as_of: dt.date,
    user: str | None = None,
    max_age: int = MAX_AGE_DAYS,
    transport: Transport | None = None,
) -> Mapping[tuple[str, dt.date], Mapping[str, Decimal]]:
    """Send the stock and sales packages of the last days that were made and not sent, as they were made.

    No base table is read.
    """
    return {p.key: p.controls for p in send(spark, root, waiting(spark, root, as_of, max_age, RETRIED_KINDS), user, transport)}


def on_days(t: Tables, days: list[dt.date]) -> Tables:
    """The tables with the facts of some days only; where facts are stored by date, no other day's folder is read."""
    chosen = [day(d) for d in days]
    return {**t, **{name: t[name].filter(F.col("fecha").isin(*chosen)) for name in FACTS}}


def run_backlog(
    spark: SparkSession,
    t: Tables,
    root: str,
    as_of: dt.date,
    day_offset: int = -1,
    extracts: ExtractsOf = units_extracts,
    file_format: str = "parquet",
    seconds: float | None = QUERY_SECONDS,
    transport: Transport | None = None,
) -> Mapping[tuple[str, dt.date], Mapping[str, Decimal]]:
    """Send the stock and sales packages of the last days that were not sent yet.

    Those that were made are sent as they are. What no run made is built now, in one
    job per dataset for all its days, with the number each package had before the run
    that should have made it. The run date and the sequences stay as they are.
    """
    config = config_at(t["configuracion"], root, as_of)
    t = {**t, "configuracion": config}
    settings = config_row(config)
    supplier, user = settings["codigo_proveedor"], settings["usuario"]
    controls = dict(send_waiting(spark, root, as_of, user, transport=transport))

    horizon = [as_of + dt.timedelta(days=day_offset - n) for n in range(MAX_AGE_DAYS + 1)]
    missing = skip_delivered(calendar(spark, as_of, day_offset), steps(spark, root, RETRIED_KINDS, horizon))
    base = package_number(t["numeracion"], 0).cast("bigint")
    missing = numbers_before(missing, run_log(spark, root), t["numeracion"]).withColumn("ahead", F.col("numero") - base)
    # At most one package a kind and day of the backlog's horizon.
    by_kind: dict[str, dict[dt.date, int]] = {}
    for row in missing.select(*PACKAGE, "ahead").collect():
        by_kind.setdefault(row["kind"], {})[row["business_date"]] = row["ahead"] or 0

    built = []
    with remembered_sizes():
        for name, ahead in sorted(by_kind.items()):
            days = sorted(ahead)
            open_ended = name in OPEN_ENDED.get(extracts, ())
            facts = t if open_ended else on_days(t, days)
            [(kind, build)] = [(k, b) for k, b in extracts(facts, supplier, days[0], days[-1]).items() if k.name == name]
            with time_limit(spark, seconds):
                rows, fecha = build(), F.to_date("Fecha")
                if open_ended:
                    dates = F.filter(F.array(*map(day, days)), lambda d: d <= fecha)
                    rows = rows.select("*", F.explode(dates).alias("business_date"))
                else:
                    rows = rows.withColumn("business_date", fecha).filter(F.col("business_date").isin(*map(day, days)))
                forward = F.create_map(*[x for d in days for x in (day(d), F.lit(ahead[d]))])
                kept = rows.schema["IdPaquete"].dataType
                rows = rows.withColumn("IdPaquete", (F.col("IdPaquete") + forward[F.col("business_date")]).cast(kept))
                built += build_days(rows, root, kind, days, file_format, as_of)
    made = make(spark, root, built, {})
    return controls | {p.key: p.controls for p in send(spark, root, made, user, transport)}
