
from __future__ import annotations

import datetime as dt
import sys
import uuid
from collections.abc import Callable
from dataclasses import asdict
from functools import reduce
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle_texts
from despacho.functions import vouchers
from despacho.functions.dates import age_in_days, business_date, day, iso_text
from despacho.functions.quantities import TOTAL, converted, coordinate_text
from despacho.operators.control import control_totals
from despacho.operators.joins import broadcast_small
from despacho.operators.lookups import MAIN_CONFIG, PACKAGE_SERIES, distributor_code, package_number
from despacho.plans import customers, delivery, dimensions, runs, sales, stock, stock_days
from despacho.plans.dimensions import Tables
from despacho.session import delivery_folder, shared_folder
from despacho.sources.bucketed import bucketed_tables, write_bucketed
from despacho.sources.collation import collated, plain
from despacho.sources.sample import sample_ledger, sample_packages, sample_tables

try:
    from despacho.llm import queries as llm_queries
except ImportError:  # the package is optional
    llm_queries = None

SUPPLIER = 3
EXCLUDED = 723  # the excluded article of the test tables
AS_OF = "1998-05-14"
QUARTER = {"supplier": SUPPLIER, "start": "1998-04-01", "end": "1998-06-30"}
MAY = {"supplier": SUPPLIER, "start": "1/5/1998", "end": "31/5/1998"}


SECOND_SALES_DAY = {"supplier": SUPPLIER, "start": "1998-05-11", "end": "1998-05-11"}
SECOND_STOCK_DAY = {"supplier": SUPPLIER, "start": "1998-05-23", "end": "1998-05-23"}


def _one_day() -> dict:
    yesterday = business_date(AS_OF, -1)
    return {"supplier": SUPPLIER, "start": yesterday, "end": yesterday}


EXTRACTS: dict[str, Callable[[Tables], DataFrame]] = {
    "sales_range": lambda t: sales.sales_range(t, **QUARTER, excluded_article=EXCLUDED),
    "sales_daily": lambda t: sales.sales_range(t, **_one_day(), excluded_article=EXCLUDED),
    "sales_second_day": lambda t: sales.sales_range(t, **SECOND_SALES_DAY, excluded_article=EXCLUDED),
    "sales_since": lambda t: sales.sales_since(t, supplier=SUPPLIER, start="2001-07-25"),
    "sales_by_alias": lambda t: sales.sales_by_alias(t, **QUARTER),
    "inventory_units": lambda t: stock.inventory_units(t, **MAY, excluded_article=EXCLUDED),
    "inventory_daily": lambda t: stock.inventory_units(t, **_one_day(), excluded_article=EXCLUDED),
    "inventory_second_day": lambda t: stock.inventory_units(t, **SECOND_STOCK_DAY, excluded_article=EXCLUDED),
    "inventory_boxes": lambda t: stock.inventory_boxes(t, **MAY),
    "inventory_alias_units": lambda t: stock.inventory_alias_units(t, **MAY),
    "inventory_alias_boxes": lambda t: stock.inventory_alias_boxes(t, **MAY),
    "customer_master": customers.customer_master,
}

CONTROLS = {
    "control_sales": ("sales_range", delivery.SALES),
    "control_sales_since": ("sales_since", delivery.SALES),
    "control_sales_alias": ("sales_by_alias", delivery.SALES),
    "control_inventory": ("inventory_units", delivery.STOCK),
    "control_inventory_boxes": ("inventory_boxes", delivery.STOCK),
    "control_inventory_alias_units": ("inventory_alias_units", delivery.STOCK),
    "control_inventory_alias_boxes": ("inventory_alias_boxes", delivery.STOCK),
    "control_customers": ("customer_master", delivery.CUSTOMERS),
}


def _control(extract: str, kind: delivery.Kind) -> Callable[[Tables], DataFrame]:
    return lambda t: control_totals(EXTRACTS[extract](t), kind.counted, kind.summed)


def _package_header(t: Tables) -> DataFrame:
    return t["configuracion"].select(
        "codigo",
        distributor_code(t["configuracion"]).alias("id_distribuidor"),
        package_number(t["numeracion"], 1).alias("id_paquete"),
        package_number(t["numeracion"], 0).alias("id_paquete_actual"),
    )


def _delivery_names(t: Tables) -> DataFrame:
    user = t["configuracion"].filter(F.col("codigo") == MAIN_CONFIG).select("usuario").scalar()
    return sample_packages(t, AS_OF).select(
        "kind",
        "business_date",
        iso_text(F.col("business_date")).alias("fecha_texto"),
        age_in_days(AS_OF, F.col("created")).alias("age_days"),
        delivery.package_name(user, F.col("kind"), F.col("business_date")).alias("package_name"),
    )


def _skip_delivered(t: Tables) -> DataFrame:
    packages = sample_packages(t, AS_OF)
    return runs.skip_delivered(packages, sample_ledger(packages))


def _pending(t: Tables) -> DataFrame:
    packages = sample_packages(t, AS_OF)
    return runs.pending(packages, sample_ledger(packages), AS_OF)


def _mark_delivered(t: Tables) -> DataFrame:
    packages = sample_packages(t, AS_OF)
    again = packages.filter((F.col("kind") == "vta") & (age_in_days(AS_OF, F.col("business_date")) <= 30)).select(
        "kind", "business_date", F.lit(f"{AS_OF} 08:00:00").cast("timestamp_ntz").alias("sent_at")
    )
    return runs.mark_delivered(sample_ledger(packages), again)


def _unit_conversion(t: Tables) -> DataFrame:
    articles = t["articulo"].select(F.col("codigo").alias("cod_art"), "codigoprov", "uxb", "uxbcompra")
    [articles] = broadcast_small(articles)
    in_boxes = converted(F.col("cantidad"), F.col("uxb"), F.col("uxbcompra"))
    return (
        articles.join_to(t["item_venta"], "cod_art")
        .groupBy(F.col("codigoprov").alias("IdProducto"))
        .agg(F.sum(in_boxes).cast(TOTAL).alias("converted"), F.sum("cantidad_uni").cast(TOTAL).alias("units"))
    )


def _document_types(t: Tables) -> DataFrame:
    per_line_key = t["item_venta"].groupBy(*sales.VOUCHER_KEY).agg(F.sum("cantidad").alias("net"))
    net, voucher = F.col("net"), F.col("comprobante")
    return (
        t["venta"]
        .join(per_line_key, sales.VOUCHER_KEY)
        .groupBy("comprobante")
        .agg(F.sum("net").cast(TOTAL).alias("net"))
        .select(
            "comprobante",
            "net",
            vouchers.document_type(net, voucher).alias("tipo"),
            vouchers.document_type_legacy(net, voucher).alias("tipo_anterior"),
        )
    )


def _associated_vouchers(t: Tables) -> DataFrame:
    voucher, reference = F.col("comprobante"), F.col("referencia")
    return t["venta"].select(
        "comprobante",
        vouchers.associated_voucher(voucher, reference).alias("asociado"),
        vouchers.associated_voucher_legacy(reference).alias("asociado_anterior"),
    )


def _customer_types(t: Tables) -> DataFrame:
    types = broadcast_small(*dimensions.type_dimensions(t))
    return dimensions.with_type(dimensions.customers(t), *types, required=False).select(
        F.col("cod_cli").alias("IdCliente"),
        vouchers.customer_type_or_default(F.col("tipo")).alias("IdTipoDeCliente"),
        F.col("tipo").alias("tipo_sin_defecto"),
    )


def _voucher_reasons(t: Tables) -> DataFrame:
    reason, seller = broadcast_small(dimensions.reasons(t), dimensions.sellers(t))
    with_reason = reason.join_to(t["venta"], "motivodev", "left")
    return seller.join_to(with_reason, "cod_ven", "left").select("comprobante", "motivo", "vendedor")


def _padded(t: Tables) -> Tables:
    """The tables with blanks behind the codes that conditions compare, as a fixed-width column has them."""
    numbering = t["numeracion"]
    for name in ("tiponum", "letra"):
        numbering = numbering.withColumn(name, F.rpad(name, 5, " "))
    return {**t, "numeracion": numbering, "cliente": t["cliente"].withColumn("estado", F.rpad("estado", 4, " "))}


def _mixed(t: Tables) -> Tables:
    """The tables with texts in mixed case and with blanks behind them, under the source's collation."""

    def variant(df: DataFrame, by: str, **columns: Column) -> DataFrame:
        other = {c: F.concat(F.lower(value), F.lit("  ")) for c, value in columns.items()}
        return df.withColumns({c: F.when(F.col(by) % 2 == 0, other[c]).otherwise(F.upper(value)) for c, value in columns.items()})

    codes = {name: F.col(name) for name in ("tiponum", "letra")}
    return collated({
        **t,
        "item_venta": variant(t["item_venta"], "cod_art", comprobante=F.col("comprobante")),
        # Four letters, so that many articles share a code.
        "articulo": variant(t["articulo"], "codigo", codigoprov=F.left("codigoprov", F.lit(4))),
        "cliente": variant(t["cliente"], "codigo", estado=F.col("estado")),
        "numeracion": variant(t["numeracion"], "sucursal", **codes).withColumns({c: F.lower(c) for c in codes}),
    })


def _collated(extract: str) -> Callable[[Tables], DataFrame]:
    def plan(t: Tables) -> DataFrame:
        rows = plain(EXTRACTS[extract](_mixed(t)))
        shown = [c for c in ("IdProducto", "NroComprobante") if c in rows.columns]
        return rows.withColumns({c: F.lower(F.rtrim(c)) for c in shown})

    return plan


def _backlog_numbers(t: Tables) -> DataFrame:
    """Waiting packages with the number before their run, after a run on every day with vouchers."""
    run_days = t["venta"].select(F.col("fecha").alias("run_date")).distinct()
    number = (F.datediff("run_date", F.lit("1995-01-01")) + 41).cast("bigint").alias("numero")
    key = [F.lit(value).alias(name) for name, value in asdict(PACKAGE_SERIES).items()]
    log = run_days.select(*key, number, "run_date")
    return runs.numbers_before(_pending(t), log, t["numeracion"])


def _control_text_ids(t: Tables) -> DataFrame:
    """Two of six customers have an id that reads as a number."""
    code, kind = F.col("codigo").cast("string"), F.col("codigo") % 6
    ids = (
        F.when(kind == 0, F.concat(code, F.lit("D")))
        .when(kind == 1, F.concat(code, F.lit("f")))
        .when(kind == 2, "NaN")
        .when(kind == 3, "Infinity")
        .when(kind == 4, F.concat(F.lit("-"), code, F.lit(".50")))
        .otherwise(code)
    )
    return control_totals(t["cliente"].select(ids.alias("id")), "id")


def _coordinate_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Float coordinates; the sample's tables hold decimals."""
    balance = spark.read.parquet(f"{folder}/customer.parquet")
    return balance.select(
        F.col("c_custkey").alias("codigo"), coordinate_text(F.col("c_acctbal") / 7, floating=True).alias("latitud")
    )


def _delivered_rows(t: Tables) -> DataFrame:
    """What a reader finds after two days were delivered, one of them twice and a third without rows."""
    spark = t["venta"].sparkSession
    root = f"{delivery_folder(spark)}/{spark.sparkContext.applicationId}/rows"
    second, empty, one = dt.date(1998, 5, 11), dt.date(1990, 1, 1), dt.date(1998, 5, 13)
    rows = EXTRACTS["sales_second_day"](t)
    delivery.deliver(rows.unionAll(rows), root, delivery.SALES, second)
    delivery.deliver(rows.limit(0), root, delivery.SALES, empty)
    both = [rows.withColumn("business_date", day(second)), EXTRACTS["sales_daily"](t).withColumn("business_date", day(one))]
    delivery.deliver_days(both[0].unionAll(both[1]), root, delivery.SALES, [second, one])
    return delivery.delivered(spark, root, delivery.SALES, rows.schema)


def _with_doubled_lines(t: Tables) -> Tables:
    doubled = {c: (F.col(c) * 2).cast(t["item_venta"].schema[c].dataType) for c in ("cantidad", "cantidad_uni")}
    return {**t, "item_venta": t["item_venta"].withColumns(doubled)}


def _sales_and_stock(t: Tables, supplier: int, first: dt.date, last: dt.date | None = None) -> runs.Extracts:
    days = {"supplier": supplier, "start": first, "end": last or first, "excluded_article": EXCLUDED}
    return {delivery.SALES: lambda: sales.sales_range(t, **days), delivery.STOCK: lambda: stock.inventory_units(t, **days)}


def _backlog_resend(t: Tables) -> DataFrame:
    """Sales packages of two days are made; then all lines change and the backlog runs.

    It sends these as they were made, leaves one that was made too long ago, and builds
    those of the two days that no run made from what the lines are now.
    """
    spark = t["venta"].sparkSession
    root = f"{delivery_folder(spark)}/{spark.sparkContext.applicationId}/resend-{uuid.uuid4().hex}"
    for created, days in ((dt.date(1998, 5, 12), ("1998-05-11", "1998-05-13")), (dt.date(1998, 5, 5), ("1998-05-04",))):
        days = [dt.date.fromisoformat(d) for d in days]
        rows = _sales_and_stock(t, SUPPLIER, days[0], days[-1])[delivery.SALES]().withColumn("business_date", F.to_date("Fecha"))
        delivery.make(spark, root, delivery.build_days(rows, root, delivery.SALES, days, created=created), {})
    runs.run_backlog(spark, _with_doubled_lines(t), root, dt.date.fromisoformat(AS_OF), extracts=_sales_and_stock)
    return delivery.delivered(spark, root, delivery.SALES, rows.drop("business_date").schema)


def _kept_stock(t: Tables) -> DataFrame:
    """All stock extracts of May from the stock kept by day, after the files of one day were rewritten.

    Only that day is made anew.
    """
    spark = t["venta"].sparkSession
    root = f"{delivery_folder(spark)}/{spark.sparkContext.applicationId}/stock-{uuid.uuid4().hex}"
    path, changed = f"{root}/facts", dt.date(1998, 5, 13)
    of_may = t["stockhistorico"].filter(F.col("fecha").between(day("1998-05-01"), day("1998-05-31")))
    of_may.hint("rebalance", "fecha").write.partitionBy("fecha").parquet(path)

    def stored() -> Tables:
        facts = spark.read.schema(of_may.schema).parquet(path)
        return {**t, "stockhistorico": facts}

    stock_days.refresh(stored(), root)
    twice = of_may.filter(F.col("fecha") == day(changed)).drop("fecha")
    twice = twice.withColumn("stocktot", (F.col("stocktot") * 2).cast(of_may.schema["stocktot"].dataType))
    twice.write.mode("overwrite").parquet(f"{path}/fecha={changed}")
    made = stock_days.refresh(stored(), root)
    if made != [changed]:
        raise RuntimeError(f"days made anew: {made}")
    kept = stock_days.with_kept_stock(t, root)
    columns = ["IdPaquete", F.to_date("Fecha").alias("Fecha"), "IdProducto", "Cantidad"]
    extracts = [
        EXTRACTS[name](kept).select(F.lit(name).alias("extract"), *columns)
        for name in ("inventory_units", "inventory_boxes", "inventory_alias_units", "inventory_alias_boxes")
    ]
    return reduce(DataFrame.unionAll, extracts)


def _sales_range_bucketed(t: Tables) -> DataFrame:
    """Vouchers and lines stored in buckets of their key, and joined from there."""
    spark = t["venta"].sparkSession
    name = f"despacho_{uuid.uuid4().hex}"
    names = write_bucketed(t, f"{shared_folder(spark)}/{name}", spark.sparkContext.defaultParallelism, name)
    return EXTRACTS["sales_range"](bucketed_tables(spark, t, names))


def _delivery_roundtrip(t: Tables) -> DataFrame:
    """Deliver one day's three packages to the shared folder; their control totals as read back."""
    spark = t["venta"].sparkSession
    root = f"{delivery_folder(spark)}/{spark.sparkContext.applicationId}/roundtrip"
    day = dt.date(1998, 5, 13)
    delivery.deliver(EXTRACTS["sales_daily"](t), root, delivery.SALES, day)
    delivery.deliver(EXTRACTS["inventory_daily"](t), root, delivery.STOCK, day)
    delivery.deliver(EXTRACTS["customer_master"](t), root, delivery.CUSTOMERS, day)
    return delivery.verification(spark, root).select("kind", "business_date", "INDICADOR", "VALOR")


PLANS: dict[str, Callable[[Tables], DataFrame]] = {
    **EXTRACTS,
    **{name: _control(extract, kind) for name, (extract, kind) in CONTROLS.items()},
    "config_lookup": lambda t: t["configuracion"].filter(F.col("codigo") == MAIN_CONFIG),
    "package_header": _package_header,
    "due_gate": lambda t: runs.due(t["configuracion"], AS_OF),
    "stamp_run_date": lambda t: runs.stamp_run_date(t["configuracion"], AS_OF),
    "advance_sequence": lambda t: runs.advance_sequence(t["numeracion"]),
    "delivery_names": _delivery_names,
    "skip_delivered": _skip_delivered,
    "pending_deliveries": _pending,
    "backlog_numbers": _backlog_numbers,
    "mark_delivered": _mark_delivered,
    "sales_range_padded_codes": lambda t: EXTRACTS["sales_range"](_padded(t)),
    "customer_master_padded_codes": lambda t: EXTRACTS["customer_master"](_padded(t)),
    "sales_range_collated": _collated("sales_range"),
    "inventory_units_collated": _collated("inventory_units"),
    "customer_master_collated": _collated("customer_master"),
    "control_text_ids": _control_text_ids,
    "delivered_rows": _delivered_rows,
    "backlog_resend": _backlog_resend,
    "kept_stock": _kept_stock,
    "sales_range_bucketed": _sales_range_bucketed,
    "unit_conversion": _unit_conversion,
    "document_types": _document_types,
    "associated_vouchers": _associated_vouchers,
    "customer_types": _customer_types,
    "voucher_reasons": _voucher_reasons,
    "delivery_roundtrip": _delivery_roundtrip,
}


def _over_sample(plan: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plan(sample_tables(spark, sf_dir))

    return query


def entry(spark: SparkSession) -> DataFrame:
    """Net sales of a quarter at sf0.001."""
    return queries()["sales_range"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {name: _over_sample(plan) for name, plan in PLANS.items()} | {"coordinate_texts": _coordinate_texts}
    return own | (llm_queries.queries() if llm_queries else {})


def oracle_sql() -> dict[str, str]:
    return oracle_texts.texts() | (llm_queries.oracle_sql() if llm_queries else {})
