"""Run the daily reports, the backlog or a single extract with spark-submit.

    spark-submit --py-files despacho.zip despacho/__main__.py daily \\
        --tables s3a://erp/tables --root s3a://reports --as-of 2023-06-01

Master, memory and shared folders come from the submitted session.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from despacho.operators.lookups import ADVANCED_SERIES, PACKAGE_SERIES, config_row
from despacho.plans import customers, runs, sales, stock
from despacho.plans.dimensions import Tables
from despacho.session import folder_bytes, tune
from despacho.sources.base import FACTS, parquet_tables

VARIANTS = {"units": runs.units_extracts, "boxes": runs.boxes_extracts}
SERIES = {"advanced": ADVANCED_SERIES, "package": PACKAGE_SERIES}
REPORTS: dict[str, Callable[[Tables, int, dt.date, dt.date], DataFrame]] = {
    "sales_range": lambda t, s, a, b: sales.sales_range(t, supplier=s, start=a, end=b),
    "sales_since": lambda t, s, a, b: sales.sales_since(t, supplier=s, start=a),
    "sales_by_alias": lambda t, s, a, b: sales.sales_by_alias(t, supplier=s, start=a, end=b),
    "inventory_units": lambda t, s, a, b: stock.inventory_units(t, supplier=s, start=a, end=b),
    "inventory_boxes": lambda t, s, a, b: stock.inventory_boxes(t, supplier=s, start=a, end=b),
    "inventory_alias_units": lambda t, s, a, b: stock.inventory_alias_units(t, supplier=s, start=a, end=b),
    "inventory_alias_boxes": lambda t, s, a, b: stock.inventory_alias_boxes(t, supplier=s, start=a, end=b),
    "customer_master": lambda t, s, a, b: customers.customer_master(t),
}


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="despacho", description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("daily", "backlog"):
        command = commands.add_parser(name)
        command.add_argument("--root", required=True, help="delivery folder that all executors share")
        command.add_argument("--as-of", type=dt.date.fromisoformat, default=None, help="run date, today by default")
        command.add_argument("--day-offset", type=int, default=-1)
        command.add_argument("--variant", choices=VARIANTS, default="units")
        command.add_argument("--format", choices=("parquet", "csv"), default="parquet", help="of the delivered files")
        if name == "daily":
            command.add_argument("--every-time", action="store_true", help="also when the run date is stamped already")
            command.add_argument("--series", choices=SERIES, default="advanced", help="the series that the run advances")
    report = commands.add_parser("report")
    report.add_argument("name", choices=REPORTS)
    report.add_argument("--start", type=dt.date.fromisoformat, required=True)
    report.add_argument("--end", type=dt.date.fromisoformat, default=None, help="the start date by default")
    report.add_argument("--output", required=True)
    for command in commands.choices.values():
        command.add_argument("--tables", required=True, help="folder with one parquet folder per base table")
        command.add_argument("--paths", type=json.loads, default={}, help='JSON of tables that lie elsewhere: {"venta": "s3a://..."}')
        command.add_argument("--renames", type=json.loads, default={}, help='JSON of renamed columns: {"venta": {"theirs": "ours"}}')
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName(f"despacho-{args.command}").getOrCreate()
    facts = (args.paths.get(name, f"{args.tables}/{name}") for name in FACTS)
    tune(spark, sum(folder_bytes(spark, path) for path in facts))
    t = parquet_tables(spark, args.tables, args.paths, args.renames)
    if args.command == "report":
        supplier = config_row(t["configuracion"])["codigo_proveedor"]
        rows = REPORTS[args.name](t, supplier, args.start, args.end or args.start)
        rows.write.mode("overwrite").parquet(args.output)
        return
    as_of = args.as_of or spark.range(1).select(F.current_date()).first()[0]
    variant = VARIANTS[args.variant]
    if args.command == "daily":
        series, once = SERIES[args.series], not args.every_time
        done = runs.daily_run(spark, t, args.root, as_of, args.day_offset, variant, series, once, args.format)
    else:
        done = runs.run_backlog(spark, t, args.root, as_of, args.day_offset, variant, args.format)
    for package, controls in done.items():
        print(package, {name: str(value) for name, value in controls.items()})


if __name__ == "__main__":
    main()
