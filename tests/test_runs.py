"""Delivery and the bookkeeping of runs."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from types import SimpleNamespace

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F
from small import DAY, edge_rows, frames

import __spark_entry__ as entry_points
from despacho import __main__ as command_line
from despacho.operators.lookups import ADVANCED_SERIES, PACKAGE_SERIES, Series, config_row, package_number
from despacho.plans import delivery, runs, stock
from despacho.plans.customers import customer_master
from despacho.session import SHUFFLE_BYTES, SPLIT_EARLY, folder_bytes, shared_folder, split_hot_keys_early, tune
from despacho.sources.sample import sample_tables

AS_OF = DAY + dt.timedelta(days=1)


def tuples(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def tables(spark):
    return frames(spark, edge_rows())


def packages(spark, *rows):
    made = [(kind, day, day + dt.timedelta(days=1)) for kind, day in rows]
    return spark.createDataFrame(made, "kind string, business_date date, created date")


def test_due(spark, tables):
    assert tuples(runs.due(tables["configuracion"], dt.date(2023, 5, 9)).select("codigo")) == [(2,)]
    assert tuples(runs.due(tables["configuracion"], DAY).select("codigo")) == [(1,), (2,)]


def test_stamp_and_advance(spark, tables):
    assert tuples(runs.stamp_run_date(tables["configuracion"], DAY).select("codigo", "ult_envio")) == [(1, DAY), (2, DAY)]
    advanced = runs.advance_sequence(tables["numeracion"])
    assert tuples(advanced.select("tiponum", "numero")) == [("BD", 41), ("FA", 900), ("JJ", 8)]
    advanced = runs.advance_sequence(tables["numeracion"], Series(1, "BD", "X", 1))
    assert spark.range(1).select(package_number(advanced, 1)).first()[0] == 43


def test_pending(spark):
    d = [DAY - dt.timedelta(days=n) for n in range(6)]
    made = packages(spark, *[("inv", x) for x in d], ("vta", d[1]), ("mc", d[1]))
    sent = spark.createDataFrame([("inv", d[1], dt.datetime(2023, 5, 1))], delivery.LEDGER)
    got = tuples(runs.pending(made, sent, AS_OF).select("kind", "business_date"))
    assert got == sorted([("inv", d[0]), ("inv", d[2]), ("inv", d[3]), ("vta", d[1])])


def test_mark_delivered_replaces(spark):
    first, second = dt.datetime(2023, 5, 1), dt.datetime(2023, 5, 2)
    sent = spark.createDataFrame([("inv", DAY, first), ("vta", DAY, first)], delivery.LEDGER)
    again = spark.createDataFrame([("inv", DAY, second), ("mc", DAY, second)], delivery.LEDGER)
    assert tuples(runs.mark_delivered(sent, again)) == [("inv", DAY, second), ("mc", DAY, second), ("vta", DAY, first)]


def test_package_name(spark):
    name = delivery.package_name(F.lit("dist"), F.lit("vta"), F.lit(DAY))
    assert spark.range(1).select(name).first()[0] == "dist_vta_20230510"


def test_config_row_must_be_single(spark, tables):
    assert config_row(tables["configuracion"])["codigo_proveedor"] == 3
    with pytest.raises(LookupError):
        config_row(tables["configuracion"].limit(0))
    with pytest.raises(LookupError):
        config_row(tables["configuracion"].unionAll(tables["configuracion"]))


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_delivery_replaces_its_own_day_only(spark, tables, tmp_path, file_format):
    def on(day, t=tables):
        return stock.inventory_units(t, supplier=3, start=day, end=day)

    root, next_day = str(tmp_path), DAY + dt.timedelta(days=1)
    first = delivery.deliver(on(DAY), root, delivery.STOCK, DAY, file_format)
    delivery.deliver(on(next_day), root, delivery.STOCK, next_day, file_format)
    schema = on(DAY).schema
    both = delivery.delivered(spark, root, delivery.STOCK, schema, file_format)
    want = [r for d in (DAY, next_day) for r in on(d).withColumn("business_date", F.lit(d)).collect()]
    assert sorted(map(repr, both.collect())) == sorted(map(repr, want))
    assert first["CantRegistros"] == on(DAY).count()
    assert first["TotalUnidades"] == on(DAY).agg(F.sum("Cantidad")).first()[0]

    again = delivery.deliver(on(DAY).limit(1), root, delivery.STOCK, DAY, file_format)
    assert again["CantRegistros"] == 1
    empty = delivery.deliver(on(next_day).limit(0), root, delivery.STOCK, next_day, file_format)
    assert empty == {"CantRegistros": Decimal(0), "TotalUnidades": Decimal(0)}
    left = delivery.delivered(spark, root, delivery.STOCK, schema, file_format)
    assert [r["business_date"] for r in left.collect()] == [DAY]


def test_daily_run(spark, tables, tmp_path):
    root = str(tmp_path)
    controls = runs.daily_run(spark, tables, root, AS_OF)
    assert sorted(controls) == ["inv", "mc", "vta"]
    assert controls["mc"] == {"CantRegistros": Decimal(3)}
    assert tuples(delivery.ledger(spark, root).select("kind", "business_date")) == [("inv", DAY), ("mc", DAY), ("vta", DAY)]
    assert delivery.verification(spark, root).count() == 5

    assert runs.daily_run(spark, tables, root, AS_OF) == {}  # gate
    assert runs.daily_run(spark, tables, root, AS_OF, once_a_day=False) == {}  # all delivered

    def number(as_of):
        return {r["tiponum"]: r["numero"] for r in runs.numbering_at(tables["numeracion"], root, as_of).collect()}

    assert number(AS_OF) == {"BD": 41, "JJ": 8, "FA": 900}  # repeated runs advanced it once
    assert number(DAY)["JJ"] == 7

    following = AS_OF + dt.timedelta(days=1)
    assert sorted(runs.daily_run(spark, tables, root, following, extracts=runs.boxes_extracts)) == ["inv", "mc", "vta"]
    assert number(following)["JJ"] == 9
    for as_of, stamped in ((DAY, dt.date(2023, 5, 9)), (AS_OF, AS_OF), (following, following)):
        assert config_row(runs.config_at(tables["configuracion"], root, as_of))["ult_envio"] == stamped


@pytest.mark.skipif(not TESTDATA.exists(), reason="needs the test tables")
def test_daily_run_over_the_sample(spark, tmp_path):
    folder = str(TESTDATA / "sf0.01")
    controls = runs.daily_run(spark, sample_tables(spark, folder), str(tmp_path), dt.date(1998, 5, 14))
    for kind, query in (("mc", "control_customers"), ("vta", "sales_daily"), ("inv", "inventory_daily")):
        expected = entry_points.queries()[query](spark, folder)
        if kind == "mc":
            assert controls[kind] == {r["INDICADOR"]: r["VALOR"] for r in expected.collect()}
        else:
            assert controls[kind]["CantRegistros"] == expected.count()


def test_package_number_follows_when_its_own_series_is_advanced(spark, tables, tmp_path):
    root = str(tmp_path)
    for n in range(3):
        runs.daily_run(spark, tables, root, AS_OF + dt.timedelta(days=n), series=PACKAGE_SERIES)
    master = delivery.delivered(spark, root, delivery.CUSTOMERS, customer_master(tables).schema)
    assert tuples(master.select("business_date", "IdPaquete").distinct()) == [
        (DAY + dt.timedelta(days=n), 42 + n) for n in range(3)
    ]
    assert runs.run_log(spark, root).count() == 3


def test_run_without_its_series_still_closes_the_gate(spark, tables, tmp_path):
    root = str(tmp_path)
    runs.daily_run(spark, tables, root, AS_OF, series=Series(9, "ZZ", "Z", 9))
    assert runs.daily_run(spark, tables, root, AS_OF) == {}


def test_failed_run_moves_nothing_and_can_be_repeated(spark, tables, tmp_path):
    root = str(tmp_path)

    def broken(t, supplier, day):
        good = runs.units_extracts(t, supplier, day)
        lost = F.raise_error(F.lit("lost")).cast("decimal(28,2)")
        return {**good, delivery.STOCK: lambda: good[delivery.STOCK]().withColumn("Cantidad", lost)}

    with pytest.raises(Exception, match="lost"):
        runs.daily_run(spark, tables, root, AS_OF, extracts=broken)
    assert delivery.ledger(spark, root).isEmpty()
    assert runs.run_log(spark, root).isEmpty()
    assert sorted(runs.daily_run(spark, tables, root, AS_OF)) == ["inv", "mc", "vta"]


def test_calendar(spark):
    got = tuples(runs.calendar(spark, AS_OF, max_age=1))
    before = DAY - dt.timedelta(days=1)
    assert got == [("inv", before, DAY), ("inv", DAY, AS_OF), ("vta", before, DAY), ("vta", DAY, AS_OF)]


def test_backlog_delivers_what_the_ledger_lacks(spark, tables, tmp_path):
    root = str(tmp_path)
    runs.daily_run(spark, tables, root, AS_OF)
    later = AS_OF + dt.timedelta(days=1)
    days = [AS_OF - dt.timedelta(days=n) for n in range(4)]
    done = runs.run_backlog(spark, tables, root, later)
    assert sorted(done) == sorted((k, d) for k in ("inv", "vta") for d in days if d != DAY)
    assert done["vta", AS_OF]["CantRegistros"] == 1
    assert runs.run_backlog(spark, tables, root, later) == {}
    assert delivery.ledger(spark, root).count() == 9
    number = {r["tiponum"]: r["numero"] for r in runs.numbering_at(tables["numeracion"], root, later).collect()}
    assert number["JJ"] == 8


def test_command_line(spark, tables, tmp_path, capsys):
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/tables/{name}")
    folder = ["--tables", f"{tmp_path}/tables"]
    command_line.main(["daily", *folder, "--root", f"{tmp_path}/out", "--as-of", "2023-05-11"])
    printed = capsys.readouterr().out
    assert [line.split()[0] for line in printed.splitlines()] == ["vta", "inv", "mc"]
    command_line.main(["backlog", *folder, "--root", f"{tmp_path}/out", "--as-of", "2023-05-11", "--variant", "boxes"])
    assert delivery.ledger(spark, f"{tmp_path}/out").count() == 9
    for name in command_line.REPORTS:
        command_line.main(["report", name, *folder, "--start", "2023-05-10", "--output", f"{tmp_path}/{name}"])
        assert spark.read.parquet(f"{tmp_path}/{name}").count() > 0


def test_tune_keeps_the_sessions_own_shuffle_number(spark):
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    tune(spark)  # the test session names spark.sql.shuffle.partitions
    assert spark.conf.get(initial, None) is None
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_early_split_respects_the_session(spark, conf):
    first, *rest = SPLIT_EARLY
    conf(**{first.replace(".", "__"): "77MB"})
    for key in rest:
        spark.conf.unset(key)
    split_hot_keys_early(spark)
    assert spark.conf.get(first) == "77MB"
    assert [spark.conf.get(key) for key in rest] == [SPLIT_EARLY[key] for key in rest]


class Session:
    """As much of a session as the shared folder asks for."""

    def __init__(self, master: str, folder: str | None = None):
        self.sparkContext = SimpleNamespace(master=master, applicationId="app")
        self.conf = SimpleNamespace(get=lambda key, default: folder if key == "spark.checkpoint.dir" else default)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(Session("k8s://cluster", "s3a://shared/")) == "s3a://shared"
    assert shared_folder(Session("local[2]")) == shared_folder(Session("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session("k8s://cluster"))
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_folder(spark) == named.rstrip("/")


def test_two_series_on_one_day_both_advance_and_repeats_advance_neither_twice(spark, tables, tmp_path):
    root = str(tmp_path)
    for series in (ADVANCED_SERIES, PACKAGE_SERIES, ADVANCED_SERIES, PACKAGE_SERIES):
        runs.daily_run(spark, tables, root, AS_OF, series=series, once_a_day=False)
    number = tables["numeracion"]
    for series in (ADVANCED_SERIES, PACKAGE_SERIES):
        number = runs.numbering_at(number, root, AS_OF, series)
    assert {r["tiponum"]: r["numero"] for r in number.collect()} == {"BD": 42, "JJ": 8, "FA": 900}
    assert runs.run_log(spark, root).count() == 2


@pytest.mark.parametrize("series, numbers", [(PACKAGE_SERIES, [42, 43, 44]), (ADVANCED_SERIES, [42, 42, 42])])
@pytest.mark.parametrize("extracts", [runs.units_extracts, runs.boxes_extracts])
def test_a_package_has_one_number_from_its_run_and_from_the_backlog(spark, tables, tmp_path, series, numbers, extracts):
    """The packages of three days are lost; the backlog builds and sends the same rows again."""
    root, again = f"{tmp_path}/own", f"{tmp_path}/again"
    days = [AS_OF + dt.timedelta(days=n) for n in range(3)]
    for as_of in days:
        for folder in (root, again):
            runs.daily_run(spark, tables, folder, as_of, series=series, extracts=extracts)
    schema = next(build for kind, build in extracts(tables, 3, DAY).items() if kind == delivery.STOCK)().schema

    def delivered(folder, kind, like):
        rows = delivery.delivered(spark, folder, kind, like.schema).filter(F.col("business_date") >= F.lit(DAY))
        return sorted(map(repr, rows.collect()))

    built = {kind: build() for kind, build in extracts(tables, 3, DAY).items() if kind.name in runs.RETRIED_KINDS}
    want = {kind: delivered(root, kind, df) for kind, df in built.items()}
    (tmp_path / "again" / "packages").rename(tmp_path / "lost")
    done = runs.run_backlog(spark, tables, again, days[-1], extracts=extracts)
    assert {d for _, d in done} >= {d - dt.timedelta(days=1) for d in days}
    assert {kind: delivered(again, kind, df) for kind, df in built.items()} == want
    stocked = delivery.delivered(spark, again, delivery.STOCK, schema)
    found = dict(tuples(stocked.select("business_date", "IdPaquete").distinct()))
    assert {d: n for d, n in zip([DAY + dt.timedelta(days=k) for k in range(3)], numbers) if d in found} == {
        d: n for d, n in found.items() if d >= DAY
    }


def test_backlog_scans_each_fact_table_once_a_dataset(spark, tables, tmp_path, monkeypatch):
    built = []

    def counted(t, supplier, first, last=None):
        return {
            kind: (lambda kind=kind, build=build: built.append((kind.name, first, last)) or build())
            for kind, build in runs.units_extracts(t, supplier, first, last).items()
        }

    runs.run_backlog(spark, tables, str(tmp_path), AS_OF, extracts=counted)
    assert sorted(name for name, _, _ in built) == ["inv", "vta"]
    assert all(last - first == dt.timedelta(days=3) for _, first, last in built)


def test_the_ledger_names_every_package(spark, tables, tmp_path):
    root = str(tmp_path)
    runs.daily_run(spark, tables, root, AS_OF)
    user = config_row(tables["configuracion"])["usuario"]
    assert tuples(delivery.ledger(spark, root).select("package_name")) == [(f"{user}_{k}_20230510",) for k in ("inv", "mc", "vta")]


def test_command_line_delivers_csv_from_renamed_tables(spark, tables, tmp_path):
    for name, df in tables.items():
        df = df.withColumnRenamed("codigoprov", "supplier_code") if name == "articulo" else df
        df.write.parquet(f"{tmp_path}/{'elsewhere' if name == 'venta' else 'tables'}/{name}")
    out = f"{tmp_path}/out"
    command_line.main(
        ["daily", "--tables", f"{tmp_path}/tables", "--root", out, "--as-of", "2023-05-11", "--format", "csv"]
        + ["--paths", f'{{"venta": "{tmp_path}/elsewhere/venta"}}', "--series", "package"]
        + ["--renames", '{"articulo": {"supplier_code": "codigoprov"}}']
    )
    assert list((tmp_path / "out" / "inv").rglob("*.csv"))
    assert delivery.ledger(spark, out).filter("package_name is not null").count() == 3
    assert {r["tiponum"] for r in runs.run_log(spark, out).collect()} == {"BD"}


def test_missing_folders_are_asked_for_not_caught(spark, tmp_path):
    assert not delivery.exists(spark, f"{tmp_path}/nothing")
    assert delivery.exists(spark, str(tmp_path))


def test_shuffles_are_sized_by_what_is_scanned(conf):
    settings = {}
    session = SimpleNamespace(
        conf=SimpleNamespace(set=settings.__setitem__),
        sparkContext=SimpleNamespace(defaultParallelism=10, getConf=lambda: SimpleNamespace(getAll=dict)),
    )
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    tune(session)
    assert settings[initial] == "200"
    tune(session, 1 << 40)
    assert settings[initial] == str((1 << 40) // SHUFFLE_BYTES)


def test_folder_bytes(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "b").write_bytes(b"x" * 100)
    assert folder_bytes(spark, str(tmp_path)) == 100
