"""Packages as made, steps that only one of several writers takes, runs at once, and limits on time."""

from __future__ import annotations

import datetime as dt
import threading
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from small import DAY, edge_rows, frames

from despacho.operators.limits import time_limit
from despacho.plans import delivery, runs, sales, stock
from despacho.sources.files import exists, publish_once, remove

AS_OF = DAY + dt.timedelta(days=1)
NEXT = DAY + dt.timedelta(days=1)


@pytest.fixture
def tables(spark):
    return frames(spark, edge_rows())


def sold(t, day=DAY):
    return sales.sales_range(t, supplier=3, start=day, end=day)


def dated(df, day=DAY):
    return df.withColumn("business_date", F.lit(day))


def texts(df):
    """CSV holds no difference between an empty text and none."""
    return sorted(repr(r).replace("=''", "=None") for r in df.collect())


def seen(spark, root, like, kind=delivery.SALES):
    return texts(delivery.delivered(spark, root, kind, like.schema).drop("business_date"))


def states(spark, root):
    return sorted((s.kind, s.business_date, s.version, s.state) for s in delivery.steps(spark, root).collect())


def doubled(t):
    twice = {c: (F.col(c) * 2).cast(t["item_venta"].schema[c].dataType) for c in ("cantidad", "cantidad_uni")}
    return {**t, "item_venta": t["item_venta"].withColumns(twice)}


def test_one_of_many_writers_publishes(spark, tmp_path):
    path = f"{tmp_path}/a/b/step.json"
    with ThreadPoolExecutor(16) as pool:
        won = list(pool.map(lambda i: publish_once(spark, path, f"writer {i}"), range(16)))
    assert sum(won) == 1
    assert (tmp_path / "a/b/step.json").read_text() == f"writer {won.index(True)}"
    assert [p.name for p in (tmp_path / "a/b").iterdir()] == ["step.json"]
    assert not publish_once(spark, path, "late") and exists(spark, path)
    remove(spark, f"{tmp_path}/a")
    assert not exists(spark, path)


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_readers_see_old_rows_until_new_ones_are_sent(spark, tables, tmp_path, file_format):
    root, old = str(tmp_path), sold(tables)
    new = sold(doubled(tables))

    def rows():
        return seen(spark, root, old)

    delivery.deliver(old, root, delivery.SALES, DAY, file_format)
    was = rows()
    assert was == texts(old) and was != texts(new)
    built = delivery.build_days(dated(new), root, delivery.SALES, [DAY], file_format)
    assert rows() == was
    known = delivery.packages(delivery.steps(spark, root))
    made = delivery.make(spark, root, built, {key: p.version for key, p in known.items()})
    assert rows() == was

    def while_sending(package, sent_rows):
        assert rows() == was
        assert texts(sent_rows.drop("business_date")) == texts(new)

    [sent] = delivery.send(spark, root, made, "dist", while_sending)
    assert rows() == texts(new)
    assert sent.controls["CantRegistros"] == new.count()
    assert [s[2:] for s in states(spark, root)] == [(1, "made"), (2, "sending"), (3, "sent"), (4, "made"), (5, "sending"), (6, "sent")]
    assert delivery.ledger(spark, root).first()["package_name"] == "dist_vta_20230510"


def test_a_build_that_breaks_off_leaves_the_package_as_it_is(spark, tables, tmp_path):
    root, old = str(tmp_path), sold(tables)
    delivery.deliver(old, root, delivery.SALES, DAY)
    broken = old.withColumn("Cantidad", F.raise_error(F.lit("lost")).cast("decimal(28,2)"))
    with pytest.raises(Exception, match="lost"):
        delivery.deliver(broken, root, delivery.SALES, DAY)
    assert seen(spark, root, old) == texts(old)


def test_waiting_packages_are_sent_as_they_were_made(spark, tables, tmp_path):
    root, old = str(tmp_path), sold(tables)
    stocked = stock.inventory_units(tables, supplier=3, start=DAY, end=DAY)
    late = AS_OF - dt.timedelta(days=4)
    for rows, kind, day, created in (
        (old, delivery.SALES, DAY, AS_OF),
        (stocked, delivery.STOCK, DAY, AS_OF - dt.timedelta(days=3)),
        (old, delivery.SALES, DAY - dt.timedelta(days=9), late),
        (tables["cliente"].select(F.col("codigo").alias("IdCliente")), delivery.CUSTOMERS, DAY, AS_OF),
    ):
        delivery.make(spark, root, delivery.build_days(dated(rows, day), root, kind, [day], created=created), {})
    assert delivery.ledger(spark, root).isEmpty()
    # No table is given: nothing can be read from one.
    done = runs.send_waiting(spark, root, AS_OF, "dist")
    assert sorted(done) == [("inv", DAY), ("vta", DAY)]
    assert done["vta", DAY]["CantRegistros"] == old.count()
    assert seen(spark, root, old) == texts(old)
    assert seen(spark, root, stocked, delivery.STOCK) == texts(stocked)
    assert runs.send_waiting(spark, root, AS_OF, "dist") == {}
    assert delivery.verification(spark, root).count() == 4


def test_the_backlog_sends_what_was_made_and_builds_the_rest(spark, tables, tmp_path):
    root, old = str(tmp_path), sold(tables)

    def stopped(package, rows):
        raise OSError("no connection")

    with pytest.raises(OSError, match="no connection"):
        runs.daily_run(spark, tables, root, AS_OF, transport=stopped)
    assert delivery.ledger(spark, root).isEmpty() and runs.run_log(spark, root).isEmpty()
    assert {s[3] for s in states(spark, root)} == {"made", "sending"}
    changed = doubled(tables)
    done = runs.run_backlog(spark, changed, root, AS_OF)
    rows = delivery.delivered(spark, root, delivery.SALES, old.schema)
    assert texts(rows.filter(F.col("business_date") == F.lit(DAY)).drop("business_date")) == texts(old)
    assert {day for kind, day in done if kind == "vta"} == {AS_OF - dt.timedelta(days=n) for n in range(1, 5)}
    # The customers wait for the run, which then is recorded; what the backlog sent stays.
    assert sorted(runs.daily_run(spark, changed, root, AS_OF)) == ["mc"]
    assert runs.run_log(spark, root).count() == 1


def test_a_run_after_a_failure_builds_unsent_packages_again(spark, tables, tmp_path):
    root, new = str(tmp_path), sold(doubled(tables))

    def stopped(package, rows):
        raise OSError("no connection")

    with pytest.raises(OSError):
        runs.daily_run(spark, tables, root, AS_OF, transport=stopped)
    assert sorted(runs.daily_run(spark, doubled(tables), root, AS_OF)) == ["inv", "mc", "vta"]
    assert seen(spark, root, new) == texts(new)


def test_two_runs_of_one_day(spark, tables, tmp_path):
    root = str(tmp_path)
    met = threading.Barrier(3, timeout=120)

    def extracts(t, supplier, first, last=None):
        met.wait()  # all runs have passed the gate
        return runs.units_extracts(t, supplier, first, last)

    with ThreadPoolExecutor(3) as pool:
        done = list(pool.map(lambda _: runs.daily_run(spark, tables, root, AS_OF, extracts=extracts), range(3)))
    assert sorted(kind for controls in done for kind in controls) == ["inv", "mc", "vta"]
    assert [s[0] for s in states(spark, root) if s[3] == "sent"] == ["inv", "mc", "vta"]
    assert delivery.ledger(spark, root).count() == 3
    log = runs.run_log(spark, root).collect()
    assert [(r["tiponum"], r["numero"], r["run_date"]) for r in log] == [("JJ", 8, AS_OF)]
    assert seen(spark, root, sold(tables)) == texts(sold(tables))
    assert runs.daily_run(spark, tables, root, AS_OF) == {}


def test_a_sending_without_an_end_is_taken_up_again(spark, tables, tmp_path):
    root, old = str(tmp_path), sold(tables)
    [made] = delivery.make(spark, root, delivery.build_days(dated(old), root, delivery.SALES, [DAY], created=AS_OF), {})
    sending = replace(made, version=2, state=delivery.SENDING)
    assert delivery._publish(spark, root, sending)
    assert not delivery.is_waiting(sending)
    assert runs.send_waiting(spark, root, AS_OF) == {}
    assert delivery.send(spark, root, [made]) == []  # somebody has it
    (tmp_path / "packages/vta/2023-05-10/00000002.json").unlink()
    assert delivery._publish(spark, root, replace(sending, at=sending.at - dt.timedelta(hours=2)))
    assert list(runs.send_waiting(spark, root, AS_OF)) == [("vta", DAY)]
    assert seen(spark, root, old) == texts(old)


def test_a_build_that_was_changed_is_not_sent(spark, tables, tmp_path):
    root, old = str(tmp_path), sold(tables)
    made = delivery.make(spark, root, delivery.build_days(dated(old), root, delivery.SALES, [DAY], created=AS_OF), {})
    folder = f"{root}/vta/build={made[0].build}/business_date={DAY}"
    sold(doubled(tables)).write.mode("overwrite").parquet(folder)
    with pytest.raises(RuntimeError, match="isn't as it was made"):
        runs.send_waiting(spark, root, AS_OF)
    assert delivery.ledger(spark, root).isEmpty()
    assert states(spark, root)[-1][3] == "made"


def test_digest_tells_rows_apart_not_their_order(spark):
    def digest(rows):
        df = spark.createDataFrame(rows, "a int, b string")
        return df.repartition(3).agg(delivery.content_digest(df.columns)).first()[0]

    rows = [(1, "x"), (2, None), (None, "2"), (1, "x")]
    assert digest(rows) == digest(rows[::-1])
    for other in (rows[1:], [*rows, (1, "x")], [(1, "y"), *rows[1:]], [(2, "x"), (1, None), *rows[2:]], [(None, "x"), *rows[1:]]):
        assert digest(other) != digest(rows)


def test_copies_for_the_receiver(spark, tables, tmp_path):
    root, out = f"{tmp_path}/root", f"{tmp_path}/out"
    runs.daily_run(spark, tables, root, AS_OF, transport=delivery.copy_to(out), file_format="csv")
    assert sorted(p.name.split("_", 1)[1] for p in (tmp_path / "out").iterdir()) == ["inv_20230510", "mc_20230510", "vta_20230510"]
    [folder] = (tmp_path / "out").glob("*_vta_*")
    copied = spark.read.option("header", "true").csv(str(folder))
    assert copied.columns == sold(tables).columns and copied.count() == sold(tables).count()


def endless(spark):
    return spark.range(10**13).agg(F.sum(F.sqrt("id")))


def test_time_limit(spark):
    with pytest.raises(TimeoutError, match="0.5 seconds"), time_limit(spark, 0.5):
        endless(spark).collect()
    with time_limit(spark, 60):
        assert spark.range(5).count() == 5
    with time_limit(spark, None):
        assert spark.range(5).count() == 5
    with pytest.raises(ValueError), time_limit(spark, 60):
        raise ValueError
    assert spark.range(5).count() == 5


def test_time_limit_is_for_its_own_thread(spark):
    slow = threading.Event()

    def other():
        slow.wait(10)
        return spark.range(200_000_000).agg(F.sum(F.sqrt("id"))).collect()

    with ThreadPoolExecutor(1) as pool:
        result = pool.submit(other)
        with pytest.raises(TimeoutError), time_limit(spark, 1):
            slow.set()
            endless(spark).collect()
        assert result.result(120)


def test_an_extract_over_its_time_leaves_package_and_ledger(spark, tables, tmp_path):
    root, old = str(tmp_path), sold(tables)
    delivery.deliver(old, root, delivery.SALES, DAY)
    before = states(spark, root)

    def slow(t, supplier, first, last=None):
        good = runs.units_extracts(t, supplier, first, last)
        late = F.lit(endless(spark).scalar()).cast("decimal(28,2)")
        return {**good, delivery.STOCK: lambda: good[delivery.STOCK]().withColumn("Cantidad", late)}

    with pytest.raises(TimeoutError):
        runs.daily_run(spark, tables, root, AS_OF, extracts=slow, seconds=3)
    assert states(spark, root) == before
    assert runs.run_log(spark, root).isEmpty()
    assert seen(spark, root, old) == texts(old)


def test_the_backlog_reads_waiting_days_only(spark, tables, tmp_path):
    """Facts stored by date; the folder of a day that needs no package can't be read."""
    t = dict(tables)
    for name in ("venta", "item_venta", "stockhistorico"):
        days = [DAY - dt.timedelta(days=n) for n in range(-1, 4)]
        rows = tables[name].filter(F.col("fecha").isin(days))
        rows.write.partitionBy("fecha").parquet(f"{tmp_path}/{name}")
        gap = tmp_path / name / f"fecha={DAY}"
        gap.mkdir(exist_ok=True)
        (gap / "part-broken.parquet").write_text("not a table")
        t[name] = spark.read.schema(rows.schema).parquet(f"{tmp_path}/{name}").select(*rows.columns)
    root = f"{tmp_path}/out"
    for kind, rows in ((delivery.SALES, sold(tables)), (delivery.STOCK, stock.inventory_units(tables, supplier=3, start=DAY, end=DAY))):
        delivery.deliver(rows, root, kind, DAY)
    done = runs.run_backlog(spark, t, root, AS_OF + dt.timedelta(days=1))
    assert {day for _, day in done} == {AS_OF - dt.timedelta(days=n) for n in (0, 2, 3)}
    found = delivery.delivered(spark, root, delivery.SALES, sold(tables).schema).filter(F.col("business_date") == F.lit(NEXT))
    assert texts(found.drop("business_date")) == texts(sold(tables, NEXT))
