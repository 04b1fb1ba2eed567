"""Plan shapes that must hold at scale."""

from __future__ import annotations

import re

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from despacho.operators import joins
from despacho.operators.lookups import is_code
from despacho.plans import dimensions, sales, stock
from despacho.session import THINNING
from despacho.sources.sample import sample_tables

pytestmark = pytest.mark.skipif(not TESTDATA.exists(), reason="needs the test tables")

FOLDER = str(TESTDATA / "sf0.01")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(autouse=True)
def whole_schemas(conf):
    conf(spark__sql__maxMetadataStringLength="1000")


@pytest.mark.parametrize("name", entry_points.PLANS)
def test_no_pairing_join_and_no_python(spark, name):
    plan = plan_of(entry_points.queries()[name](spark, FOLDER))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert node not in plan


def test_stock_is_one_shuffle_after_a_partial_sum(spark):
    plan = plan_of(entry_points.queries()["inventory_units"](spark, FOLDER))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "partial_sum" in plan
    assert "SortMergeJoin" not in plan


def test_conditions_reach_the_scans(spark):
    plan = plan_of(entry_points.queries()["inventory_units"](spark, FOLDER))
    assert "GreaterThanOrEqual(l_shipdate,1998-05-01T00:00)" in plan
    read = "l_partkey:bigint,l_linenumber:int,l_quantity:double,l_returnflag:string,l_shipdate:timestamp_ntz"
    assert f"ReadSchema: struct<{read}>" in plan
    plan = plan_of(entry_points.queries()["sales_range"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate,1998-04-01T00:00)" in plan
    assert "Not(EqualTo(l_partkey,723))" in plan
    assert "date_add" in plan and ">= 1998-04-01" in plan  # the lines' own date


def test_dates_on_stored_lines_reach_their_scan(spark, tmp_path):
    t = dict(sample_tables(spark, FOLDER))
    t["item_venta"].write.parquet(f"{tmp_path}/item_venta")
    t["item_venta"] = spark.read.parquet(f"{tmp_path}/item_venta")
    plan = plan_of(sales.sales_range(t, supplier=3, start="1/4/1998", end="30/6/1998"))
    assert "GreaterThanOrEqual(fecha,1998-04-01)" in plan
    assert "StringStartsWith(comprobante,PE)" in plan
    quantities = "cantidad:decimal(18,2),cantidad_uni:decimal(18,2)"
    assert f"ReadSchema: struct<comprobante:string,fecha:date,empresa_id:int,cod_art:bigint,{quantities}>" in plan


def test_lines_are_summed_before_they_meet_the_vouchers(spark, monkeypatch, conf):
    """A voucher with a third of all lines reaches the join as one row per product."""
    t = dict(sample_tables(spark, FOLDER))
    hot = t["venta"].filter(sales._reported("1995-01-01", None)).select(*sales.VOUCHER_KEY).orderBy("comprobante").limit(1)
    article = dimensions.products(t, 3).first()["cod_art"]
    copies = hot.withColumn("cod_art", F.lit(article)).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(30000))))
    t["item_venta"] = t["item_venta"].unionByName(
        copies.select(
            *sales.VOUCHER_KEY, "cod_art", F.lit(1).cast("decimal(18,2)").alias("cantidad"),
            F.lit(1).cast("decimal(18,2)").alias("cantidad_uni"),
        )
    )
    [sold] = joins.broadcast_small(dimensions.products(t, 3))
    lines = sales.net_lines(t, sold, "1995-01-01", "2002-01-01")
    per_voucher = lines.groupBy(*sales.VOUCHER_KEY).agg(F.count("*").alias("rows"), F.sum("units").alias("units"))
    largest = per_voucher.orderBy(F.desc("units")).first()
    assert largest["units"] >= 29000 and largest["rows"] <= 8


def test_hot_customer_is_split_where_nothing_fits_a_broadcast(spark, conf, monkeypatch):
    t = dict(sample_tables(spark, FOLDER))
    vouchers = t["venta"].repartition(16)
    t["venta"] = vouchers.withColumn("cod_cli", F.when(F.xxhash64("comprobante") % 3 == 0, 5).otherwise(F.col("cod_cli")))
    want = sorted(map(repr, sales.sales_range(t, supplier=3, start="1995-01-01", end="2002-01-01").collect()))
    assert want

    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    )
    df = sales.sales_range(t, supplier=3, start="1995-01-01", end="2002-01-01")
    assert sorted(map(repr, df.collect())) == want
    split = re.findall(r"SortMergeJoin\(skew=true\) \[(\w+)#", plan_of(df))
    assert "cod_cli" in split


def test_lines_are_thinned_beneath_the_join_of_their_view(spark):
    plan = plan_of(entry_points.queries()["sales_range"](spark, FOLDER))
    assert plan.index("[o_orderkey#") < plan.index("LeftSemi") < plan.index("FileScan parquet [l_orderkey")


def test_no_dimension_is_broadcast_beyond_the_limit(spark, monkeypatch, conf):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    t = sample_tables(spark, FOLDER)
    for df in (
        sales.sales_by_alias(t, supplier=3, start="1998-04-01", end="1998-06-30"),
        stock.inventory_alias_boxes(t, supplier=3, start="1998-05-01", end="1998-05-31"),
    ):
        assert "BroadcastHashJoin" not in plan_of(df)
        assert "LeftSemi" not in plan_of(df)


def test_vouchers_meet_the_lines_before_a_large_customer_table(spark, monkeypatch, conf):
    """With customers beyond the limit the vouchers are shuffled once, on their key, ahead of the customer join."""
    t = sample_tables(spark, FOLDER)
    sizes = dict(zip(("customers", "products"), joins.measured_bytes(dimensions.customers(t), dimensions.products(t, 3))))
    assert sizes["products"] < sizes["customers"]
    monkeypatch.setattr(joins, "BROADCAST_BYTES", sizes["customers"] - 1)
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = plan_of(sales.sales_range(t, supplier=3, start="1998-04-01", end="1998-06-30", excluded_article=723))
    joined = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    customer, voucher = (next(i for i, line in enumerate(joined) if key in line) for key in ("[cod_cli#", "[comprobante#"))
    assert customer < voucher  # the customer join stands above the voucher join
    below = plan[plan.index("SortMergeJoin [comprobante#") :]
    vouchers_side = below[: below.index("FileScan parquet")]
    assert len(re.findall("Exchange hashpartitioning", vouchers_side)) == 1 and "cod_cli" in vouchers_side
    assert "hashpartitioning(comprobante" in vouchers_side


def test_padded_codes_leave_the_scan_filters(spark):
    plan = plan_of(entry_points.queries()["sales_range_padded_codes"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate,1998-04-01T00:00)" in plan
    stored = spark.read.parquet(f"{FOLDER}/orders.parquet").select(F.col("o_orderpriority").alias("estado"))
    assert "StringStartsWith(estado,1)" in plan_of(stored.filter(is_code(F.col("estado"), "1"))) or "StringStartsWith(o_orderpriority,1)" in plan_of(
        stored.filter(is_code(F.col("estado"), "1"))
    )


def test_the_sum_of_broadcasts_is_bounded(spark):
    frames = [spark.range(100 * (i + 1)).withColumnRenamed("id", f"k{i}") for i in range(7)]
    sizes = joins.measured_bytes(*frames)
    every = joins.broadcast_small(*frames, limit=sizes[-1], total=sum(sizes))
    assert all(d.small for d in every)
    some = joins.broadcast_small(*frames, limit=sizes[-1], total=sum(sizes[:4]) + 1)
    assert [d.small for d in some] == [True] * 4 + [False] * 3


def test_a_run_measures_a_dimension_once(spark, monkeypatch):
    measured = []
    measure = joins.measured_bytes
    monkeypatch.setattr(joins, "measured_bytes", lambda *frames: measured.append(len(frames)) or measure(*frames))
    t = sample_tables(spark, FOLDER)
    with joins.remembered_sizes():
        for _ in range(3):
            sales.sales_range(t, supplier=3, start="1998-04-01", end="1998-06-30")
        sales.sales_since(t, supplier=3, start="1998-04-01")
    assert measured == [7, 1]  # all dimensions; then the products without an excluded article
    sales.sales_since(t, supplier=3, start="1998-04-01")
    assert len(measured) == 3


def test_measuring_customers_reads_no_column(spark):
    frame = dimensions.customers(sample_tables(spark, FOLDER))
    plan = plan_of(frame.select(joins._row_bytes(frame).alias("bytes")).agg(F.sum("bytes")))
    assert "ReadSchema: struct<>" in plan


def test_lines_are_thinned_by_a_bloom_filter_where_products_are_large(spark, monkeypatch, conf, tmp_path):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold="0",
        **{key.replace(".", "__"): value for key, value in THINNING.items()},
    )
    t = dict(sample_tables(spark, FOLDER))
    t["item_venta"].write.parquet(f"{tmp_path}/item_venta")
    t["item_venta"] = spark.read.parquet(f"{tmp_path}/item_venta")
    df = sales.sales_range(t, supplier=3, start="1998-04-01", end="1998-06-30", excluded_article=723)
    assert "might_contain" in plan_of(df)
    assert df.count() == 183
