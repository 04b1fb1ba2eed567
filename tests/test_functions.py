"""Column expressions on literal rows: NULL, zero, negative and exact-half cases."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from despacho.functions import dates, quantities, vouchers
from despacho.functions.quantities import coordinate_text
from despacho.operators.control import control_totals, numeric_count
from despacho.operators.joins import broadcast_small, measured_bytes


def values(spark, schema, rows, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def one(spark, column):
    return spark.range(1).select(column).first()[0]


NETS = [Decimal(1), Decimal(0), Decimal(-1), None]


@pytest.mark.parametrize(
    "prefix, current, legacy",
    [("FA", "OR", "FC"), ("PE", "OR", "FC"), ("FR", "OR", "NC"), ("ND", "DE", "ND"), ("NC", "CR", "NC")],
)
def test_document_types(spark, prefix, current, legacy):
    got = values(
        spark,
        "net decimal(18,2), v string",
        [(n, prefix + "1") for n in NETS],
        vouchers.document_type(F.col("net"), F.col("v")),
        vouchers.document_type_legacy(F.col("net"), F.col("v")),
    )
    assert got == [(current, legacy), (current, legacy), ("CR", "NC"), ("CR", "NC")]


def test_associated_vouchers(spark):
    got = values(
        spark,
        "v string, ref string",
        [("NC1", "FA9"), ("NC1", None), ("FA1", "NC9"), ("FA1", None), (None, "NC9")],
        vouchers.associated_voucher(F.col("v"), F.col("ref")),
        vouchers.associated_voucher_legacy(F.col("ref")),
    )
    assert got == [("FA9", None), ("", None), ("", "NC9"), ("", None), ("", "NC9")]


def test_default_customer_type(spark):
    got = values(spark, "c int", [(5,), (None,)], vouchers.customer_type_or_default(F.col("c")))
    assert got == [(5,), (8,)]


def test_conversion_divides_after_multiplying(spark):
    got = values(
        spark,
        "q decimal(18,2), b decimal(18,2), p decimal(18,2)",
        [(Decimal(1), Decimal(2), Decimal(3)), (Decimal(3), Decimal(6), Decimal(4)), (None, Decimal(1), Decimal(1))],
        quantities.converted(F.col("q"), F.col("b"), F.col("p")),
    )
    assert got == [(Decimal("0.666667"),), (Decimal("4.500000"),), (None,)]


def test_conversion_by_zero(spark):
    rows = [(Decimal(1), Decimal(2), Decimal(0))]
    schema = "q decimal(18,2), b decimal(18,2), p decimal(18,2)"
    columns = F.col("q"), F.col("b"), F.col("p")
    assert values(spark, schema, rows, quantities.try_converted(*columns)) == [(None,)]
    with pytest.raises(PySparkException, match="DIVIDE_BY_ZERO"):
        values(spark, schema, rows, quantities.converted(*columns))


def test_two_decimals_round_halves_away_from_zero(spark):
    rows = [(Decimal("2.0050"),), (Decimal("-2.3450"),), (Decimal("2.0049"),)]
    got = values(spark, "x decimal(18,4)", rows, quantities.fixed2(F.col("x")))
    assert got == [(Decimal("2.01"),), (Decimal("-2.35"),), (Decimal("2.00"),)]


def test_purchase_boxes_round_stock_first(spark):
    rows = [(Decimal("1.005"), Decimal(2)), (Decimal("1"), Decimal(3)), (Decimal("1"), None)]
    got = values(
        spark, "x decimal(18,4), p decimal(18,2)", rows, quantities.in_purchase_boxes(F.col("x"), F.col("p"))
    )
    assert got == [(Decimal("0.51"),), (Decimal("0.33"),), (None,)]


def test_floor_tests_the_raw_total(spark):
    nine = Decimal(9)
    rows = [(Decimal("0.004"), Decimal("0.00")), (Decimal(0), nine), (Decimal(-1), nine), (None, nine), (Decimal(1), None)]
    got = values(
        spark, "raw decimal(18,4), x decimal(18,2)", rows, quantities.floored_at_zero(F.col("raw"), F.col("x"))
    )
    assert [r[0] for r in got] == [0, 0, 0, 0, None]


def test_coordinates(spark):
    rows = [(Decimal("0"),), (Decimal("-34.5"),), (None,)]
    assert values(spark, "x decimal(12,6)", rows, quantities.coordinate_text(F.col("x"))) == [
        ("",), ("-34.500000",), (None,),
    ]


def test_days(spark):
    may31 = dt.date(2023, 5, 31)
    assert one(spark, dates.day("31/5/2023")) == may31
    assert one(spark, dates.day("2023-05-31")) == may31
    assert one(spark, dates.day(may31)) == may31
    assert one(spark, dates.business_date(may31)) == dt.date(2023, 5, 30)
    assert one(spark, dates.business_date("1/6/2023", -2)) == dt.date(2023, 5, 30)
    assert one(spark, dates.business_date(offset=0) == F.current_date())
    assert one(spark, dates.iso_text(dates.day(may31))) == "2023-05-31"
    assert one(spark, dates.compact_text(dates.day(may31))) == "20230531"
    assert one(spark, dates.age_in_days(may31, dates.day("29/5/2023"))) == 2


def test_date_ranges(spark):
    days = [(dt.date(2023, 5, d),) for d in (1, 2, 3, 4)]

    def kept(start, end):
        df = spark.createDataFrame(days, "d date").filter(dates.within(F.col("d"), start, end))
        return sorted(r["d"].day for r in df.collect())

    assert kept("2/5/2023", "3/5/2023") == [2, 3]
    assert kept("2023-05-02", "2023-05-02") == [2]
    assert kept(dt.date(2023, 5, 3), None) == [3, 4]
    assert kept(dates.business_date("2023-05-02"), dates.business_date("2023-05-02")) == [1]


def test_control_totals(spark):
    df = spark.createDataFrame(
        [("1", Decimal("0.125")), ("x", None), (" 2.5", Decimal("1.0")), (None, Decimal("0"))], "id string, q decimal(18,3)"
    )
    assert [tuple(r) for r in control_totals(df, "q", "q").collect()] == [
        ("CantRegistros", Decimal(3)), ("TotalUnidades", Decimal("1.12")),
    ]
    assert [tuple(r) for r in control_totals(df, "id").collect()] == [("CantRegistros", Decimal(2))]
    assert [tuple(r) for r in control_totals(df.limit(0), "q", "q").collect()] == [
        ("CantRegistros", Decimal(0)), ("TotalUnidades", Decimal(0)),
    ]
    with pytest.raises(TypeError):
        control_totals(df.withColumn("d", F.current_date()), "d")


def test_broadcast_only_within_the_measured_size(spark):
    small = spark.createDataFrame([("x" * 100,)], "s string")
    large = spark.createDataFrame([("x" * 100,)] * 50, "s string")
    sizes = measured_bytes(small, large, small.limit(0))
    assert 100 < sizes[0] < 200 and sizes[1] == 50 * sizes[0] and sizes[2] == 0

    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().logical().toString()

    dimensions = broadcast_small(small, large, limit=1000)
    assert [d.small for d in dimensions] == [True, False]
    assert [hinted(d.rows) for d in dimensions] == [True, False]
    facts = spark.createDataFrame([("x" * 100,), ("y",), (None,)], "s string")
    assert [d.thin(facts, "s").count() for d in dimensions] == [1, 3]
    assert [d.join_to(facts, "s").count() for d in dimensions] == [1, 50]
    assert [d.join_to(facts, "s", "left").count() for d in dimensions] == [3, 52]


def test_text_counts_only_where_it_is_a_number(spark):
    texts = ["12", " 12 ", "-1.5", ".5", "5.", "1e3", "12D", "7f", "NaN", "Infinity", "", " ", "1 2", "0x1F", None, "+7"]
    df = spark.createDataFrame([(t,) for t in texts], "id string")
    assert df.agg(numeric_count(df, "id")).first()[0] == 7


def test_floats_have_six_significant_digits(spark):
    cases = {
        -34.60372249: "-34.6037",
        -58.381592: "-58.3816",
        100.0: "100",
        0.0001: "0.0001",
        0.000012345678: "1.23457e-005",
        999999.0: "999999",
        999999.6: "1e+006",
        1234567.0: "1.23457e+006",
        0.1 + 0.2: "0.3",
        -0.5: "-0.5",
        0.0: "",
    }
    df = spark.createDataFrame([(float(x),) for x in cases], "x double")
    got = df.select(coordinate_text(F.col("x"), floating=True)).collect()
    assert [r[0] for r in got] == list(cases.values())
    nulls = spark.createDataFrame([(None,)], "x double").select(coordinate_text(F.col("x"), floating=True))
    assert nulls.first()[0] is None
    decimals = spark.sql("select cast(-34.603722 as decimal(12,6)) as x").select(coordinate_text(F.col("x")))
    assert decimals.first()[0] == "-34.603722"
