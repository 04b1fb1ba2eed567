"""Quantity arithmetic: exact decimals throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType

AMOUNT = DecimalType(18, 2)  # per-row quantity
TOTAL = DecimalType(28, 2)  # any summed quantity in an output


def fixed2(value: Column) -> Column:
    """Two decimals, halves away from zero."""
    return value.cast(AMOUNT)


def converted(quantity: Column, per_box: Column, per_purchase_box: Column) -> Column:
    """Boxes of ``per_box`` units expressed in purchase boxes."""
    return quantity * per_box / per_purchase_box


def try_converted(quantity: Column, per_box: Column, per_purchase_box: Column) -> Column:
    """As ``converted``, NULL instead of an error where the divisor is zero."""
    return F.try_divide(quantity * per_box, per_purchase_box)


def in_purchase_boxes(stock: Column, per_purchase_box: Column) -> Column:
    """One stock row in purchase boxes, rounded to two decimals before any sum."""
    return fixed2(fixed2(stock) / fixed2(per_purchase_box))


def floored_at_zero(raw_total: Column, value: Column) -> Column:
    """``value`` where the raw total is positive, else 0; also 0 for a NULL total."""
    return F.when(raw_total > 0, value).otherwise(F.lit(0)).cast(TOTAL)


def six_digits(value: Column) -> Column:
    """A float as text with six significant digits, as the source converts it: plain from 0.0001 to below 1000000."""
    parts = F.split(F.format_string("%.5e", value), "e")
    mantissa, exponent = F.get(parts, 0), F.get(parts, 1).cast("int")

    def trimmed(text: Column) -> Column:
        return F.regexp_replace(text, r"\.?0+$", "")

    plain = trimmed(F.concat_ws("e", mantissa, exponent.cast("string")).cast("decimal(20,10)").cast("string"))
    sign = F.when(exponent < 0, "-").otherwise("+")
    scientific = F.concat(trimmed(mantissa), F.lit("e"), sign, F.lpad(F.abs(exponent).cast("string"), 3, "0"))
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    return F.when(finite, F.when(exponent.between(-4, 5), plain).otherwise(scientific)).otherwise(value.cast("string"))


def coordinate_text(value: Column, floating: bool = False) -> Column:
    """A coordinate as text, '' for zero, NULL kept; decimals keep their digits."""
    return F.when(value == 0, "").otherwise(six_digits(value) if floating else value.cast("string"))


def is_floating(kind: DataType) -> bool:
    return isinstance(kind, (DoubleType, FloatType))
