"""Control totals that travel with every dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from despacho.functions.quantities import TOTAL

# Names in the verification table.
INDICATOR, VALUE = "INDICADOR", "VALOR"
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
COUNT_NAME, TOTAL_NAME = "CantRegistros", "TotalUnidades"


def numeric_count(df: DataFrame, column: str, where: Column | None = None) -> Column:
    """How many values (of the rows ``where``) are numbers; text counts where it reads as one."""
    kind = df.schema[column].dataType
    if isinstance(kind, NumericType):
        is_number = F.col(column).isNotNull()
    elif isinstance(kind, StringType):
        is_number = F.col(column).rlike(NUMBER)
    else:
        raise TypeError(f"{column} is {kind.simpleString()}, neither a number nor text")
    return F.count(F.when(is_number if where is None else where & is_number, 1))


def rounded_total(column: str, where: Column | None = None) -> Column:
    """Sum (of the rows ``where``) to two decimals, halves to even; 0 over nothing."""
    value = F.col(column) if where is None else F.when(where, F.col(column))
    return F.coalesce(F.bround(F.sum(value), 2), F.lit(0)).cast(TOTAL)


def totals(df: DataFrame, counted: str, summed: str | None = None, where: Column | None = None) -> dict[str, Column]:
    """The control totals by name, as aggregates."""
    found = {COUNT_NAME: numeric_count(df, counted, where).cast(TOTAL)}
    if summed is not None:
        found[TOTAL_NAME] = rounded_total(summed, where)
    return found


def control_totals(df: DataFrame, counted: str, summed: str | None = None) -> DataFrame:
    """The verification table of a dataset, from one pass over it."""
    values = totals(df, counted, summed)
    wide = df.agg(*(value.alias(name) for name, value in values.items()))
    return wide.unpivot([], list(values), INDICATOR, VALUE)
