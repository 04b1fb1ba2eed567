"""Single-value lookups on the configuration and numbering tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

MAIN_CONFIG = 1  # fixed value: key of the configuration row in use


def is_code(column: Column, code: str) -> Column:
    """Whether a text column holds the code, blanks behind it aside; the prefix reaches the scan."""
    return column.startswith(code) & (F.rtrim(column) == code)


@dataclass(frozen=True)
class Series:
    """Key of one row of the numbering table."""

    sucursal: int
    tiponum: str
    letra: str
    empresa_id: int

    def matches(self) -> Column:
        return (
            (F.col("sucursal") == self.sucursal)
            & is_code(F.col("tiponum"), self.tiponum)
            & is_code(F.col("letra"), self.letra)
            & (F.col("empresa_id") == self.empresa_id)
        )


# The series read for the package number, the series advanced after a run.
PACKAGE_SERIES = Series(1, "BD", "X", 1)
ADVANCED_SERIES = Series(1, "JJ", "X", 1)


def distributor_code(config: DataFrame, code: int = MAIN_CONFIG) -> Column:
    """Scalar subquery: NULL without a row, an error with more than one."""
    return config.filter(F.col("codigo") == code).select("codigo_distribuidor").scalar()


def package_number(numbering: DataFrame, offset: int, series: Series = PACKAGE_SERIES) -> Column:
    """Scalar subquery: the number of the series plus ``offset``."""
    return numbering.filter(series.matches()).select(F.col("numero") + F.lit(offset)).scalar()


def numbering_copies(numbering: DataFrame, series: Series = PACKAGE_SERIES) -> Column:
    """How many numbering rows of the series type the sales rows are paired with.

    The sales definition pairs every row with each of them before it sums.
    Summing k equal copies is k times the sum, so the count takes the place of
    the pairing; k = 0 leaves no sales at all.
    """
    return numbering.filter(is_code(F.col("tiponum"), series.tiponum)).agg(F.count("*").alias("copies")).scalar()


def config_row(config: DataFrame, code: int = MAIN_CONFIG) -> Row:
    """The one configuration row in use."""
    rows = config.filter(F.col("codigo") == code).limit(2).collect()
    if len(rows) != 1:
        raise LookupError(f"expected one configuration row with codigo = {code}, found {len(rows) or 'none'}")
    return rows[0]
