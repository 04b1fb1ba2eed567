"""Base tables whose texts compare as in a source database that ignores case and trailing blanks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from despacho.plans.dimensions import Tables

SOURCE = "UTF8_LCASE_RTRIM"
PLAIN = "UTF8_BINARY"


def _texts(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def collated(t: Tables, collation: str = SOURCE) -> Tables:
    """The tables with every text under a collation, which joins, groups and conditions of the extracts then follow.

    Conditions on dates and numbers reach the scan as before; those on texts are
    applied to the rows read, as files hold statistics of plain texts only.
    """
    return {name: df.withColumns({c: F.collate(c, collation) for c in _texts(df)}) for name, df in t.items()}


def plain(df: DataFrame) -> DataFrame:
    """The rows with plain texts, to be written or compared byte by byte.

    Of texts that the collation takes for one, which differ in case or blanks, a
    group shows any.
    """
    return df.withColumns({c: F.collate(c, PLAIN) for c in _texts(df)})
