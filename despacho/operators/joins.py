"""Broadcast behind a measured size."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, DecimalType, StringType

BROADCAST_BYTES = 64 * 1024 * 1024  # of one dimension
BROADCAST_TOTAL = 2 * BROADCAST_BYTES  # of all dimensions of one query

_sizes: ContextVar[dict[int, int] | None] = ContextVar("sizes", default=None)


@contextmanager
def remembered_sizes() -> Iterator[None]:
    """Within it a dimension is measured once, however many queries use it; for one run over tables that stay as they are."""
    token = _sizes.set({} if _sizes.get() is None else _sizes.get())
    try:
        yield
    finally:
        _sizes.reset(token)


def _width(name: str, kind: DataType) -> Column:
    if isinstance(kind, (StringType, BinaryType)):
        return F.lit(16) + F.coalesce(F.octet_length(name), F.lit(0))
    return F.lit(24 if isinstance(kind, DecimalType) else 8)


def _row_bytes(df: DataFrame) -> Column:
    return reduce(add, (_width(f.name, f.dataType) for f in df.schema.fields), F.lit(16)).cast("bigint")


def measured_bytes(*frames: DataFrame) -> list[int]:
    """Bytes the rows of each frame would take as a broadcast table; one aggregation for all."""
    widths = [df.select(F.lit(i).alias("frame"), _row_bytes(df).alias("bytes")) for i, df in enumerate(frames)]
    totals = reduce(DataFrame.unionAll, widths).groupBy("frame").agg(F.sum("bytes").alias("bytes"))
    by_frame = {r["frame"]: r["bytes"] for r in totals.collect()}
    return [by_frame.get(i, 0) for i in range(len(frames))]


@dataclass(frozen=True)
class Dimension:
    """A measured dimension: its rows, hinted for broadcast if they are few enough."""

    rows: DataFrame
    small: bool

    def join_to(self, facts: DataFrame, key: str, how: str = "inner") -> DataFrame:
        return facts.join(self.rows, key, how)

    def thin(self, facts: DataFrame, key: str) -> DataFrame:
        """Only facts with a match, where that costs no shuffle.

        Unlike an inner join, the semi join is pushed beneath the joins that
        ``facts`` may itself be made of, so those shuffle fewer rows.
        """
        return facts.join(self.rows.select(key), key, "left_semi") if self.small else facts


def _sizes_of(frames: Sequence[DataFrame]) -> list[int]:
    known = _sizes.get()
    if known is None:
        return measured_bytes(*frames)
    keys = [df.semanticHash() for df in frames]
    unknown = {key: df for key, df in zip(keys, frames) if key not in known}
    if unknown:
        known |= dict(zip(unknown, measured_bytes(*unknown.values())))
    return [known[key] for key in keys]


def broadcast_small(*frames: DataFrame, limit: int | None = None, total: int | None = None) -> list[Dimension]:
    """Hint a broadcast on those frames that are measured to fit ``limit`` bytes, smallest first, up to ``total`` in all.

    A filtered dimension is often far smaller than its files, and all that the
    planner knows beforehand is the files (for JDBC not even that): without
    the hint the fact table would be shuffled on a dimension key, where a few
    values may hold most rows. Files tell no bound either, as a column of equal
    values takes next to nothing there. Measuring reads no column of fixed width
    that isn't filtered on. A frame beyond the limits stays as it is; its join is
    a shuffle join, before which ``session.tune`` lets a Bloom filter of its keys
    thin the facts, and whose hot partitions adaptive execution splits.
    """
    limit = BROADCAST_BYTES if limit is None else limit
    left = BROADCAST_TOTAL if total is None else total
    sizes = _sizes_of(frames)
    small = set()
    for i in sorted(range(len(frames)), key=lambda i: sizes[i]):
        if sizes[i] <= min(limit, left):
            small.add(i)
            left -= sizes[i]
    return [Dimension(F.broadcast(df) if i in small else df, i in small) for i, df in enumerate(frames)]
