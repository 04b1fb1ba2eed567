"""Columns computed from a text column, batch by batch of bounded size."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from despacho.session import shared_folder

CHUNK_BYTES = 1 << 20  # text per call; a longer text makes a chunk of its own


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if len(sizes) > start:
            yield batch.slice(start)


def text_bytes(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    array = batch.column(column)
    binary = pa.large_binary() if pa.types.is_large_string(array.type) else pa.binary()
    return array.cast(binary).to_pylist()


def without(df: DataFrame, names) -> list[str]:
    """Columns of ``df`` but those named, whatever their case."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or the first of ``name_``, ``name__``, ... that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_columns(
    df: DataFrame, text: str, added: str, compute: Callable[[list[bytes | None]], list], limit: int = CHUNK_BYTES
) -> DataFrame:
    """All rows with the columns that ``compute`` makes of their texts.

    ``added`` is the DDL of the new columns; a column of ``df`` that has one of
    their names (in any case) gives way to it, as in ``withColumn``.
    """
    new = StructType.fromDDL(added)
    source = df.withColumn(hidden := fresh(df, "_text"), F.col(text))
    carried = without(df, new.names)
    schema = StructType([df.schema[c] for c in carried] + new.fields)

    def run(batches):
        for batch in chunks(batches, hidden, limit):
            columns = [batch.column(c) for c in carried]
            yield pa.RecordBatch.from_arrays(columns + list(compute(text_bytes(batch, hidden))), schema.names)

    if any(c.lower() == text.lower() for c in carried):
        # The text travels once: under its own name.
        hidden, source = next(c for c in carried if c.lower() == text.lower()), df
    return source.select(*[f"`{c}`" for c in carried], *([] if hidden in carried else [hidden])).mapInArrow(run, schema)


FILES_PER_CORE = 4


def written(df: DataFrame, name: str, shuffled: bool = True) -> DataFrame:
    """``df`` as a table in the folder all executors share: computed once, and safe when executors are lost.

    Where its last stage reads a shuffle, a task of it takes several of the
    shuffle's partitions, one after the other, so that a table of few rows isn't
    a file for each of thousands of partitions.
    """
    spark: SparkSession = df.sparkSession
    path = f"{shared_folder(spark)}/despacho-llm/{name}-{uuid.uuid4().hex}"
    rows = df.coalesce(FILES_PER_CORE * spark.sparkContext.defaultParallelism) if shuffled else df
    rows.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
