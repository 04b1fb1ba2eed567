"""Rendezvous hashing: each key goes to the shard with the highest weighted draw.

The draw of a key and a shard depends on nothing else, so another shard takes
keys only into itself, and a shard that goes gives up only its own. Expressions
alone; nothing here runs Python on an executor.

Defined cases: a null key is a key of its own; equal keys share a shard; an
empty table gives no rows; further columns are kept by ``assign_shards`` (a
column named as the new one gives way, as in ``withColumn``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DRAW_DIGITS = 13  # hexadecimal digits of a digest, 52 bits
SLOT_BLOCK = 10_000


def _digits(text: Column, count: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, count), 16, 10).cast("bigint")


def key_text(key: Column) -> Column:
    return F.coalesce(key.cast("string"), F.lit("null"))


def rendezvous(key: Column, weights: list[float], seed: int = 0) -> Column:
    """The shard, from 0, that wins the key: the least of -ln(u) / weight over the shards, u drawn by key and shard."""
    if not weights or min(weights) <= 0:
        raise ValueError("shards need positive weights")

    def cost(shard: int, weight: float) -> Column:
        text = F.concat(F.lit(f"{seed}|{shard}|"), key_text(key))
        u = (_digits(text, DRAW_DIGITS) + F.lit(0.5)) / F.lit(float(16**DRAW_DIGITS))
        return F.struct((-F.log(u) / F.lit(float(weight))).alias("cost"), F.lit(shard).alias("shard"))

    return F.array_min(F.array(*[cost(i, w) for i, w in enumerate(weights)]))["shard"]


def assign_shards(df: DataFrame, key: str, weights: list[float], seed: int = 0, into: str = "shard") -> DataFrame:
    return df.withColumn(into, rendezvous(F.col(key), weights, seed))


def number_slots(df: DataFrame, shard: str, columns: list[str]) -> DataFrame:
    """Rows of ``shard`` and ``columns``, with ``slot`` counting from 0 without a gap in each shard.

    No task holds a whole shard: a shard's rows are dealt into 4,096 buckets by
    a digest of their values; a bucket begins where the rows of those before it
    end. Equal rows are counted first, not moved, and written out again last.
    """
    values = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns]
    rows = (
        df.groupBy(shard, *columns)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bucket", _digits(F.concat_ws("|", F.lit("slot"), *values), 3))
    )
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(shard, "bucket")
        .agg(F.sum("n").alias("n"))
        .select(shard, "bucket", F.sum("n").over(before.partitionBy(shard).orderBy("bucket")).alias("start"))
    )
    within = F.sum("n").over(before.partitionBy(shard, "bucket").orderBy(*columns))
    first = F.coalesce(F.col("start"), F.lit(0)) + F.coalesce(F.col("within"), F.lit(0))
    placed = rows.withColumn("within", within).join(starts, [shard, "bucket"])
    blocks = placed.select(
        shard, *columns, "n", first.alias("first"), F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(SLOT_BLOCK))).alias("block")
    )
    last = F.least(F.col("block") + F.lit(SLOT_BLOCK), F.col("n")) - 1
    return blocks.select(
        shard, *columns, "first", F.explode(F.sequence(F.col("block"), last)).alias("copy")
    ).select(shard, *columns, (F.col("first") + F.col("copy")).cast("bigint").alias("slot"))


SHARDS = 8


def document_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Shard and slot of every document under equal weights, and its shard were there one more.

    A null text has no bytes and the checksum 0.
    """
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("bigint").alias("text_crc32"),
    )
    placed = number_slots(assign_shards(rows, "doc_id", [1.0] * shards), "shard", ["doc_id", "size", "text_crc32"])
    return assign_shards(placed, "doc_id", [1.0] * (shards + 1), into="grown_shard").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def _cost_sql(shards: int) -> str:
    draw = "(('0x' || md5('0|{0}|' || key)[1:13])::bigint + 0.5) / 4503599627370496.0"
    return ", ".join(f"{{'cost': -ln({draw.format(i)}), 'shard': {i}}}" for i in range(shards))


SQL = f"""
with byte_table as (
    select list(v order by i) as t from (
        select i, list_reduce(list_prepend(i, range(8)),
            lambda c, k: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v
        from range(256) r(i))
), sized as (
    select doc_id, coalesce(text, '') as text, hex(encode(coalesce(text, ''))) as digits,
        coalesce(doc_id::varchar, 'null') as key
    from documents
), summed as (
    select doc_id, key, (length(digits) // 2 + 1)::bigint as size,
        xor(list_reduce(list_prepend(4294967295::bigint,
            list_transform(regexp_extract_all(digits, '..'), lambda d: ('0x' || d)::bigint)),
            lambda c, b: xor(c >> 8, t[xor(c % 256, b) + 1])), 4294967295)::bigint as text_crc32
    from sized, byte_table
), dealt as (
    select *,
        list_min([{_cost_sql(SHARDS)}]).shard::int as shard,
        list_min([{_cost_sql(SHARDS + 1)}]).shard::int as grown_shard,
        md5('slot|' || key || '|' || size || '|' || text_crc32)[1:3] as bucket
    from summed
)
select doc_id, size, text_crc32, 'key' as law, shard,
    row_number() over (partition by shard order by bucket, doc_id nulls first, size, text_crc32) - 1 as slot,
    grown_shard
from dealt
"""
