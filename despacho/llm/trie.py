"""Prefix trie of conversations that are rebuilt from others, without building their texts.

A rebuilt conversation is the first turns of another one (its base) and its own
turns behind as many of its own first. Each stored turn has a fingerprint of the
turns up to it, an element of a monoid: a length n and a value v modulo a prime,
composed as (n, v) + (m, w) = (n + m, v + w * b^n). Values of parts of a conversation
are made apart and composed, so a conversation of any length is shared among tasks.
The fingerprint of a rebuilt prefix is composed of its base's head and its own
suffix, which is the quotient of two of its own prefixes; no turn is copied.

Prefixes of equal length and fingerprint form a node. Its members refer to the
stored turn that comes last; where these differ, the turns they refer to are compared,
role and text. As that is done at each depth, a node's members agree in all turns.
Should a comparison fail, everything is fingerprinted anew with other constants.

All figures of subtrees are sums over members: a conversation owns the nodes of which
it is the smallest member, one stretch at the end of its path, so what lies below a
node is what its members own there. Depth costs no rounds, and nothing grows with the
square of a conversation's turns.

Defined cases: rows without a conversation id are left out; null roles and texts are
empty; null turn numbers come first; turns that share a number are ordered by the
beginning of role and text, then by a digest, and repeated rows are repeated turns;
the remainder of a negative id is negative or 0, as in SQL; an empty table gives no
rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from despacho.llm.arrow import written

PRIMES = (2147483647, 2147483629, 2147483587)  # the largest below 2^31: products fit into 64 bits
VALUES = ["v0", "v1", "v2"]
DIGIT_BITS = 4
DIGITS = 8  # of a position: 2^32 turns
OPENING = 96  # characters of role and text that order turns of one number
PIECE = 1 << 20  # characters of member ids hashed at once


@dataclass(frozen=True)
class Modulus:
    """Arithmetic on columns modulo a prime, with powers of one base."""

    prime: int
    base: int

    def times(self, a: Column, b: Column) -> Column:
        return a * b % F.lit(self.prime)

    def minus(self, a: Column, b: Column) -> Column:
        return (a - b + F.lit(self.prime)) % F.lit(self.prime)

    def power(self, exponent: Column, inverse: bool = False) -> Column:
        """The base (or its inverse) to the power of a column, digit by digit of the exponent."""
        base, factors = pow(self.base, -1 if inverse else 1, self.prime), []
        for digit in range(DIGITS):
            step = pow(base, 1 << (DIGIT_BITS * digit), self.prime)
            powers = F.array(*[F.lit(pow(step, d, self.prime)).cast("long") for d in range(1 << DIGIT_BITS)])
            at = F.shiftright(exponent.cast("long"), DIGIT_BITS * digit).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))
            factors.append(F.get(powers, at.cast("int")))
        return reduce(self.times, factors)


def moduli(salt: int) -> list[Modulus]:
    draws = (int(hashlib.md5(f"{salt}|{i}".encode()).hexdigest(), 16) for i in range(len(PRIMES)))
    return [Modulus(p, 2 + d % (p - 3)) for p, d in zip(PRIMES, draws)]


def stored_turns(turns: DataFrame) -> DataFrame:
    """Turns in order (part, place, conv_id, role, text, n_bytes): places ascend over all parts."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    rows = turns.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role, text)
    both = F.concat_ws("\n", "role", "text")
    rows = rows.withColumn("opening", F.left(both, F.lit(OPENING))).withColumn("digest", F.md5(both))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("opening"), F.col("digest")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = rows.select(
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("place"),
        "conv_id",
        "role",
        "text",
        F.octet_length("text").cast("long").alias("n_bytes"),
    )
    return written(placed, "turns")


def prefixes(stored: DataFrame, salt: int) -> DataFrame:
    """Per stored turn its position in its conversation (from 1) and the fingerprint and bytes of the turns up to it."""
    mods = moduli(salt)
    within = Window.partitionBy("part", "conv_id").orderBy("place")
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    symbols = [F.pmod(F.xxhash64(F.lit(f"{salt}|{v}"), "role", "text"), F.lit(m.prime)).alias(v) for v, m in zip(VALUES, mods)]
    rows = stored.select("part", "place", "conv_id", "n_bytes", *symbols).withColumn("at", F.row_number().over(within).cast("long"))
    local = rows.select(
        "part",
        "place",
        "conv_id",
        "n_bytes",
        "at",
        F.sum("n_bytes").over(so_far).alias("bytes"),
        *[F.sum(m.times(F.col(v), m.power(F.col("at")))).over(so_far).alias(v) for v, m in zip(VALUES, mods)],
    )
    local = written(local, "turn-parts")
    # A row for each part that holds turns of a conversation; sums ascend, so the largest is the last.
    totals = local.groupBy("part", "conv_id").agg(*[F.max(c).alias(c) for c in ("at", "bytes", *VALUES)])
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)

    def sum_before(value: Column) -> Column:
        return F.coalesce(F.sum(value).over(before), F.lit(0))

    carried = totals.select("*", sum_before(F.col("at")).alias("shift"), sum_before(F.col("bytes")).alias("bytes_before"))
    moved = [m.times(F.col(v) % F.lit(m.prime), m.power(F.col("shift"))) for v, m in zip(VALUES, mods)]
    carried = carried.select(
        "part", "conv_id", "shift", "bytes_before",
        *[(sum_before(value) % F.lit(m.prime)).alias(f"{v}_before") for v, m, value in zip(VALUES, mods, moved)],
        *[m.power(F.col("shift")).alias(f"{v}_scale") for v, m in zip(VALUES, mods)],
    )
    composed = [
        ((F.col(f"{v}_before") + m.times(F.col(v) % F.lit(m.prime), F.col(f"{v}_scale"))) % F.lit(m.prime)).alias(v)
        for v, m in zip(VALUES, mods)
    ]
    placed = local.join(carried, ["part", "conv_id"]).select(
        "conv_id",
        "place",
        "n_bytes",
        (F.col("shift") + F.col("at")).alias("position"),
        (F.col("bytes_before") + F.col("bytes")).alias("bytes"),
        *composed,
    )
    return written(placed, "prefixes")


def plans(prefix: DataFrame, base: Column, head: Column, longest_head: int) -> DataFrame:
    """Per conversation how it is rebuilt: heads of its base, and what its own turns' fingerprints are composed with."""
    head_turn = F.struct("position", "place", "n_bytes", "bytes", *VALUES)
    convs = prefix.groupBy("conv_id").agg(
        F.max("position").alias("n_turns"),
        F.max("bytes").alias("own_bytes"),
        # At most ``longest_head`` turns of a conversation.
        F.array_sort(F.collect_list(F.when(F.col("position") <= longest_head, head_turn))).alias("heads"),
    )
    bases = convs.select(F.col("conv_id").alias("base"), F.col("heads").alias("base_heads"))
    rows = convs.select("*", base.cast("long").alias("base"), head.cast("long").alias("head")).join(bases, "base", "left")
    taken = F.least(F.col("head"), F.coalesce(F.size("base_heads"), F.lit(0))).cast("int")
    skipped = F.least(F.col("head"), F.col("n_turns")).cast("int")
    rows = rows.withColumn("taken", taken).withColumn("last_head", F.get("base_heads", F.col("taken") - 1))
    rows = rows.withColumn("last_skipped", F.get("heads", skipped - 1))

    def or_zero(value: Column) -> Column:
        return F.coalesce(value, F.lit(0).cast("long"))

    head_bytes, skipped_bytes = or_zero(F.col("last_head.bytes")), or_zero(F.col("last_skipped.bytes"))
    shown = rows.select(
        "conv_id",
        "head",
        F.col("taken").cast("long").alias("taken"),
        (F.col("taken") + F.greatest(F.col("n_turns") - F.col("head"), F.lit(0))).cast("long").alias("length"),
        (head_bytes + F.col("own_bytes") - skipped_bytes).alias("total"),
        (head_bytes - skipped_bytes).alias("moved"),
        F.slice(F.coalesce("base_heads", F.array().cast(rows.schema["heads"].dataType)), F.lit(1), F.col("taken")).alias("heads"),
        *[or_zero(F.col(f"last_head.{v}")).alias(f"{v}_head") for v in VALUES],
        *[or_zero(F.col(f"last_skipped.{v}")).alias(f"{v}_skipped") for v in VALUES],
    )
    return written(shown, "rebuilt")


def prefix_members(prefix: DataFrame, rebuilt: DataFrame, salt: int) -> DataFrame:
    """A row for each rebuilt conversation and depth from 1: fingerprint, the stored turn that comes last, bytes from there on."""
    e = F.col("turn")
    heads = rebuilt.select("conv_id", "length", "total", F.explode("heads").alias("turn")).select(
        "conv_id",
        "length",
        e["position"].alias("depth"),
        e["place"].alias("place"),
        e["n_bytes"].alias("n_bytes"),
        (F.col("total") - e["bytes"] + e["n_bytes"]).alias("rest"),
        *[e[v].alias(v) for v in VALUES],
    )
    own = prefix.join(rebuilt.drop("heads"), "conv_id").filter("position > head")
    suffix = [
        (F.col(f"{v}_head") + m.times(m.minus(F.col(v), F.col(f"{v}_skipped")), m.power(F.col("head") - F.col("taken"), inverse=True)))
        % F.lit(m.prime)
        for v, m in zip(VALUES, moduli(salt))
    ]
    own = own.select(
        "conv_id",
        "length",
        (F.col("taken") + F.col("position") - F.col("head")).alias("depth"),
        "place",
        "n_bytes",
        (F.col("total") - F.col("moved") - F.col("bytes") + F.col("n_bytes")).alias("rest"),
        *[value.alias(v) for v, value in zip(VALUES, suffix)],
    )
    return written(heads.unionAll(own), "members")


@dataclass(frozen=True)
class Trie:
    """Stored turns, the members of each node from depth 1 (``top`` is its smallest), and how conversations are rebuilt."""

    stored: DataFrame
    members: DataFrame
    rebuilt: DataFrame


def differing_nodes(stored: DataFrame, members: DataFrame) -> DataFrame:
    """Nodes whose members' last turns, looked up where they are stored, aren't all equal."""
    several = members.filter("least_place <> most_place").select("top", "depth", "place").distinct()
    turns = several.join(stored.select("place", "role", "text"), "place")
    ends = turns.groupBy("top", "depth").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ("role", "text") for f in (F.min, F.max)])
    return ends.filter("min_role <> max_role or min_text <> max_text")


def prefix_trie(turns: DataFrame, base: Column, head: Column, longest_head: int) -> Trie:
    """The trie of the conversations (conv_id, turn, role, text) rebuilt by two expressions over ``conv_id``.

    A conversation begins with the first ``head`` (at most ``longest_head``) turns of
    conversation ``base``, if there is one, and goes on with its own behind its first ``head``.
    """
    stored, salt = stored_turns(turns), 0
    while True:
        prefix = prefixes(stored, salt)
        rebuilt = plans(prefix, base, head, longest_head)
        found = prefix_members(prefix, rebuilt, salt)
        node = ["depth", *VALUES]
        nodes = found.groupBy(*node).agg(
            F.min("conv_id").alias("top"),
            F.count(F.lit(1)).alias("n_convs"),
            F.max("length").alias("reach"),
            F.min("place").alias("least_place"),
            F.max("place").alias("most_place"),
        )
        members = written(found.join(nodes, node).drop(*VALUES), "trie")
        if differing_nodes(stored, members).isEmpty():
            return Trie(stored, members, rebuilt)
        salt += 1


def _digest_of_ids(ends: DataFrame) -> DataFrame:
    """SHA-256 of the comma-joined ids of each node's ends (top, depth, conv_id), ascending.

    Ids are sorted and joined in pieces wherever they lie; only pieces come
    together, and one after the other goes into the digest.
    """

    def pieces(batches):
        held, ids, first, size = None, [], None, 0
        for batch in batches:
            rows = []
            for top, depth, conv_id in zip(*(batch.column(c).to_pylist() for c in ("top", "depth", "conv_id"))):
                if ids and (held != (top, depth) or size > PIECE):
                    rows.append((*held, first, ",".join(ids)))
                    ids, size = [], 0
                if not ids:
                    held, first = (top, depth), conv_id
                ids.append(str(conv_id))
                size += len(ids[-1]) + 1
            yield _batch(rows, "top", "depth", "first", "ids")
        if ids:
            yield _batch([(*held, first, ",".join(ids))], "top", "depth", "first", "ids")

    def digests(batches):
        held, digest = None, None
        for batch in batches:
            rows = []
            for top, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("top", "depth", "ids"))):
                if held != (top, depth):
                    if held:
                        rows.append((*held, digest.hexdigest()))
                    held, digest = (top, depth), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield _batch(rows, "top", "depth", "ends_sha256")
        if held:
            yield _batch([(*held, digest.hexdigest())], "top", "depth", "ends_sha256")

    order = ["top", "depth", "conv_id"]
    joined = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    joined = joined.mapInArrow(pieces, "top long, depth long, first long, ids string")
    joined = joined.repartition("top", "depth").sortWithinPartitions("top", "depth", "first")
    return joined.mapInArrow(digests, "top long, depth long, ends_sha256 string")


def _batch(rows: list[tuple], *names: str) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    types = [pa.string() if n in ("ids", "ends_sha256") else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], list(names))


def trie_nodes(trie: Trie) -> DataFrame:
    """A row for each node, from the root without a turn: its smallest member, members, children, leaves below, savings and ends.

    ``place`` is the stored turn that comes last in the node.
    """
    c, top, depth = F.col("conv_id"), F.col("top"), F.col("depth")
    whole = F.struct(F.min("conv_id").alias("top"), F.count(F.lit(1)).alias("n_convs"), F.max("length").alias("reach"))
    whole = trie.rebuilt.agg(whole.alias("whole")).scalar()
    roots = trie.rebuilt.select("conv_id", "length", F.col("total").alias("rest"), whole.alias("whole")).select(
        "conv_id", "length", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("place"),
        F.lit(0).cast("long").alias("n_bytes"), "rest", "whole.*",
    )
    rows = trie.members.select(*roots.columns).unionAll(roots)
    owns = c == top
    owners = rows.groupBy("conv_id").agg(
        F.min(F.when(owns, depth)).alias("first_owned"),
        F.sum(F.when(owns, F.col("n_bytes")).otherwise(0)).alias("owned_bytes"),
        F.max(F.when(~owns, top)).alias("above"),
        F.max(F.when(owns & (depth == F.col("reach")), 1).otherwise(0)).cast("long").alias("leaf"),
    )
    owners = written(owners, "owners")
    # A node with one member is the only one at its depth of a path that no other conversation takes from there on.
    alone = rows.filter("n_convs = 1").select(
        "top", "depth", "place", "n_convs",
        (F.col("length") > depth).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
    )
    shared = rows.filter("n_convs > 1").join(owners.drop("above"), "conv_id")
    branches = F.when(owns, F.col("length") > depth).otherwise(F.col("first_owned") == depth + 1)
    once = F.when(owns, F.col("rest")).otherwise(F.col("owned_bytes"))
    shared = shared.groupBy("top", "depth").agg(
        F.min("place").alias("place"),
        F.max("n_convs").alias("n_convs"),
        F.sum(F.coalesce(branches, F.lit(False)).cast("long")).alias("n_children"),
        F.sum("leaf").alias("n_leaves"),
        F.sum(F.col("rest") - once).alias("saved_tokens"),
    )
    parents = owners.filter("above is not null").select(
        F.col("conv_id").alias("top"), F.col("first_owned").alias("depth"), "above"
    )
    ends = _digest_of_ids(rows.filter("length = depth"))
    nodes = alone.unionAll(shared).join(parents, ["top", "depth"], "left").join(ends, ["top", "depth"], "left")
    return nodes.select(
        top.alias("conv_id"),
        "depth",
        F.when(depth > 0, F.coalesce("above", top)).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        "place",
    )


def node_turns(trie: Trie, nodes: DataFrame) -> DataFrame:
    """The nodes with role and text of their last turn; both null for the root."""
    return nodes.join(trie.stored.select("place", "role", "text"), "place", "left")


GROUP, LONGEST_HEAD = 5, 8


def document_trie(turns: DataFrame) -> DataFrame:
    """The trie of conversations that begin as the first of their group of five ids does."""
    conv_id = F.col("conv_id")
    head = F.crc32(conv_id.cast("string")) % F.lit(LONGEST_HEAD + 1)
    return trie_nodes(prefix_trie(turns, conv_id - conv_id % GROUP, head, LONGEST_HEAD)).drop("place")


SQL = """
with byte_table as (
    select list(v order by i) as t from (
        select i, list_reduce(list_prepend(i, range(8)),
            lambda c, k: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v
        from range(256) r(i))
), turns as (
    select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
        row_number() over (partition by conv_id order by turn nulls first, role, text) as pos
    from conversations where conv_id is not null
), sizes as (
    select conv_id, count(*) as n, conv_id - conv_id % 5 as base from turns group by conv_id
), convs as (
    select conv_id, n, base,
        xor(list_reduce(list_prepend(4294967295::bigint,
            list_transform(regexp_extract_all(hex(encode(conv_id::varchar)), '..'), lambda d: ('0x' || d)::bigint)),
            lambda c, b: xor(c >> 8, t[xor(c % 256, b) + 1])), 4294967295)::bigint % 9 as head
    from sizes, byte_table
), rebuilt as (
    select c.conv_id, t.pos as depth, t.role, t.text from convs c join turns t on t.conv_id = c.base and t.pos <= c.head
    union all
    select c.conv_id, least(c.head, coalesce(b.n, 0)) + t.pos - c.head, t.role, t.text
    from convs c join turns t using (conv_id) left join sizes b on b.conv_id = c.base
    where t.pos > c.head
), keyed as (
    select conv_id, depth, octet_length(encode(text)) as bytes,
        list({'role': role, 'text': text}) over (partition by conv_id order by depth) as path
    from rebuilt
    union all
    select conv_id, 0, 0, [] from convs
), nodes as (
    select depth, path, min(conv_id) as top, count(*) as n, min(bytes) as bytes from keyed group by depth, path
), members as (
    select k.conv_id, k.depth, top from keyed k join nodes using (depth, path)
), lengths as (
    select conv_id, max(depth) as depth from members group by conv_id
), ends as (
    select top, depth, string_agg(conv_id::varchar, ',' order by conv_id) as ids
    from members join lengths using (conv_id, depth) group by top, depth
), parents as (
    select x.top, x.depth, m.top as parent from nodes x join members m on m.conv_id = x.top and m.depth = x.depth - 1
), children as (
    select parent as top, depth - 1 as depth, count(*) as n_children from parents group by all
), below as (
    select m.top, m.depth, sum((x.n - 1) * x.bytes)::bigint as saved_tokens,
        sum((c.n_children is null)::int)::bigint as n_leaves
    from nodes x join members m on m.conv_id = x.top and m.depth <= x.depth
    left join children c on c.top = x.top and c.depth = x.depth
    group by m.top, m.depth
)
select x.top as conv_id, x.depth::bigint as depth, p.parent as parent_conv_id, x.n as n_convs,
    coalesce(c.n_children, 0) as n_children, b.n_leaves, b.saved_tokens, sha256(coalesce(e.ids, '')) as ends_sha256
from nodes x
left join parents p using (top, depth)
left join children c using (top, depth)
left join below b using (top, depth)
left join ends e using (top, depth)
"""
