"""Near duplicates by MinHash: banded candidates, sequential Bayesian pruning, exact verification.

Documents with equal shingle sets form a class, of which the least id stands for
all. Classes that agree in a band of their signatures share a bucket. First each
is compared with one star of the bucket only, its most widely shared member.
Buckets whose members are not all connected by then have members of different
components compared as well, so that no candidate link is lost: those of small
buckets as pairs, those of large ones block against block inside tasks, from
which one link for each member and component comes back. So a group of copies
never yields its pairs as rows.

A comparison reads the signatures in batches and stops once the posterior
probability of a similarity of 0.75 or more falls below the miss probability;
what survives is decided on the full shingle sets.

Defined cases: a document without words has no shingles and is linked with
nothing, as is one without an id (its component is null and it is kept); rows
that repeat an id and a text share their class; an empty table gives no rows.
In ``duplicate_groups`` ids are meant to be unique: where rows of one id differ in
text, each text has its own class, and classes that the same id stands for count as
one. ``deduplicated`` numbers the rows of such a table first: each text stays that
has no near duplicate, and one of those that have, with an id or without.
"""

from __future__ import annotations

import hashlib
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from despacho.llm.arrow import chunks, fresh, text_bytes, with_columns, written
from despacho.llm.components import components
from despacho.llm.words import Words, gathered, mix
from despacho.operators.joins import broadcast_small

SHINGLE = 5
PERCENT = 75  # of the union, that the intersection of linked documents reaches
BANDS, ROWS = 32, 4  # a pair at 0.75 misses all bands with probability 5e-6
BATCH = 16
SMALL = 16  # members up to which a bucket's open pairs become rows, at most 8 a member
BLOCK, BLOCK_MEMBERS = 1 << 19, 1 << 11  # shingles, and members, in a block of a larger bucket
MISS = 1e-9


def shingles(texts: list[bytes | None]) -> list[np.ndarray]:
    """The distinct 5-word shingles of each text as ascending 64-bit hashes; of fewer words, their sequence as one."""
    words = Words(texts)
    hashes, bounds = words.hashes(), words.bounds
    n = len(hashes) - SHINGLE + 1
    step = np.uint64(0x9E3779B97F4A7C15)
    if n > 0:
        rolled = np.full(n, np.uint64(SHINGLE))
        for i in range(SHINGLE):
            rolled = rolled * step + hashes[i : i + n]
        rolled = mix(rolled)
    result = []
    for start, end in zip(bounds[:-1], bounds[1:]):
        if end - start >= SHINGLE:
            result.append(np.unique(rolled[start : end - SHINGLE + 1]))
        elif end > start:
            one = np.uint64(end - start)
            with np.errstate(over="ignore"):
                for h in hashes[start:end]:
                    one = one * step + h
            result.append(mix(np.array([one], np.uint64)))
        else:
            result.append(np.zeros(0, np.uint64))
    return result


def signatures(sets: list[np.ndarray], size: int = BANDS * ROWS) -> np.ndarray:
    """MinHash of each non-empty set: the least of ``size`` multiplicative hashes of its members' low halves."""
    rng = np.random.Generator(np.random.PCG64(20240607))
    factors = rng.integers(0, 1 << 32, size, dtype=np.uint32) | np.uint32(1)
    offsets = rng.integers(0, 1 << 32, size, dtype=np.uint32)
    result = np.zeros((len(sets), size), np.uint32)
    filled = [i for i, s in enumerate(sets) if len(s)]
    if filled:
        flat = np.concatenate([sets[i] for i in filled])
        low = (flat ^ (flat >> np.uint64(32))).astype(np.uint32)
        starts = np.cumsum([0] + [len(sets[i]) for i in filled])[:-1]
        for k in range(size):
            result[filled, k] = np.minimum.reduceat(low * factors[k] + offsets[k], starts)
    return result


def _prints(texts: list[bytes | None]) -> list:
    sets = shingles(texts)
    signed = signatures(sets)
    keys = np.zeros((len(texts), BANDS), np.uint64)
    for r in range(ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + signed[:, r::ROWS] + np.arange(BANDS, dtype=np.uint64))
    flat = pa.array(keys.view(np.int64).ravel())
    bands = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, BANDS), pa.int32()), flat)
    digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
    short = mix(signed.astype(np.uint64)).astype(np.uint16)
    return [
        pa.array([len(s) for s in sets], pa.int64()),
        pa.array(digests, pa.binary()),
        pa.array([row.tobytes() for row in short], pa.binary()),
        bands,
    ]


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, the set's digest, the signature (16 bits of each minimum) and a key per band."""
    added = "n_shingles long, digest binary, signature binary, bands array<long>"
    return with_columns(docs.select(F.col("doc_id").cast("long"), "text"), "text", added, _prints).drop("text")


def least_matches(checked: int, percent: int = PERCENT, miss: float = MISS) -> int:
    """The fewest matches among ``checked`` hashes that leave a posterior probability of ``miss`` or more.

    Under a uniform prior the similarity given m matches of n follows
    Beta(m + 1, n - m + 1); its tail above t is P(Bin(n + 1, t) <= m).
    """
    t, tail = percent / 100, 0.0
    for m in range(checked + 1):
        tail += comb(checked + 1, m) * t**m * (1 - t) ** (checked + 1 - m)
        if tail >= miss:
            return m
    return checked


def plausible(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs of signatures pass every batch; a pair is not read beyond the batch that rules it out."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    for end in range(BATCH, left.shape[1] + 1, BATCH):
        part = slice(end - BATCH, end)
        matches[alive] += (left[alive, part] == right[alive, part]).sum(1)
        alive = alive[matches[alive] >= least_matches(end)]
    kept = np.zeros(len(left), bool)
    kept[alive] = True
    return kept


def _survivors(batches):
    def signed(batch, column):
        return np.frombuffer(b"".join(batch.column(column).to_pylist()), "<u2").reshape(batch.num_rows, -1)

    for batch in batches:
        for start in range(0, batch.num_rows, 4096):
            part = batch.slice(start, 4096)
            kept = plausible(signed(part, "left_signature"), signed(part, "right_signature"))
            yield part.filter(pa.array(kept)).select(["a", "b"])


def full_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The shingle set of each of the ``ids`` (id), written to the shared folder."""
    [ids] = broadcast_small(ids)
    texts = ids.join_to(docs.select(F.col("doc_id").cast("long").alias("id"), "text"), "id")

    def gather(batches):
        for batch in chunks(batches, "text"):
            sets = shingles(text_bytes(batch, "text"))
            bounds = pa.array(np.cumsum([0] + [len(s) for s in sets]), pa.int32())
            flat = pa.array(np.concatenate(sets).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(bounds, flat)], ["id", "members"])

    return written(texts.dropDuplicates(["id"]).select("id", "text").mapInArrow(gather, "id long, members array<long>"), "sets")


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Those pairs (a, b) of class representatives whose full sets are similar enough."""
    signed = classes.select("rep", "signature")
    paired = pairs.join(signed.toDF("a", "left_signature"), "a").join(signed.toDF("b", "right_signature"), "b")
    survivors = paired.select("a", "b", "left_signature", "right_signature").mapInArrow(_survivors, "a long, b long")
    survivors = written(survivors.distinct(), "survivors")
    sets = full_sets(docs, survivors.select(F.col("a").alias("id")).unionAll(survivors.select("b")).distinct())
    both = survivors.join(sets.toDF("a", "left_set"), "a").join(sets.toDF("b", "right_set"), "b")
    shared = F.size(F.array_intersect("left_set", "right_set"))
    union = F.size("left_set") + F.size("right_set") - F.col("shared")
    return both.withColumn("shared", shared).filter(F.col("shared") * 100 >= union * PERCENT).select("a", "b")


class Block:
    """Members of one bucket that are compared with others of it."""

    def __init__(self):
        self.reps, self.components, self.signatures, self.sets = [], [], [], []

    def add(self, rep, component, signature, members) -> None:
        self.reps.append(rep)
        self.components.append(component)
        self.signatures.append(np.frombuffer(signature, "<u2"))
        self.sets.append(members)


def block_links(strays: Block, others: Block) -> list[tuple[int, int]]:
    """For each stray and each other component that holds a member linked to it, one such link."""
    if not strays.reps or not others.reps:
        return []
    components = np.array(others.components)
    signatures_ = np.stack(others.signatures)
    sizes = np.array([len(x) for x in others.sets])
    flat, starts = np.concatenate(others.sets), np.cumsum(sizes) - sizes
    links = []
    for rep, component, signature, members in zip(strays.reps, strays.components, strays.signatures, strays.sets):
        n = len(members)
        open_ = (components != component) & (np.minimum(sizes, n) * 100 >= np.maximum(sizes, n) * PERCENT)
        at = np.flatnonzero(open_)
        if not len(at):
            continue
        at = at[plausible(np.broadcast_to(signature, (len(at), len(signature))), signatures_[at])]
        if not len(at):
            continue
        place = np.minimum(np.searchsorted(members, found := gathered(flat, starts[at], sizes[at])), n - 1)
        shared = np.add.reduceat((members[place] == found).astype(np.int64), np.cumsum(sizes[at]) - sizes[at])
        at = at[shared * 100 >= (sizes[at] + n - shared) * PERCENT]
        _, first = np.unique(components[at], return_index=True)
        links += [(rep, others.reps[i]) for i in at[first]]
    return links


def _compare_blocks(batches):
    """Rows come sorted by bucket and pair of blocks; ``stray`` tells the two sides of a pair of blocks apart."""
    place, strays, others = None, Block(), Block()

    def result(links):
        columns = [pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)]
        return pa.RecordBatch.from_arrays(columns, ["a", "b"])

    for batch in batches:
        flat = batch.column("members").flatten().to_numpy().view(np.uint64)
        ends = np.cumsum(batch.column("members").value_lengths().to_numpy())
        columns = [batch.column(c).to_pylist() for c in ("band", "i", "j", "stray", "rep", "component", "signature")]
        for k, (band, i, j, stray, rep, component, signature) in enumerate(zip(*columns)):
            if place != (band, i, j):
                if links := block_links(strays, others):
                    yield result(links)
                place, strays, others = (band, i, j), Block(), Block()
            members = np.sort(flat[ends[k - 1] if k else 0 : ends[k]])
            (strays if stray else others).add(rep, component, signature, members)
    if links := block_links(strays, others):
        yield result(links)


def links_in_large_buckets(members: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links between members (band, rep, component, home, blocks) of different components.

    Those outside of the bucket's home component are strays; every block of them
    meets every block of all members in a group of its own.
    """
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    kept = ["band", "rep", "component"]
    others = members.select(*kept, every.alias("i"), own.alias("j"), F.lit(False).alias("stray"))
    strays = members.filter("component <> home").select(*kept, own.alias("i"), every.alias("j"), F.lit(True).alias("stray"))
    sets = full_sets(docs, members.select(F.col("rep").alias("id")).distinct()).withColumnRenamed("id", "rep")
    rows = others.unionAll(strays).join(classes.select("rep", "signature"), "rep").join(sets, "rep")
    rows = rows.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "stray", "rep")
    return rows.mapInArrow(_compare_blocks, "a long, b long").distinct()


def duplicate_groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    prints = written(fingerprints(docs), "prints", shuffled=False)
    usable = prints.filter("doc_id is not null and n_shingles > 0")
    least = F.min(F.struct("doc_id", "n_shingles", "signature", "bands")).alias("least")
    classes = written(
        usable.groupBy("digest").agg(least).select("digest", F.col("least.doc_id").alias("rep"), "least.n_shingles", "least.signature", "least.bands"),
        "classes",
    )
    banded = classes.select("rep", F.col("n_shingles").alias("n"), F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    buckets = written(banded.join(shared, "band"), "buckets")
    spread = buckets.groupBy("rep").agg(F.sum("members").alias("spread"))
    star = F.max(F.struct("spread", (-F.col("rep")).alias("less"))).alias("star")
    stars = buckets.join(spread, "rep").groupBy("band").agg(star).select("band", (-F.col("star.less")).alias("star"))
    met = buckets.join(stars, "band").filter("rep <> star")
    to_star = met.select(F.least("rep", "star").alias("a"), F.greatest("rep", "star").alias("b")).distinct()
    links = written(verified(to_star, classes, docs), "links-to-stars")
    labels = written(components(links), "labels")
    # Members of different components that meet in a bucket are compared too.
    node = labels.withColumnRenamed("node", "rep")
    labelled = buckets.select("band", "rep", "n").join(node, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    counted = labelled.groupBy("band", "component").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles"))
    mixed = counted.groupBy("band").agg(
        F.max(F.struct("members", "component"))["component"].alias("home"),
        F.sum("members").alias("members"),
        F.greatest(F.ceil(F.sum("shingles") / BLOCK), F.ceil(F.sum("members") / BLOCK_MEMBERS)).cast("int").alias("blocks"),
        F.count(F.lit(1)).alias("parts"),
    )
    open_ = written(labelled.join(mixed.filter("parts > 1"), "band"), "open-buckets")
    small = open_.filter(F.col("members") <= SMALL).select("band", "rep", "component", "n")
    left, right = (small.select(*[F.col(c).alias(c if c == "band" else f"{side}_{c}") for c in small.columns]) for side in ("left", "right"))
    near = F.least("left_n", "right_n") * 100 >= F.greatest("left_n", "right_n") * PERCENT
    across = left.join(right, "band").filter((F.col("left_component") < F.col("right_component")) & near)
    rest = across.select(F.least("left_rep", "right_rep").alias("a"), F.greatest("left_rep", "right_rep").alias("b")).distinct()
    more = verified(rest, classes, docs).unionAll(links_in_large_buckets(open_.filter(F.col("members") > SMALL), classes, docs))
    more = written(more, "links-across")
    labels = components(labels.toDF("a", "b").unionAll(more))
    by_digest = classes.select("digest", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    by_digest = by_digest.select("digest", F.coalesce("component", "rep").alias("component"))
    rows = prints.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("digest")).alias("digest"))
    component = F.coalesce("component", "doc_id").alias("component_id")
    return rows.join(by_digest, "digest", "left").select("doc_id", "n_shingles", component).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents, all columns, one of each group.

    Where ids repeat or are missing, rows are told apart by numbers of their own, in
    the order of ids, so that texts that share an id are compared and kept each.
    """
    repeated = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1 or doc_id is null")
    own = "doc_id"
    if not repeated.limit(1).isEmpty():
        own = fresh(docs, "row_id")
        order = [F.col("doc_id").asc_nulls_last(), F.md5("text")]
        docs = docs.repartitionByRange(*order).sortWithinPartitions(*order)
        docs = written(docs.withColumn(own, F.monotonically_increasing_id()), "numbered")
    groups = written(duplicate_groups(docs.select(F.col(own).alias("doc_id"), "text")), "groups")
    gone = fresh(docs, "removed")
    [removed] = broadcast_small(groups.filter("not kept").select(F.col("doc_id").alias(gone)))
    rows = docs.join(removed.rows, F.col(own) == F.col(gone), "left_anti")
    return rows if own == "doc_id" else rows.drop(own)
