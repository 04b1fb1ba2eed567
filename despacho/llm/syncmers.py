"""Document fingerprints of closed syncmers.

A k-mer of code points is an anchor if the least of its inner s-mers, by hash,
is its first or its last. Whether it is depends on the k-mer alone, so a passage
has the same anchors wherever it stands, save at its rims. A fingerprint is the
32-bit hashes of a text's anchors in the order of their places; two texts are as
alike as the anchors they share in the same order make up of all they have.

Defined cases: an empty or null text has no anchors and is like another empty
one; a text shorter than a k-mer, or without an anchor, is represented by its
whole or by its least k-mer; a null id comes first; documents that share an id
follow each other by a hash of their texts; a document alone is its own next.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from despacho.llm.arrow import chunks
from despacho.llm.words import mix

K = 16
S = 5
GROUPS_PER_PARTITION = 4
STEP32 = 0x9E3779B1


def _spread32(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    x = (x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return x ^ (x >> np.uint32(16))


def _rolled(points: np.ndarray, size: int) -> np.ndarray:
    """A 32-bit hash of every run of ``size`` code points."""
    n = len(points) - size + 1
    rolled = points[:n].copy()
    for j in range(1, size):
        rolled = rolled * np.uint32(STEP32) + points[j : n + j]
    return _spread32(rolled)


def _least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, by doubling."""
    n, span = len(values) - width + 1, 1
    while span * 2 <= width:
        values = np.minimum(values[: len(values) - span], values[span:])
        span *= 2
    return np.minimum(values[:n], values[width - span : width - span + n])


def _kmer_hash(points: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    rolled = np.zeros(len(at), np.uint64)
    for j in range(k):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + points[at + j]
    return (mix(rolled) >> np.uint64(32)).astype(np.uint32)


def anchors(texts: list[str], k: int = K, s: int = S) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places and hashes of the anchors of each text, by ascending place."""
    encoded = [t.encode("utf-32-le") for t in texts]
    points = np.frombuffer(b"".join(encoded), np.uint32)
    sizes = np.array([len(e) // 4 for e in encoded], np.int64)
    starts = np.cumsum(sizes) - sizes
    at = np.zeros(0, np.int64)
    if len(points) >= k:
        inner = _rolled(points, s)
        least = _least_of(inner, k - s + 1)
        n = len(least)
        at = np.flatnonzero((inner[:n] == least) | (inner[k - s : k - s + n] == least))
        owner = np.searchsorted(starts, at, side="right") - 1
        at = at[at + k <= starts[owner] + sizes[owner]]
    hashes = _kmer_hash(points, at, k)
    cuts = np.searchsorted(at, np.append(starts, len(points)))
    result = []
    for i in range(len(texts)):
        low, high = cuts[i], cuts[i + 1]
        if high > low or not sizes[i]:
            result.append((at[low:high] - starts[i], hashes[low:high]))
            continue
        width = int(min(k, sizes[i]))
        places = np.arange(sizes[i] - width + 1)
        every = _kmer_hash(points, starts[i] + places, width)
        least = int(np.argmin(every))
        result.append((places[least : least + 1], every[least : least + 1]))
    return result


def _longest_rise(values: np.ndarray) -> int:
    if len(values) < 2 or (np.diff(values) > 0).all():
        return len(values)
    tails: list[int] = []
    for v in values.tolist():
        i = bisect_left(tails, v)
        tails[i : i + 1] = [v]
    return len(tails)


def likeness(left: np.ndarray, right: np.ndarray) -> float:
    """Anchors (by hash, at their first place) that both have in one order, as a share of all; 1 for two without any."""
    if not len(left) or not len(right):
        return float(len(left) == len(right))
    if len(left) == len(right) and (left == right).all():
        return 1.0
    a, a_first = np.unique(left, return_index=True)
    b, b_first = np.unique(right, return_index=True)
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    shared = np.flatnonzero(b[at] == a)
    if not len(shared):
        return 0.0
    in_order = shared[np.argsort(a_first[shared])]
    chain = _longest_rise(b_first[at[in_order]])
    return chain / (len(a) + len(b) - chain)


def fingerprint(hashes: np.ndarray) -> str:
    return base64.b64encode(hashes.astype("<u4").tobytes()).decode()


def edited(text: str, following: str) -> str:
    """The text with its last quarter of code points replaced by as many, or all, from the start of the next one."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def _compare(rows: list[tuple], following: list[str]) -> pa.RecordBatch:
    texts = [r[1] for r in rows]
    changed = [edited(t, n) for t, n in zip(texts, following)]
    # The next text is mostly the next row's.
    own = [h for _, h in anchors(texts)]
    after = [own[i + 1] if i + 1 < len(texts) and following[i] is texts[i + 1] else None for i in range(len(texts))]
    odd = [i for i, a in enumerate(after) if a is None]
    for i, (_, hashes) in zip(odd, anchors([following[i] for i in odd])):
        after[i] = hashes
    other = [h for _, h in anchors(changed)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
            pa.array([fingerprint(h) for h in own]),
            pa.array([fingerprint(h) for h in other]),
            pa.array([likeness(a, b) for a, b in zip(own, other)], pa.float64()),
            pa.array([likeness(a, b) for a, b in zip(own, after)], pa.float64()),
        ],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def _consecutive(batches):
    """Rows come by group and in order, a group's last being the first of the next group: it is compared with, not returned."""
    held: list[tuple] = []
    for batch in chunks(batches, "text"):
        columns = [batch.column(c).to_pylist() for c in ("doc_id", "text", "group", "guest")]
        held += [(i, t or "", g, x) for i, t, g, x in zip(*columns)]
        ready = [i for i in range(len(held) - 1) if not held[i][3] and held[i][2] == held[i + 1][2]]
        if ready:
            yield _compare([held[i] for i in ready], [held[i + 1][1] for i in ready])
        held = held[-1:]


def with_next(docs: DataFrame, run, schema: str) -> DataFrame:
    """Apply ``run`` to documents in ascending order of ids, each task having those of some ranges and the one after them.

    The ranges are quantiles of the ids, found by a pass over the ids alone. The
    first document of each range is also sent to the range before it, that of
    the first range to the last; so the texts are shuffled once.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(2, GROUPS_PER_PARTITION * partitions)
    shares = [i / groups for i in range(1, groups)]
    quantiles = rows.agg(F.percentile_approx("doc_id", shares, 100 * groups).alias("q")).head()["q"] or []
    edges = sorted({float(q) for q in quantiles})
    # Ids are dealt as doubles, which keeps their order; ranges are from an edge on.
    number = F.coalesce(F.col("doc_id").cast("double"), F.lit(-np.finfo(float).max))
    splits = [-float("inf"), *edges, float("inf")] if len(edges) else [-float("inf"), 0.0, float("inf")]
    dealt = Bucketizer(splits=splits, inputCol="number", outputCol="bucket").transform(rows.withColumn("number", number))
    dealt = dealt.withColumn("group", F.col("bucket").cast("int")).drop("number", "bucket")
    firsts = dealt.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("first")).collect()
    used = sorted((r["group"], r["first"]["doc_id"]) for r in firsts)
    before = [(g, i, used[k - 1][0]) for k, (g, i) in enumerate(used)]
    heads = spark.createDataFrame(before, "head_group int, head_id long, host int")
    is_head = (F.col("group") == F.col("head_group")) & F.col("doc_id").eqNullSafe(F.col("head_id"))
    own = F.struct(F.col("group").alias("group"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("host").alias("group"), F.lit(True).alias("guest"))
    places = F.when(F.col("host").isNotNull(), F.array(own, guest)).otherwise(F.array(own))
    placed = dealt.join(F.broadcast(heads), is_head, "left").select("doc_id", "text", F.explode(places).alias("place"))
    placed = placed.select("doc_id", "text", "place.group", "place.guest")
    order = ["group", "guest", "doc_id", F.xxhash64("text"), "text"]
    return placed.repartition(partitions, "group").sortWithinPartitions(*order).mapInArrow(run, schema)


def document_fingerprints(docs: DataFrame) -> DataFrame:
    return with_next(docs, _consecutive, RESULT)
