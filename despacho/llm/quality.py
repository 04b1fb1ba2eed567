"""Quality classifier by importance resampling.

Two generative models of hashed n-grams, one of target text (documents labelled
good) and one of all raw text, give every document the weight p_target / p_raw.
Gumbel noise is added to its logarithm and the k largest sums are taken, which
samples without replacement in proportion to the weights.

N-grams are words, pairs of neighbouring words, and single, paired and triple
word shapes (repeats its neighbour, capitals, symbols, digits, length).

Defined cases: a null or empty text has no n-grams and weight 1; a null id draws
its own noise; documents that tie with the k-th are all taken; repeated rows
share a decision; without target documents every weight is 1; an empty table
gives no rows. Labels of an id that has several count as good if any is.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from despacho.llm.arrow import chunks, fresh, text_bytes, with_columns, written
from despacho.llm.words import Words, mix

BUCKETS = 1 << 16
SAMPLE = 20_000  # labelled rows, taken by a hash of their ids, that fit the target model and the threshold
CLAMP = float(1 << 40)
FINE, FINE_SCALE, SCALE = float(1 << 14), float(1 << 46), float(1 << 19)  # steps of ranks up to FINE and beyond


def _shapes(words: Words, same: np.ndarray) -> np.ndarray:
    """A small integer per word; ``same``: whether it equals the word before it."""
    byte = np.arange(256)
    upper = (byte >= 65) & (byte <= 90)
    digit = (byte >= 48) & (byte <= 57)
    symbol = (byte < 128) & ~upper & ~digit & ~((byte >= 97) & (byte <= 122))
    counts = []
    for kind in (upper, digit, symbol):
        total = np.concatenate([[0], np.cumsum(kind[words.buffer], dtype=np.int64)])
        counts.append(total[words.starts + words.lengths] - total[words.starts])
    capitals, digits, symbols = counts
    length = np.searchsorted([2, 4, 8, 16, 32], words.lengths, side="right")
    only = symbols == words.lengths
    code = same + 2 * np.minimum(capitals, 2) + 6 * np.minimum(digits, 1) + 12 * np.minimum(symbols, 3)
    return code + 48 * (length + 6 * only)


def ngrams(texts: list[bytes | None], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Index of the text and bucket of every n-gram."""
    words = Words(texts, lower=False)
    owner, hashes = words.text_of_word(), words.hashes()
    n = len(hashes)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pair = np.flatnonzero(owner[1:] == owner[:-1])
    same = np.zeros(n, np.int64)
    same[pair + 1] = hashes[pair] == hashes[pair + 1]
    shapes = _shapes(words, same).astype(np.uint64)
    triple = pair[np.isin(pair + 1, pair, assume_unique=True)] if len(pair) else pair
    step = np.uint64(0x9E3779B97F4A7C15)
    kinds = [
        (owner, hashes),
        (owner[pair], hashes[pair] * step + hashes[pair + 1]),
        (owner, shapes + (np.uint64(1) << np.uint64(40))),
        (owner[pair], (shapes[pair] << np.uint64(12)) + shapes[pair + 1] + (np.uint64(2) << np.uint64(40))),
        (
            owner[triple],
            (shapes[triple] << np.uint64(24))
            + (shapes[triple + 1] << np.uint64(12))
            + shapes[triple + 2]
            + (np.uint64(3) << np.uint64(40)),
        ),
    ]
    where = np.concatenate([k[0] for k in kinds])
    bucket = (mix(np.concatenate([k[1] for k in kinds])) % np.uint64(buckets)).astype(np.int64)
    return where, bucket


def labelled_sample(labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """At most ``limit`` labelled ids and whether they are good."""
    by_id = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("sample_id"))
    return by_id.agg((F.max("quality") > 0).alias("good")).orderBy(F.xxhash64("sample_id"), "sample_id").limit(limit)


def ngram_counts(docs: DataFrame, sample: DataFrame, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Counts per bucket over all documents, and over the good ones of the sample (bounded, so it is broadcast)."""
    flagged = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("sample_id"), "left")
    rows = flagged.select("text", F.coalesce("good", F.lit(False)).alias("good"))

    def count(batches):
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in chunks(batches, "text"):
            where, bucket = ngrams(text_bytes(batch, "text"), buckets)
            good = np.array(batch.column("good").to_pylist(), bool)
            raw += np.bincount(bucket, minlength=buckets)
            target += np.bincount(bucket[good[where]], minlength=buckets)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])], ["bucket", "raw", "target"])

    counted = rows.mapInArrow(count, "bucket long, raw long, target long")
    totals = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    raw, target = np.zeros(buckets), np.zeros(buckets)
    at = totals.column("bucket").to_numpy()
    raw[at], target[at] = totals.column("raw").to_numpy(), totals.column("target").to_numpy()
    return raw, target


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket log p_target - log p_raw, each model smoothed by one count a bucket."""
    if not target.sum():
        return np.zeros(len(raw))
    return np.log((target + 1) / (target.sum() + len(target))) - np.log((raw + 1) / (raw.sum() + len(raw)))


def with_log_weights(docs: DataFrame, ratios: np.ndarray, into: str) -> DataFrame:
    def weigh(texts):
        where, bucket = ngrams(texts, len(ratios))
        return [pa.array(np.bincount(where, ratios[bucket], minlength=len(texts)), pa.float64())]

    return with_columns(docs, "text", f"`{into}` double", weigh)


def threshold(weights: np.ndarray, good: np.ndarray) -> float:
    """The log weight that parts good from bad labelled rows best: highest mean of both hit rates, middle of the gap."""
    if not good.any():
        return -CLAMP
    if good.all():
        return float(weights.min())
    order = np.argsort(weights)
    w, g = weights[order], good[order]
    bad_below = np.concatenate([[0], np.cumsum(~g)]) / (~g).sum()
    good_above = 1 - np.concatenate([[0], np.cumsum(g)]) / g.sum()
    inner = np.flatnonzero(np.diff(w) > 0) + 1
    cuts = np.concatenate([[0], inner])
    best = cuts[np.argmax((bad_below + good_above)[cuts])]
    return float(w[0] if best == 0 else (w[best - 1] + w[best]) / 2)


def gumbel(key: Column, text: Column, seed: int) -> Column:
    """Standard Gumbel noise that depends on the seed and the key alone, or the text where there is no key."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), key, F.when(key.isNull(), text)), 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(-F.log(u))


def kth_largest(rows: DataFrame, rank: str, k: int) -> int | None:
    """The k-th largest value of a bigint column from 0 on, found sixteen bits at a time from counts of at most 65,536 bins."""
    if k <= 0:
        return None
    prefix = 0
    for shift in (48, 32, 16, 0):
        bins = rows.filter(F.shiftright(F.col(rank), min(shift + 16, 63)) == prefix) if shift < 48 else rows
        counts = bins.groupBy(F.shiftright(F.col(rank), shift).bitwiseAND(F.lit(0xFFFF)).alias("bin")).count().collect()
        chosen = None
        for row in sorted(counts, key=lambda r: -r["bin"]):
            chosen = row["bin"]
            if row["count"] >= k:
                break
            k -= row["count"]
        if chosen is None:
            return None
        prefix = (prefix << 16) | chosen
    return prefix


def rank_of(log_weight: Column, key: Column, text: Column, seed: int) -> Column:
    """The noisy log weight as a whole number from 0 on, in the same order.

    Up to FINE it has steps of 2^-46, about those of the double itself; beyond,
    where only very long texts are, of 2^-19. Nothing is added to the double, which
    would cost it digits.
    """
    noisy = log_weight + gumbel(key, text, seed)
    size = F.least(F.abs(noisy), F.lit(CLAMP))
    fine = F.round(F.least(size, F.lit(FINE)) * F.lit(FINE_SCALE)).cast("bigint")
    coarse = F.round(F.greatest(size - F.lit(FINE), F.lit(0.0)) * F.lit(SCALE)).cast("bigint")
    return F.lit(1 << 61) + F.when(noisy < 0, -(fine + coarse)).otherwise(fine + coarse)


@dataclass(frozen=True)
class Resampler:
    """Log ratios per bucket, the noise's seed, and the least rank that is taken (None: nothing is)."""

    ratios: np.ndarray
    seed: int
    least: int | None

    def selected(self, rank: Column) -> Column:
        return F.lit(False) if self.least is None else rank >= self.least


def fit(
    docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = 1, sample: int = SAMPLE, buckets: int = BUCKETS
) -> tuple[Resampler, DataFrame]:
    """The resampler that takes ``k`` documents, and (doc_id, log_weight, rank) of all of them.

    Without ``k`` as many are taken as have a weight above the threshold that
    parts the sample's good rows from its bad ones.
    """
    chosen = written(labelled_sample(labels, sample), "quality-sample")
    ratios = log_ratios(*ngram_counts(docs, chosen, buckets))
    scored = with_log_weights(docs.select("doc_id", "text"), ratios, "log_weight")
    scored = scored.withColumn("rank", rank_of(F.col("log_weight"), F.col("doc_id"), F.col("text"), seed)).drop("text")
    scored = written(scored, "quality-weights", shuffled=False)
    if k is None:
        known = scored.join(F.broadcast(chosen), F.col("doc_id") == F.col("sample_id"))
        # One row an id, so that repeated rows don't make the fit grow.
        known = known.groupBy("sample_id").agg(F.max("log_weight").alias("w"), F.max("good").alias("good")).toArrow()
        good = np.array(known.column("good").to_pylist(), bool)
        cut = threshold(known.column("w").to_numpy(), good)
        k = scored.filter(F.col("log_weight") >= cut).count()
    return Resampler(ratios, seed, kth_largest(scored, "rank", k)), scored


def document_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    resampler, scored = fit(docs, labels)
    return scored.select("doc_id", "log_weight", "rank", resampler.selected(F.col("rank")).alias("selected"))


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, all columns, that the resampler takes."""
    resampler, _ = fit(docs, labels)
    weight = fresh(docs, "log_weight")
    rank = rank_of(F.col(weight), F.col("doc_id"), F.col("text"), resampler.seed)
    return with_log_weights(docs, resampler.ratios, weight).filter(resampler.selected(rank)).select(*docs.columns)
