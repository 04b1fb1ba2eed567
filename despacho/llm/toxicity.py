"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic examples are the positives; unlabelled text, in which the class
prior's share is toxic too, is everything else. A linear model over hashed words
and word beginnings (4 to 8 bytes) is trained in numpy by ``linear.train_nnpu``.

Rows whose id falls into the held-out fold are never learnt from. Defined cases:
a null id is held out; a null or empty text scores by the bias alone; ids with
several labels are toxic if any label says so; repeated rows score alike; without
positives or without any labels every score is 0; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from despacho.llm.arrow import chunks, fresh, text_bytes, with_columns, written
from despacho.llm.linear import Rows, sigmoid, train_nnpu
from despacho.llm.words import Words

SPACE = 1 << 22  # hashed features
FEATURES = 4000  # of them in the model
POSITIVES, UNLABELLED = 4000, 12_000  # rows to fit by, taken by a hash of their ids
LEAST_ROWS = 5  # unlabelled rows a feature must occur in
LEAST_DISTANCE = 2.0  # standard errors between its shares of positives and of unlabelled rows
PREFIXES = (4, 5, 6, 7, 8)
TOXIC_FROM = 0.3
HELD_OUT = 2
NOT_WORD = tuple(i for i in range(128) if not chr(i).isalnum())


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4, F.lit(HELD_OUT)) == HELD_OUT


def features(texts: list[bytes | None], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, count) of every feature, or of those that ``wanted`` marks."""
    words = Words(texts, NOT_WORD)
    owner, hashes = words.text_of_word(), words.hashes()
    found = [(owner, hashes)]
    for size in PREFIXES:
        which, beginnings = words.prefixes(size)
        found.append((owner[which], beginnings))
    keys = []
    for where, hashed in found:
        feature = (hashed % np.uint64(SPACE)).astype(np.int64)
        if wanted is not None:
            hit = wanted[feature]
            where, feature = where[hit], feature[hit]
        keys.append(where.astype(np.int64) * SPACE + feature)
    unique, counts = np.unique(np.concatenate(keys), return_counts=True)
    return unique // SPACE, unique % SPACE, counts


@dataclass(frozen=True)
class Model:
    """Features in ascending order, their weights, and the bias; without features every score is 0."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def marks(self) -> np.ndarray:
        wanted = np.zeros(SPACE, bool)
        wanted[self.features] = True
        return wanted

    def rows(self, texts: list[bytes | None], wanted: np.ndarray) -> Rows:
        where, feature, counts = features(texts, wanted)
        bounds = np.searchsorted(where, np.arange(len(texts) + 1))
        return Rows(bounds, np.searchsorted(self.features, feature), np.log1p(counts))

    def scores(self, texts: list[bytes | None], wanted: np.ndarray) -> np.ndarray:
        if not len(self.features):
            return np.zeros(len(texts))
        return sigmoid(self.rows(texts, wanted).dot(self.weights) + self.bias)


def training_rows(
    docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED
) -> tuple[DataFrame, float]:
    """Texts of the training fold flagged positive and unlabelled, and the share of its labelled rows that are toxic.

    Both samples have a fixed bound, so their ids are broadcast to the documents.
    """
    by_id = labels.filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id")))
    by_id = by_id.groupBy(F.col("doc_id").alias("sample_id")).agg((F.max("toxic") > 0).alias("toxic"))
    share = by_id.agg(F.avg(F.col("toxic").cast("double"))).head()[0]
    order = [F.xxhash64("sample_id"), "sample_id"]
    p = by_id.filter("toxic").orderBy(*order).limit(positives).select("sample_id", F.lit(True).alias("p"))
    u = by_id.orderBy(*order).limit(unlabelled).select("sample_id", F.lit(True).alias("u"))
    ids = p.join(u, "sample_id", "full").fillna(False)
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("sample_id"))
    # One text an id.
    rows = rows.groupBy("sample_id", "p", "u").agg(F.min("text").alias("text"))
    return written(rows, "toxicity-sample"), float(share or 0.0)


def choose_features(sample: DataFrame, count: int = FEATURES) -> np.ndarray:
    """Features whose share of the positives differs most from their share of the unlabelled, in standard errors."""

    def occurrences(batches):
        for batch in chunks(batches, "text"):
            where, feature, _ = features(text_bytes(batch, "text"))
            flags = {k: np.array(batch.column(k).to_pylist(), bool) for k in ("p", "u")}
            seen, at = np.unique(feature, return_inverse=True)
            sums = [np.bincount(at, flags[k][where], minlength=len(seen)).astype(np.int64) for k in ("p", "u")]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (seen, *sums)], ["feature", "p", "u"])

    seen = sample.mapInArrow(occurrences, "feature long, p long, u long").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    sizes = sample.agg(F.sum(F.col("p").cast("long")).alias("p"), F.sum(F.col("u").cast("long")).alias("u")).head()
    n_p, n_u = sizes["p"] or 0, sizes["u"] or 0
    if not n_p or not n_u:
        return np.zeros(0, np.int64)
    share = F.col("u") / F.lit(float(n_u))
    error = F.sqrt((share * (F.lit(1.0) - share) + F.lit(1e-9)) / F.lit(float(n_p)))
    distance = F.abs(F.col("p") / F.lit(float(n_p)) - share) / error
    top = seen.filter((F.col("u") >= LEAST_ROWS) & (distance > LEAST_DISTANCE)).orderBy(distance.desc(), "feature").limit(count)
    return np.sort(top.select("feature").toArrow().column("feature").to_numpy())


def fit(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> Model:
    """The classifier; ``prior`` is the share of toxic text, unless given that of the fold's labelled rows."""
    sample, share = training_rows(docs, labels)
    prior = min(max(share if prior is None else prior, 1e-4), 0.5)
    nothing = Model(np.zeros(0, np.int64), np.zeros(0), 0.0)
    model = Model(choose_features(sample), np.zeros(0), 0.0)
    if not len(model.features):
        return nothing
    marks = model.marks()

    def narrowed(batches):
        for batch in chunks(batches, "text"):
            rows = model.rows(text_bytes(batch, "text"), marks)
            columns, values = (
                pa.ListArray.from_arrays(pa.array(rows.bounds, pa.int32()), pa.array(x)) for x in (rows.columns, rows.values)
            )
            yield pa.RecordBatch.from_arrays([batch.column("p"), batch.column("u"), columns, values], ["p", "u", "columns", "values"])

    kept = sample.select("sample_id", "p", "u", "text").mapInArrow(narrowed, "p boolean, u boolean, columns array<long>, values array<double>")
    data = kept.toArrow().combine_chunks()

    def part(flag: str) -> Rows:
        chosen = data.filter(data.column(flag))
        columns, values = (chosen.column(c).combine_chunks() for c in ("columns", "values"))
        lengths = np.array([len(x) for x in columns], np.int64)
        return Rows(np.concatenate([[0], np.cumsum(lengths)]), columns.flatten().to_numpy(), values.flatten().to_numpy())

    weights, bias = train_nnpu(part("p"), part("u"), len(model.features), prior)
    return Model(model.features, weights, bias)


def with_scores(docs: DataFrame, model: Model, into: str = "score") -> DataFrame:
    state: dict = {}

    def score(texts):
        if "marks" not in state:
            state["marks"] = model.marks()
        return [pa.array(model.scores(texts, state["marks"]), pa.float64())]

    return with_columns(docs, "text", f"`{into}` double", score)


def document_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = with_scores(docs.select("doc_id", "text"), fit(docs, labels))
    predicted = F.when(F.col("score") >= TOXIC_FROM, 1).otherwise(0)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def harmless_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, all columns, whose score stays below the threshold."""
    score = fresh(docs, "score")
    return with_scores(docs, fit(docs, labels), score).filter(F.col(score) < TOXIC_FROM).select(*docs.columns)
