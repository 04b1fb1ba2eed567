import random
import zlib

import numpy as np
import pytest
import xxhash
from llm_tables import EDGE, edge, empty, frame, prose, vocabulary
from pyspark.sql import functions as F

from despacho.llm import quality, toxicity
from despacho.llm.linear import Rows, sigmoid, train_nnpu

WORDS = vocabulary(1)
INSULTS = ["blorkhead", "snarfling", "grumwit"]


def corpus(n=600):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(n):
        text, good, toxic = prose(rng, WORDS, rng.randint(5, 60)), 1, int(rng.random() < 0.25)
        if toxic:
            parts = text.split()
            for _ in range(3):
                parts.insert(rng.randrange(len(parts)), rng.choice(INSULTS))
            text = " ".join(parts)
        elif rng.random() < 0.2:
            good = 0
            text = " ".join(w + "%%%" for w in text.split()) if rng.random() < 0.5 else " ".join([text.split()[0]] * 40)
        docs.append((i, text))
        labels.append((i, good, toxic))
    return docs, labels


def labels_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def learnt(spark):
    docs, labels = corpus()
    return frame(spark, docs).cache(), labels_frame(spark, labels), {i: (g, t) for i, g, t in labels}


def test_toxicity_on_the_held_out_fold(learnt):
    docs, labels, truth = learnt
    rows = toxicity.document_toxicity(docs, labels).collect()
    assert len(rows) == len(truth) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    held = [(r.predicted, truth[r.doc_id][1]) for r in rows if r.held_out]
    assert sum(a == b for a, b in held) / len(held) > 0.97
    assert sum(a for a, b in held if b) / sum(b for _, b in held) > 0.95


def test_labels_of_the_held_out_fold_are_not_learnt(spark, learnt):
    docs, labels, _ = learnt
    fold = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    changed = labels.withColumn("toxic", F.when(fold, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [{r.doc_id: r.score for r in toxicity.document_toxicity(docs, x).collect()} for x in (labels, changed)]
    assert scores[0] == scores[1]


def test_toxicity_edge_rows(spark, learnt):
    docs, labels, _ = learnt
    model = toxicity.fit(docs, labels)
    rows = toxicity.with_scores(edge(spark).select("doc_id", "text"), model).collect()
    assert len(rows) == len(EDGE)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3, 13)}) == 1
    assert toxicity.document_toxicity(empty(spark), labels).collect() == []
    unlabelled = toxicity.document_toxicity(edge(spark), labels_frame(spark, [])).collect()
    assert len(unlabelled) == len(EDGE) and {r.score for r in unlabelled} == {0.0}
    assert {r.held_out for r in unlabelled if r.doc_id is None} == {True}
    odd = labels_frame(spark, [(4, None, 1), (None, 1, 1), (4, 0, None), (8, 1, 0), (8, 1, 1)])
    assert toxicity.document_toxicity(edge(spark), odd).count() == len(EDGE)


def test_the_toxicity_stage_keeps_all_columns(spark, learnt):
    docs, labels, truth = learnt
    full = docs.withColumn("Score", F.lit("mine"))
    kept = toxicity.harmless_documents(full, labels)
    assert kept.columns == full.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, t) in truth.items() if not t}


def test_negative_risk_is_not_fitted_below_zero():
    rng = np.random.default_rng(0)
    n, width = 400, 50
    bounds = np.arange(n + 1) * 2
    positive = Rows(bounds, rng.integers(0, 5, 2 * n), np.ones(2 * n))
    mixed = rng.integers(5, width, 2 * n)
    mixed[: 2 * n // 5] = rng.integers(0, 5, 2 * n // 5)
    unlabelled = Rows(bounds, mixed, np.ones(2 * n))
    w, b = train_nnpu(positive, unlabelled, width, prior=0.2)
    scores = sigmoid(unlabelled.dot(w) + b)
    assert scores[: n // 5].mean() > 0.9 and scores[n // 5 :].mean() < 0.1
    zu, zp = unlabelled.dot(w) + b, positive.dot(w) + b
    assert np.logaddexp(0, zu).mean() - 0.2 * np.logaddexp(0, zp).mean() > -0.02


def test_quality_parts_good_from_bad(learnt):
    docs, labels, truth = learnt
    rows = {r.doc_id: r for r in quality.document_quality(docs, labels).collect()}
    assert sum(rows[i].selected for i, (g, _) in truth.items() if g) / sum(g for g, _ in truth.values()) > 0.97
    assert sum(rows[i].selected for i, (g, _) in truth.items() if not g) <= 2


def test_gumbel_top_k_takes_k(learnt):
    docs, labels, _ = learnt
    resampler, scored = quality.fit(docs, labels, k=100)
    taken = scored.filter(resampler.selected(F.col("rank"))).collect()
    ranks = sorted((r["rank"] for r in scored.collect()), reverse=True)
    assert len(taken) == 100 and {r["rank"] for r in taken} == set(ranks[:100])
    other, scored = quality.fit(docs, labels, k=100, seed=9)
    assert {r.doc_id for r in taken} != {r.doc_id for r in scored.filter(other.selected(F.col("rank"))).collect()}


def test_top_k_is_exact_where_many_documents_are_close(spark):
    # Without target rows all weights are 1, and only the noise parts the documents.
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text")).cache()
    for k in (1, 777, 9000):
        resampler, scored = quality.fit(docs, labels_frame(spark, []), k=k)
        assert scored.filter(resampler.selected(F.col("rank"))).count() == k
    assert scored.select("rank").distinct().count() == 20_000


def test_rows_without_an_id_draw_by_their_text(spark):
    rows = [(None, f"{w} text") for w in "abcdefgh"] + [(None, "a text"), (4, "one"), (4, "other")]
    got = quality.fit(frame(spark, rows), labels_frame(spark, []), k=3)[1].collect()
    ranks = [r["rank"] for r in got if r.doc_id is None]
    assert len(set(ranks)) == 8 and len({r["rank"] for r in got if r.doc_id == 4}) == 1


def test_weights_and_choice_by_the_definition(spark, learnt):
    """Both models counted text by text, without Spark; then the documents of the largest noisy weights."""
    docs, labels, truth = learnt
    texts = {r.doc_id: (r.text or "").encode() for r in docs.select("doc_id", "text").collect()}
    buckets = 1 << 12
    found = {i: np.bincount(quality.ngrams([t], buckets)[1].astype(np.int64), minlength=buckets) for i, t in texts.items()}
    good = {r.doc_id for r in labels.filter("quality = 1").select("doc_id").collect()}
    raw = sum(found.values())
    target = sum(n for i, n in found.items() if i in good)
    ratio = np.log((target + 1) / (target.sum() + buckets)) - np.log((raw + 1) / (raw.sum() + buckets))
    resampler, scored = quality.fit(docs, labels, k=50, buckets=buckets)
    rows = scored.collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.log_weight == pytest.approx(float(found[r.doc_id] @ ratio), rel=1e-4, abs=1e-3)
    noise = {}
    for r in rows:
        u = ((xxhash.xxh64_intdigest(int(r.doc_id).to_bytes(8, "little", signed=True), _seeded(resampler.seed)) >> 11) + 0.5) / 2**53
        noise[r.doc_id] = r.log_weight - np.log(-np.log(u))
    taken = {r.doc_id for r in scored.filter(resampler.selected(F.col("rank"))).collect()}
    assert taken == set(sorted(noise, key=noise.get)[-50:])


def _seeded(seed):
    """Spark hashes column after column, each with the hash before it as seed; the first seed is 42, an int four bytes."""
    return xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), 42)


def test_ranks_have_the_order_of_the_keys(spark):
    weights = [-1e13, -3e12, -1e6, -16384.5, -16384.0, -16383.9, -5.0, -1e-9, 0.0, 1e-9, 7.25, 16383.9, 16384.0, 16384.1, 1e6, 1e12]
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(weights)], "i long, w double")
    ranks = [r["rank"] for r in rows.select("i", quality.rank_of(F.col("w"), F.lit(4), F.lit(""), 1).alias("rank")).orderBy("i").collect()]
    assert all(0 <= a < b < 1 << 62 for a, b in zip(ranks[1:], ranks[2:])) and ranks[0] == ranks[1]


def test_weights_equal_the_ratio_of_both_models():
    raw, target = np.array([3.0, 0.0, 5.0]), np.array([1.0, 0.0, 4.0])
    want = [np.log(((t + 1) / 8) / ((r + 1) / 11)) for r, t in zip(raw, target)]
    assert np.allclose(quality.log_ratios(raw, target), want)
    where, bucket = quality.ngrams([b"a b a", None, b"", b"one"], 1 << 16)
    # Three words, two pairs, three shapes, two pairs and a triple of shapes; then one word and its shape.
    assert np.bincount(where, minlength=4).tolist() == [11, 0, 0, 2]


def test_kth_largest(spark):
    values = [5, 5, 5, 1 << 40, 0, 7, (1 << 61) + 3]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for k, want in enumerate(sorted(values, reverse=True), 1):
        assert quality.kth_largest(df, "v", k) == want
    assert quality.kth_largest(df, "v", 0) is None


def test_quality_edge_rows(spark):
    labels = labels_frame(spark, [(5, 1, 0), (8, 1, 0), (13, 0, 0), (12, 0, 0), (12, 1, 0), (None, 1, 0), (7, None, 0)])
    rows = quality.document_quality(edge(spark), labels).collect()
    assert len(rows) == len(EDGE)
    assert {r.log_weight for r in rows if r.doc_id in (1, 2, 3)} == {0.0}
    assert quality.document_quality(empty(spark), labels).collect() == []
    neutral = quality.document_quality(edge(spark), labels_frame(spark, [])).collect()
    assert len(neutral) == len(EDGE) and {r.log_weight for r in neutral} == {0.0} and all(r.selected for r in neutral)
    kept = quality.good_documents(edge(spark), labels)
    assert kept.columns == edge(spark).columns and kept.count() <= len(EDGE)


def own_columns(rng, n, first, shared):
    """Rows with a column of their own and two common ones each."""
    columns = np.concatenate([[first + i, *rng.choice(shared, 2, replace=False)] for i in range(n)])
    return Rows(np.arange(0, 3 * n + 1, 3), columns, rng.random(3 * n) + 0.5)


def risks(positive, unlabelled, prior, w, b):
    zp, zu = positive.dot(w) + b, unlabelled.dot(w) + b
    return prior * np.logaddexp(0, -zp).mean(), np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()


def test_the_first_step_goes_down_the_gradient_of_the_risk():
    rng, width, prior = np.random.default_rng(3), 60, 0.2
    positive, unlabelled = own_columns(rng, 8, 10, 10), own_columns(rng, 40, 18, 10)
    start = float(np.log(prior / (1 - prior)))

    def risk(x):
        plus, minus = risks(positive, unlabelled, prior, x[:-1], x[-1])
        return plus + max(0.0, minus)

    at, step = np.append(np.zeros(width), start), 1e-6
    gradient = np.array([(risk(at + step * e) - risk(at - step * e)) / (2 * step) for e in np.eye(width + 1)])
    w, b = train_nnpu(positive, unlabelled, width, prior, steps=1, rate=0.01, l2=0.0)
    moved = np.append(w, b - start)
    steep = np.abs(gradient) > 1e-6
    assert steep.sum() > 50
    # The first step of Adam has the gradient's sign and the size of the rate.
    assert np.allclose(moved[steep], -0.01 * np.sign(gradient[steep]), rtol=1e-2)


def test_the_negative_part_is_not_fitted_below_zero():
    """Every row can be told by its own column; the plain estimator of the risk would fall without end."""
    rng, prior = np.random.default_rng(4), 0.3
    positive, unlabelled = own_columns(rng, 30, 10, 10), own_columns(rng, 120, 40, 10)
    w, b = train_nnpu(positive, unlabelled, 160, prior, steps=1500, l2=0.0)
    plus, minus = risks(positive, unlabelled, prior, w, b)
    assert plus < 0.3 and minus > -0.2
