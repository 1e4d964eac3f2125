from __future__ import annotations

import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from mergelens.llm.quality import (
    FtrlSettings,
    QualityModel,
    _ftrl,
    features,
    fit_quality,
    is_held_out,
    score_quality,
    train,
)
from tests.conftest import SF_MEDIUM
from tests.llm.fixtures import documents, odd_texts


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MEDIUM}/documents.parquet")
    labels = spark.read.parquet(f"{SF_MEDIUM}/labels.parquet")
    model = fit_quality(docs, labels)
    rows = (
        score_quality(docs.select("doc_id", "text"), model)
        .join(labels, "doc_id")
        .where(is_held_out(F.col("doc_id")))
        .collect()
    )
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    good = np.array([r.score for r in rows if r.quality == 1])
    bad = np.array([r.score for r in rows if r.quality == 0])
    assert (good[:, None] > bad).mean() > 0.95
    assert (good >= 0.3).mean() > 0.97


def test_scores_are_sparse_products(spark):
    weights = np.random.default_rng(0).normal(size=1 << 12).astype(np.float32)
    model = QualityModel(weights, 0.25, 12)
    df = documents(spark, clashing=True).withColumn("Score", F.lit("old"))
    got = {r.doc_id: r.score for r in score_quality(df, model).collect()}
    for i, text in enumerate(odd_texts()):
        buckets, values = features(text, 12)
        margin = 0.25 + sum(float(weights[b]) * v for b, v in zip(buckets, values, strict=True))
        assert abs(got[3 * i] - 1 / (1 + np.exp(-margin))) < 1e-5


def test_training_reads_a_bounded_sample_that_is_not_held_out(spark):
    docs = documents(spark, [f"good text {i}" if i % 2 else f"bad | {i}" for i in range(200)], range(200))
    labels = spark.createDataFrame(
        [(i, i % 2, 0) for i in range(200)] + [(5, None, 0), (None, 1, 0), (7, 0, 0)],
        "doc_id long, quality int, toxic int",
    )
    model = fit_quality(docs, labels, FtrlSettings(bits=10, sample=60))
    scores = {r.doc_id: r.score for r in score_quality(docs, model).collect()}
    assert min(scores[i] for i in range(1, 200, 2)) > max(scores[i] for i in range(0, 200, 2))


def test_repeated_ids_and_characters_bound_the_sample(spark):
    texts = [f"good text {i % 40}" if i % 2 else f"bad | {i % 40}" for i in range(400)]
    once = documents(spark, texts[:40], range(40))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    model = fit_quality(once, labels, FtrlSettings(bits=10))
    # The same texts many times, and larger ones of the same ids, change nothing.
    more = [*texts, *[f"~ another {i}" for i in range(40)]]
    repeated = documents(spark, more, [*[i % 40 for i in range(400)], *range(40)])
    again = fit_quality(repeated, labels, FtrlSettings(bits=10))
    assert np.array_equal(model.weights, again.weights) and model.bias == again.bias
    order = [
        r.doc_id
        for r in once.where(~is_held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id")).collect()
    ]
    first = order[:3]
    read = sum(len(texts[i]) for i in first)
    bounded = fit_quality(once, labels, FtrlSettings(bits=10, characters=read))
    alone = fit_quality(once.where(F.col("doc_id").isin(first)), labels, FtrlSettings(bits=10))
    assert np.array_equal(bounded.weights, alone.weights) and bounded.bias == alone.bias


def test_updates_equal_those_written_out(spark):
    """The update rule with plain numbers, one weight after the other."""
    draw = random.Random(4)
    settings = FtrlSettings(bits=4, passes=2, l1=0.01)
    rows = []
    for i in range(30):
        buckets = sorted(draw.sample(range(16), draw.randrange(1, 6)))
        rows.append((np.array(buckets), np.array([draw.random() for _ in buckets]), i % 3 % 2))
    z, n = [0.0] * 17, [0.0] * 17
    good = sum(label for _, _, label in rows)
    weight = {1: 15 / good, 0: 15 / (30 - good)}

    def current(k):
        if k == 16:
            return -z[k] / ((settings.beta + n[k] ** 0.5) / settings.alpha)
        if abs(z[k]) <= settings.l1:
            return 0.0
        pull = settings.l1 if z[k] > 0 else -settings.l1
        return (pull - z[k]) / ((settings.beta + n[k] ** 0.5) / settings.alpha + settings.l2)

    for _ in range(settings.passes):
        for buckets, values, label in rows:
            parts = [*zip(buckets.tolist(), values.tolist(), strict=True), (16, 1.0)]
            weights = {k: current(k) for k, _ in parts}
            guess = 1 / (1 + math.exp(-sum(weights[k] * v for k, v in parts)))
            for k, v in parts:
                gradient = (guess - label) * weight[label] * v
                step = ((n[k] + gradient**2) ** 0.5 - n[k] ** 0.5) / settings.alpha
                z[k] += gradient - step * weights[k]
                n[k] += gradient**2
    found, bias = _ftrl(rows, settings)
    assert np.allclose(found, [current(k) for k in range(16)]) and math.isclose(bias, current(16))


def test_no_rows_no_labels_one_label(spark):
    docs = documents(spark, ["a", None], [1, 2])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = fit_quality(docs, none)
    assert [r.score for r in score_quality(docs, model).collect()] == [0.5, 0.5]
    assert score_quality(documents(spark, []), model).count() == 0
    one = [(np.array([1]), np.array([1.0]), 1)] * 10
    assert np.isfinite(train(one, FtrlSettings(bits=4)).bias)
