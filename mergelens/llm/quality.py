"""Quality scores: logistic regression on hashed word n-grams, trained by FTRL-Proximal.

The update rule is that of McMahan et al., 2013 ("Ad click prediction: a view from the trenches").
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from mergelens.llm.samples import hash_share
from mergelens.llm.words import mixed
from mergelens.session import cut_lineage

#: A word, or a run of signs that are neither letters, digits nor white space.
PIECE = re.compile(r"\w+|[^\w\s]+")
_PAIR = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class FtrlSettings:
    """``bits``: 2**bits weights; ``sample``: labelled rows that training reads at most;
    ``characters``: those of their texts, the last one may go over; every ``calibration``-th row is
    kept from training, for the scale and bias of the scores."""

    bits: int = 18
    sample: int = 6_000
    characters: int = 60_000_000
    passes: int = 4
    calibration: int = 5
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    bias: float
    bits: int


def features(text: str | None, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and word pairs of the whole text, and their values.

    A bucket seen n times weighs log(1 + n); the values of a text have length 1, so long and short
    texts are scored alike. An empty or null text has no buckets.
    """
    pieces = PIECE.findall(text or "")
    ones = np.fromiter(
        map(xxh3_64_intdigest, map(str.encode, pieces)), np.uint64, len(pieces)
    )
    pairs = mixed(ones[:-1] * _PAIR + ones[1:])
    buckets, counts = np.unique(
        (np.concatenate([ones, pairs]) >> np.uint64(64 - bits)).astype(np.int32),
        return_counts=True,
    )
    values = np.log1p(counts)
    norm = np.sqrt(np.square(values).sum())
    return buckets, values / norm if norm else values


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], settings: FtrlSettings) -> QualityModel:
    """FTRL-Proximal over the rows in the given order; lazy weights, one learning rate each.

    The rarer label is weighted up so that both count alike. Scale and bias of the scores are then
    fitted on rows that training has not seen, so that scores are probabilities (Platt scaling).
    Without rows of both labels the weights are 0.
    """
    seen = [r for i, r in enumerate(rows) if i % settings.calibration]
    unseen = [r for i, r in enumerate(rows) if not i % settings.calibration]
    weights, bias = _ftrl(seen, settings)
    margins = np.array([bias + weights[b] @ v for b, v, _ in unseen])
    scale, shift = _platt(margins, np.array([label for _, _, label in unseen], np.float64))
    return QualityModel((weights * scale).astype(np.float32), bias * scale + shift, settings.bits)


def _platt(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a logistic fit by Newton steps, with a small pull towards 1 and 0."""
    if len(set(labels.tolist())) < 2:
        return 1.0, 0.0
    x = np.stack([margins, np.ones(len(margins))], 1)
    fitted = np.array([1.0, 0.0])
    for _ in range(50):
        guess = _logistic(x @ fitted)
        gradient = x.T @ (guess - labels) + 0.1 * (fitted - [1.0, 0.0])
        curve = (x * (guess * (1 - guess))[:, None]).T @ x + 0.1 * np.eye(2)
        fitted = fitted - np.clip(np.linalg.solve(curve, gradient), -2, 2)
    return float(max(fitted[0], 1e-3)), float(fitted[1])


def _ftrl(rows, settings: FtrlSettings) -> tuple[np.ndarray, float]:
    size = 1 << settings.bits
    z, n = np.zeros(size), np.zeros(size)
    z_bias = n_bias = 0.0
    good = sum(label for _, _, label in rows)
    bad = len(rows) - good
    weight = {1: len(rows) / (2 * good) if good else 1.0, 0: len(rows) / (2 * bad) if bad else 1.0}

    def current(z_part, n_part):
        shrunk = np.sign(z_part) * settings.l1 - z_part
        rate = (settings.beta + np.sqrt(n_part)) / settings.alpha + settings.l2
        return np.where(np.abs(z_part) <= settings.l1, 0.0, shrunk / rate)

    def bias_now():
        return -z_bias / ((settings.beta + np.sqrt(n_bias)) / settings.alpha)

    for _ in range(settings.passes):
        for buckets, values, label in rows:
            weights = current(z[buckets], n[buckets])
            bias = bias_now()
            guess = _logistic(bias + weights @ values)
            error = (guess - label) * weight[label]
            gradient = error * values
            grown = n[buckets] + gradient**2
            z[buckets] += gradient - (np.sqrt(grown) - np.sqrt(n[buckets])) / settings.alpha * weights
            n[buckets] = grown
            grown_bias = n_bias + error**2
            z_bias += error - (np.sqrt(grown_bias) - np.sqrt(n_bias)) / settings.alpha * bias
            n_bias = grown_bias
    return current(z, n), float(bias_now())


def _logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def is_held_out(key: Column) -> Column:
    """Whether crc32 of the key as text leaves no remainder by 5; null keys count as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit_quality(
    docs: DataFrame, labels: DataFrame, settings: FtrlSettings = FtrlSettings()
) -> QualityModel:
    """A model from at most ``settings.sample`` labelled rows that are not held out.

    The sample is the rows with the smallest hashes of their id, whatever the size of the tables,
    and is trained in that order; it ends where its texts exceed ``settings.characters``. Rows without
    id or label are not used; of an id labelled twice the smaller label counts, and of an id with
    several texts the smallest text. Executors choose one text of an id and turn it into a sparse
    vector, so that the driver gets a bounded number of vectors of a bounded size.
    """
    place = F.xxhash64("doc_id")
    chosen = (
        hash_share(labels, place, labels.count(), settings.sample)
        .where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .where(~is_held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
        .withColumn("place", place)
        .orderBy("place", "doc_id")
        .limit(settings.sample)
    )
    # One row for each id of the sample, without texts: their lengths, summed in order.
    before = Window.orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    sized = (
        docs.select("doc_id", F.length("text").alias("length"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "place", "quality")
        .agg(F.coalesce(F.max("length"), F.lit(0)).alias("length"))
        .withColumn("read", F.coalesce(F.sum("length").over(before), F.lit(0)))
        .where(F.col("read") < settings.characters)
        .select("doc_id", "place", "quality")
    )
    sized = cut_lineage(sized)
    joined = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(sized), "doc_id")
        .groupBy("doc_id", "place", "quality")
        .agg(F.min("text").alias("text"))
    )

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [features(t, settings.bits) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("place"),
                    batch.column("quality").cast(pa.int32()),
                    pa.array([b.tobytes() for b, _ in made], pa.binary()),
                    pa.array([v.astype(np.float32).tobytes() for _, v in made], pa.binary()),
                ],
                names=["doc_id", "place", "quality", "buckets", "values"],
            )

    schema = "doc_id long, place long, quality int, buckets binary, values binary"
    found = joined.mapInArrow(vectors, schema).toArrow().to_pylist()
    found.sort(key=lambda r: (r["place"], r["doc_id"]))
    return train(
        [
            (
                np.frombuffer(r["buckets"], np.int32),
                np.frombuffer(r["values"], np.float32).astype(np.float64),
                r["quality"],
            )
            for r in found
        ],
        settings,
    )


def score_quality(docs: DataFrame, model: QualityModel, name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1, higher: better; every text counts whole.

    Null and empty texts get the score of the bias alone. No other column is an input; all columns
    are kept, also an earlier one of the same ``name``, which is replaced.
    """
    kept = [c for c in docs.columns if c.lower() != name.lower()]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                buckets, values = features(text, own.bits)
                out.append(float(_logistic(own.bias + own.weights[buckets] @ values)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(out, pa.float64())],
                names=[*kept, name],
            )

    fields = docs.select(*kept).schema
    return docs.select(*kept).mapInArrow(scores, fields.add(name, "double"))
