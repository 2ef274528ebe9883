"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct words, their stems, word pairs and pairs with one word between, hashed
to ``2**BITS`` coordinates.  Each coordinate has its own learning rate; L1 keeps
most weights at exactly zero, so the model is a short list of (coordinate, weight)
that every task can hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType

from courtline.llm import text_arrays as ta
from courtline.llm.common import carried, labelled_sample, text_or_empty

BITS = 20
HELD_OUT = 5
# Bytes at which longer words are also cut to a stem, so that inflected forms share a unigram.
STEMS = (4, 5)


@dataclass(frozen=True)
class Training:
    """Settings of the training; ``sample_rows`` bounds the labelled rows that are used."""

    sample_rows: int = 16_000
    epochs: int = 3
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 3.0
    l2: float = 1.0


@dataclass(frozen=True)
class Model:
    """Non-zero weights by coordinate, and the bias."""

    coordinates: np.ndarray
    weights: np.ndarray
    bias: float


def features(t: ta.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct coordinates of each text, and where each text's begin."""
    data = ta.lower(t.data)
    w = ta.words(t, letters_only=True)
    h = ta.word_hashes(data, w)
    text = ta.owner(w.bounds)
    parts, owners = [ta.mix(h)], [text]
    for stem in STEMS:
        longer = w.end - w.start > stem
        cut = ta.word_hashes(data, ta.Words(w.start[longer], w.start[longer] + stem, w.bounds))
        parts.append(ta.mix(cut + np.uint64(stem)))
        owners.append(text[longer])
    for offsets in ((0, 1), (0, 2)):
        ok = ta.within(w.bounds, offsets[-1] + 1)
        parts.append(ta.gram_hashes(h, offsets)[ok])
        owners.append(text[:len(ok)][ok])
    keys = (np.concatenate(owners).astype(np.uint64) << np.uint64(BITS)) | (
        np.concatenate(parts) >> np.uint64(64 - BITS))
    keys.sort()
    keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys
    starts = np.searchsorted(keys, np.arange(len(t) + 1, dtype=np.uint64) << np.uint64(BITS))
    return (keys & np.uint64(2**BITS - 1)).astype(np.int32), starts


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, t in ta.slices(batch):
            f, starts = features(t)
            yield pa.record_batch({
                "order": part.column("order"), "label": part.column("label"),
                "features": pa.array([f[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)], pa.binary())})


def ftrl(rows: list[tuple[int, np.ndarray]], s: Training) -> Model:
    """FTRL-proximal over the rows in order; the bias starts at the smoothed log odds and has no penalty."""
    z, n = np.zeros(2**BITS), np.zeros(2**BITS)
    positive = sum(y for y, _ in rows)
    prior = (positive + 0.5) / (len(rows) + 2)
    bias, bias_n = float(np.log(prior / (1 - prior))), 1.0
    for _ in range(s.epochs):
        for y, x in rows:
            zx, nx = z[x], n[x]
            root = np.sqrt(nx)
            w = np.where(np.abs(zx) <= s.l1, 0.0, (np.sign(zx) * s.l1 - zx) / ((s.beta + root) / s.alpha + s.l2))
            g = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - y
            z[x] = zx + g - (np.sqrt(nx + g * g) - root) / s.alpha * w
            n[x] = nx + g * g
            bias_n += g * g
            bias -= s.alpha / (s.beta + np.sqrt(bias_n)) * g
    used = np.flatnonzero(np.abs(z) > s.l1)
    w = (np.sign(z[used]) * s.l1 - z[used]) / ((s.beta + np.sqrt(n[used])) / s.alpha + s.l2)
    return Model(used.astype(np.int32), w.astype(np.float32), float(bias))


def train(docs: DataFrame, labels: DataFrame, settings: Training = Training(), label: str = "toxic",
          id_column: str = "doc_id", text_column: str = "text") -> Model:
    """Fit on a bounded sample of the labelled rows that are not held out, in one task.

    Without any such row the model has no weights and scores every text 0.25.
    """
    sample = labelled_sample(docs, labels, label, HELD_OUT, settings.sample_rows, id_column, text_column)
    encoded = sample.mapInArrow(_encode, "order long, label int, features binary")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(int(y > 0), np.frombuffer(x, np.int32)) for b in batches
                for y, x in zip(b.column("label").to_pylist(), b.column("features").to_pylist(), strict=True)]
        m = ftrl(rows, settings)
        yield pa.record_batch({"coordinate": pa.array([-1, *m.coordinates], pa.int32()),
                               "weight": pa.array([m.bias, *m.weights], pa.float64())})

    fitted = encoded.repartition(1).sortWithinPartitions("order").mapInArrow(
        fit, "coordinate int, weight double").collect()
    if not fitted:
        return ftrl([], settings)
    found = sorted((r.coordinate, r.weight) for r in fitted)
    return Model(np.array([c for c, _ in found[1:]], np.int32), np.array([w for _, w in found[1:]], np.float32),
                 found[0][1])


def with_score(docs: DataFrame, model: Model, text_column: str = "text", score: str = "score") -> DataFrame:
    """Adds the probability that a text is toxic; an empty or null text gets the model's bias alone."""
    sparse = docs.sparkSession.sparkContext.broadcast(model)

    def probability(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = sparse.value
        dense = np.zeros(2**BITS, np.float32)
        dense[m.coordinates] = m.weights
        for array in arrays:
            out = [np.zeros(0)]
            for _, t in ta.slices(pa.record_batch({"text": array})):
                f, starts = features(t)
                sums = np.concatenate(([0.0], np.cumsum(dense[f], dtype=np.float64)))
                out.append(1 / (1 + np.exp(-np.clip(sums[starts[1:]] - sums[starts[:-1]] + m.bias, -35, 35))))
            yield pa.array(np.concatenate(out))

    udf = F.arrow_udf(probability, "double", ArrowUDFType.SCALAR_ITER)
    return docs.withColumn(score, udf(text_or_empty(text_column)))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, settings: Training = Training(),
                 id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that score under ``threshold``, with the columns of ``docs``."""
    model = train(docs, labels, settings, id_column=id_column, text_column=text_column)
    scored = with_score(carried(docs, id_column, text_column), model)
    return scored.filter(F.col("score") < threshold).select("row.*")
