"""Quality: a byte-level convolutional network in numpy.

Filters of ``WIDTH`` bytes slide over every byte of a text.  Their responses are
max-pooled over overlapping chunks (two neighbouring blocks of ``BLOCK`` bytes
each), and the mean and the maximum over all chunks are combined into one
probability.  As the input is one byte out of 256, a filter is a table with one
weight for each place and byte value, and a convolution is ``WIDTH`` look-ups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType

from courtline.llm import text_arrays as ta
from courtline.llm.common import labelled_sample, text_or_empty

WIDTH = 6
FILTERS = 16
BLOCK = 256
HELD_OUT = 5
# Blocks whose responses are held at a time.
_AT_ONCE = 64


@dataclass(frozen=True)
class Training:
    """Settings of the training; ``sample_rows`` bounds the labelled rows that are used."""

    sample_rows: int = 6_000
    epochs: int = 8
    batch: int = 16
    rate: float = 0.01
    seed: int = 7


class Network(NamedTuple):
    """``filters`` [WIDTH, 256, FILTERS], their ``offset``, and weights of the means and maxima with a bias."""

    filters: np.ndarray
    offset: np.ndarray
    output: np.ndarray
    bias: np.ndarray


class Layout(NamedTuple):
    """Texts padded with zero bytes to whole blocks; ``first`` is each text's first block."""

    data: np.ndarray
    first: np.ndarray


def layout(t: ta.Texts) -> Layout:
    """Every text gets at least one block, which ends in zeros for at least the width of a filter less one."""
    sizes = np.diff(t.bounds)
    blocks = -(-(sizes + WIDTH - 1) // BLOCK)
    first = np.concatenate(([0], np.cumsum(blocks)))
    data = np.zeros(first[-1] * BLOCK + WIDTH, np.uint8)
    shift = np.repeat(first[:-1] * BLOCK - t.bounds[:-1], sizes)
    data[np.arange(len(t.data)) + shift] = t.data
    return Layout(data, first)


def block_maxima(x: Layout, net: Network, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Largest response of each filter in each block, and where it is.

    Places from which a filter would reach into the next text hold only padding and do not count.
    """
    n = int(x.first[-1])
    closing = np.zeros(n, bool)
    closing[x.first[1:] - 1] = True
    best = np.empty((n, FILTERS), np.float32)
    at = np.empty((n, FILTERS), np.int64) if places else None
    for a in range(0, n, _AT_ONCE):
        b = min(n, a + _AT_ONCE)
        size = (b - a) * BLOCK
        piece = x.data[a * BLOCK:b * BLOCK + WIDTH]
        response = net.filters[0].take(piece[:size], axis=0)
        for k in range(1, WIDTH):
            response += net.filters[k].take(piece[k:k + size], axis=0)
        response = response.reshape(b - a, BLOCK, FILTERS)
        response[closing[a:b], BLOCK - WIDTH + 1:] = -np.inf
        if at is None:
            best[a:b] = response.max(axis=1)
        else:
            place = response.argmax(axis=1)
            best[a:b] = np.take_along_axis(response, place[:, None, :], 1)[:, 0, :]
            at[a:b] = place + (np.arange(a, b) * BLOCK)[:, None]
    return best, at


def pooled(best: np.ndarray, first: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of each text (mean and maximum over its chunks), and the block that fills each chunk's maximum.

    Chunk i of a text is its blocks i and i + 1; a text of one block is one chunk.
    """
    n = len(best)
    following = np.minimum(np.arange(n) + 1, n - 1)
    last = first[1:] - 1
    following[last] = last
    second = best[following] > best
    chunk = np.where(second, best[following], best)
    held = np.ones(n, bool)
    held[last[last > first[:-1]]] = False
    response = np.maximum(chunk + offset, 0)
    count = np.add.reduceat(held.astype(np.int64), first[:-1])
    mean = np.add.reduceat(response * held[:, None], first[:-1], axis=0) / count[:, None]
    highest = np.maximum.reduceat(response, first[:-1], axis=0)
    return np.concatenate([mean, highest], axis=1).astype(np.float32), second, held


def probabilities(t: ta.Texts, net: Network) -> np.ndarray:
    x = layout(t)
    best, _ = block_maxima(x, net)
    f, _, _ = pooled(best, x.first, net.offset)
    return 1 / (1 + np.exp(-np.clip(f @ net.output + net.bias[0], -30, 30).astype(np.float64)))


def _gradient(t: ta.Texts, y: np.ndarray, net: Network) -> Network:
    """Gradient of the mean log loss of some texts, routed through the places that won the pooling."""
    x = layout(t)
    best, at = block_maxima(x, net, places=True)
    f, second, held = pooled(best, x.first, net.offset)
    p = 1 / (1 + np.exp(-np.clip(f @ net.output + net.bias[0], -30, 30)))
    error = ((p - y) / len(y)).astype(np.float32)
    by_feature = error[:, None] * net.output[None, :]
    n = len(best)
    text = np.repeat(np.arange(len(y)), np.diff(x.first))
    chunks = np.add.reduceat(held.astype(np.int64), x.first[:-1])
    blocks = np.where(second, np.minimum(np.arange(n) + 1, n - 1)[:, None], np.arange(n)[:, None])
    response = np.maximum(np.take_along_axis(best, blocks, 0) + net.offset, 0)
    to_chunk = held[:, None] * by_feature[text, :FILTERS] / chunks[text][:, None]
    top = f[:, FILTERS:][text]
    winner = held[:, None] & (response == top) & (response > 0)
    ties = np.maximum(1, np.add.reduceat(winner.astype(np.int64), x.first[:-1], axis=0))
    to_chunk = (to_chunk + winner * by_feature[text, FILTERS:] / ties[text]) * (response > 0)
    place = np.take_along_axis(at, blocks, 0)
    filters = np.zeros_like(net.filters)
    which = np.broadcast_to(np.arange(FILTERS), place.shape)
    used = to_chunk != 0
    place, which, amount = place[used], which[used], to_chunk[used]
    for k in range(WIDTH):
        flat = x.data[place + k].astype(np.int64) * FILTERS + which
        filters[k] = np.bincount(flat, amount, 256 * FILTERS).reshape(256, FILTERS)
    return Network(filters, to_chunk.sum(axis=0), f.T @ error, np.array([error.sum()], np.float32))


def fit_network(rows: list[tuple[str, int]], s: Training = Training()) -> Network:
    """Adam over the rows, shuffled by a fixed seed."""
    rng = np.random.default_rng(s.seed)
    rate = (sum(y for _, y in rows) + 0.5) / (len(rows) + 1)
    net = Network(rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32),
                  rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
                  np.array([np.log(rate / (1 - rate))], np.float32))
    first = [np.zeros_like(a) for a in net]
    square = [np.zeros_like(a) for a in net]
    step = 0
    for _ in range(s.epochs if rows else 0):
        order = rng.permutation(len(rows))
        for a in range(0, len(rows), s.batch):
            some = [rows[i] for i in order[a:a + s.batch]]
            grads = _gradient(ta.texts(pa.array([x for x, _ in some], pa.string())),
                              np.array([y for _, y in some], np.float32), net)
            step += 1
            for value, g, m, v in zip(net, grads, first, square, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                value -= s.rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-7)
    return net


def train(docs: DataFrame, labels: DataFrame, settings: Training = Training(), label: str = "quality",
          id_column: str = "doc_id", text_column: str = "text") -> Network:
    """Fit on a bounded sample of the labelled rows that are not held out, in one task.

    Without any such row the untrained network scores every text near one half.
    """
    sample = labelled_sample(docs, labels, label, HELD_OUT, settings.sample_rows, id_column, text_column)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(x, int(y > 0)) for b in batches
                for x, y in zip(b.column("text").to_pylist(), b.column("label").to_pylist(), strict=True)]
        net = fit_network(rows, settings)
        yield pa.record_batch({"part": pa.array(range(len(net))), "values": pa.array(
            [a.astype(np.float32).tobytes() for a in net], pa.binary())})

    parts = sample.repartition(1).sortWithinPartitions("order").mapInArrow(
        fit, "part long, values binary").collect()
    if not parts:
        return fit_network([], settings)
    shapes = [(WIDTH, 256, FILTERS), (FILTERS,), (2 * FILTERS,), (1,)]
    values = {r.part: np.frombuffer(r["values"], np.float32) for r in parts}
    return Network(*(values[i].reshape(shape) for i, shape in enumerate(shapes)))


def with_score(docs: DataFrame, net: Network, text_column: str = "text", score: str = "score") -> DataFrame:
    """Adds the probability of label 1; null counts as the empty text, whose one block is all zero bytes."""
    sent = docs.sparkSession.sparkContext.broadcast(tuple(net))

    def probability(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = Network(*sent.value)
        for array in arrays:
            out = [probabilities(t, model) for _, t in ta.slices(pa.record_batch({"text": array}))]
            yield pa.array(np.concatenate([np.zeros(0), *out]))

    udf = F.arrow_udf(probability, "double", ArrowUDFType.SCALAR_ITER)
    return docs.withColumn(score, udf(text_or_empty(text_column)))
