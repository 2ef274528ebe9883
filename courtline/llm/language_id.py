"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  A letter n-gram is its letters'
vectors, each rotated by its place and multiplied together; a text is the sum of
its n-grams' vectors, a language the sum of its training texts.  A text gets the
language whose sum has the largest cosine with its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import ArrowUDFType

from courtline.llm import text_arrays as ta
from courtline.llm.common import remainder, text_or_empty

DIMENSIONS = 1024
GRAM = 3
# Symbols that letters are folded to; 0 stands for everything that is no letter.
SYMBOLS = 64
HELD_OUT = 5
UNKNOWN = "und"
_SEED = 20_011
# Texts whose vectors are made at a time.
_AT_ONCE = 256


class Profiles(NamedTuple):
    """Language names and their unit vectors."""

    names: list[str]
    vectors: np.ndarray


@cache
def _symbols() -> np.ndarray:
    """Symbol of each code point: a-z and the accented Latin letters by number, other letters folded, 0 if no letter."""
    points = np.arange(0x110000)
    letters = np.fromiter((chr(p).isalpha() for p in points), bool, len(points))
    folded = np.where(points < 0x80, (points | 0x20) - 0x60, 27 + points % (SYMBOLS - 27))
    return np.where(letters, folded, 0).astype(np.uint8)


@cache
def letter_vectors() -> np.ndarray:
    """[place, symbol, dimension]: every symbol's random vector, rotated for each place of an n-gram."""
    letters = np.random.default_rng(_SEED).choice(np.array([-1, 1], np.float32), (SYMBOLS, DIMENSIONS))
    return np.stack([np.roll(letters, GRAM - 1 - place, axis=1) for place in range(GRAM)])


def gram_vectors(codes: np.ndarray) -> np.ndarray:
    """Vectors of n-grams: their letters' rotated vectors bound by multiplication."""
    letters = letter_vectors()
    out = letters[GRAM - 1][codes % SYMBOLS]
    for place in range(GRAM - 1):
        out *= letters[place][codes // SYMBOLS ** (GRAM - 1 - place) % SYMBOLS]
    return out


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-grams that hold a letter, the text of each, and each text's number of letters.

    A run of anything but letters counts as one gap, and a gap stands before and after each text.
    """
    texts = [(x or "").lower() for x in texts]
    joined = "\n\n".join(["", *texts, ""])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    symbols = _symbols()[points]
    sizes = np.array([len(x) for x in texts], np.int64)
    text = np.repeat(np.arange(len(texts) + 1), np.concatenate(([2], sizes + 2)))[:len(symbols)]
    letters = np.bincount(text[symbols > 0] - 1, minlength=len(texts)) if len(texts) else np.zeros(0, np.int64)
    kept = np.ones(len(symbols), bool)
    kept[1:] = (symbols[1:] > 0) | (symbols[:-1] > 0)
    s, text = symbols[kept].astype(np.int32), text[kept]
    n = max(0, len(s) - GRAM + 1)
    code = np.zeros(n, np.int32)
    for place in range(GRAM):
        code = code * SYMBOLS + s[place:place + n]
    middle = s[GRAM // 2:GRAM // 2 + n] > 0
    return code[middle], text[GRAM // 2:GRAM // 2 + n][middle] - 1, letters


def bundle(codes: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Sums of the vectors of each text's n-grams, ``n`` texts."""
    out = np.zeros((n, DIMENSIONS), np.float32)
    for a in range(0, n, _AT_ONCE):
        b = min(n, a + _AT_ONCE)
        lo, hi = np.searchsorted(text, (a, b))
        seen = np.bincount(codes[lo:hi], minlength=SYMBOLS ** GRAM) > 0
        some = np.flatnonzero(seen)
        place = np.cumsum(seen) - 1
        counts = np.bincount((text[lo:hi] - a) * len(some) + place[codes[lo:hi]], minlength=(b - a) * len(some))
        if len(some):
            out[a:b] = counts.reshape(b - a, -1).astype(np.float32) @ gram_vectors(some)
    return out


def _text_slices(column: pa.Array) -> Iterator[list[str | None]]:
    for part, _ in ta.slices(pa.record_batch({"text": column})):
        yield part.column("text").to_pylist()


def profiles(docs: DataFrame, lang_column: str = "lang", id_column: str = "doc_id",
             text_column: str = "text") -> Profiles:
    """Bundle the n-grams of all texts with a language that are not held out.

    Tasks count n-grams by language, bundle the counts, and send one vector per
    language; these are summed in Spark.  Languages times dimensions numbers reach
    the driver.  A profile is the mean of its n-grams less the mean of all
    languages' profiles, if there are several.
    """
    size = SYMBOLS ** GRAM

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for lang in dict.fromkeys(langs):
                rows = pa.array(np.flatnonzero(langs == lang))
                total = counts.setdefault(lang, np.zeros(size, np.int64))
                for some in _text_slices(batch.column("text").take(rows)):
                    total += np.bincount(grams(some)[0], minlength=size)
        for lang, total in counts.items():
            used = np.flatnonzero(total)
            vector = np.zeros(DIMENSIONS)
            for a in range(0, len(used), 4096):
                some = used[a:a + 4096]
                vector += total[some].astype(np.float64) @ gram_vectors(some).astype(np.float64)
            yield pa.record_batch({"lang": pa.array([lang] * DIMENSIONS), "dimension": pa.array(range(DIMENSIONS), pa.int32()),
                                   "value": pa.array(vector.astype(np.int64)),
                                   "n": pa.array([int(total.sum())] * DIMENSIONS, pa.int64())})

    used = docs.filter(F.col(lang_column).isNotNull() & (remainder(id_column, HELD_OUT) != 0)).select(
        F.col(lang_column).cast("string").alias("lang"), text_or_empty(text_column).alias("text"))
    sums = used.mapInArrow(partial, "lang string, dimension int, value long, n long").groupBy(
        "lang", "dimension").agg(F.sum("value").alias("value"), F.sum("n").alias("n"))
    rows = sums.filter("n > 0").groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("dimension", "value"))).alias("v"), F.max("n").alias("n")).orderBy("lang").collect()
    names = [r.lang for r in rows]
    means = np.array([[x.value / r.n for x in r.v] for r in rows]).reshape(len(names), DIMENSIONS)
    if len(names) > 1:
        means = means - means.mean(axis=0)
    return Profiles(names, means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-12))


RESULT = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])


def with_language(docs: DataFrame, found: Profiles, text_column: str = "text", name: str = "lang_pred",
                  score: str = "score") -> DataFrame:
    """Adds the language and the cosine with its profile, as 0 to 1 (negative ones are 0).

    A text that is null or has no letter is ``und`` with score 0, and so is every
    text if no language was learned.  Ties go to the first name in order.
    """
    sent = docs.sparkSession.sparkContext.broadcast(tuple(found))

    def predict(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        p = Profiles(*sent.value)
        for array in arrays:
            langs, scores = [], []
            for some in _text_slices(array):
                codes, text, letters = grams(some)
                v = bundle(codes, text, len(some))
                known = (letters > 0) & bool(p.names)
                if p.names:
                    cosine = v @ p.vectors.T.astype(np.float32) / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
                    best = cosine.argmax(axis=1)
                    score = np.where(known, cosine[np.arange(len(best)), best].clip(0, 1), 0.0)
                    langs += [p.names[i] if k else UNKNOWN for i, k in zip(best, known, strict=True)]
                    scores += score.tolist()
                else:
                    langs += [UNKNOWN] * len(some)
                    scores += [0.0] * len(some)
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             ["lang", "score"])

    udf = F.arrow_udf(predict, RESULT, ArrowUDFType.SCALAR_ITER)
    return docs.withColumn("__language", udf(text_or_empty(text_column))).withColumns(
        {name: F.col("__language.lang"), score: F.col("__language.score")}).drop("__language")
