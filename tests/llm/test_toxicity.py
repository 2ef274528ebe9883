import random
import zlib

import numpy as np
import pyarrow as pa

from courtline.llm import text_arrays as ta
from courtline.llm import toxicity
from courtline.llm.toxicity import BITS, Model, Training

BAD = ("vile", "brute", "wretch")


def corpus(n=600, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(BAD).upper() + rng.choice(("!", "", "."))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_word_helpers_follow_plain_python():
    texts = ["Ab c", "d", "", None, "  ", "é x\tyy\nz", "q"]
    t = ta.texts(pa.array(texts))
    w = ta.words(t)
    got = [[bytes(t.data[w.start[k]:w.end[k]]).decode() for k in range(a, b)] for a, b in zip(w.bounds[:-1], w.bounds[1:], strict=True)]
    assert got == [(x or "").split() for x in texts]
    h = ta.word_hashes(t.data, w)
    again = ta.texts(pa.array(["x x q", "q"]))
    g = ta.word_hashes(again.data, ta.words(again))
    assert g[0] == g[1] == h[4] and g[2] == g[3] == h[7] and len(set(h)) == len(h)
    batch = pa.record_batch({"text": pa.array(texts * 3)})
    assert sum(len(part) for part, _ in ta.slices(batch, most=4)) == len(texts) * 3


def test_features_are_distinct_and_ignore_case_and_repeats():
    f, starts = toxicity.features(ta.texts(pa.array(["One two", "ONE, two!", "one two one two", ""])))
    rows = [set(f[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]
    assert rows[0] == rows[1] and rows[0] < rows[2] and rows[3] == set()
    assert len(f) == sum(map(len, rows))


def test_ftrl_is_sparse_and_follows_the_update_rule():
    x, y = np.array([3], np.int32), np.array([3, 9], np.int32)
    s = Training(epochs=1, alpha=0.5, beta=1.0, l1=0.1, l2=1.0)
    model = toxicity.ftrl([(1, x), (0, y)], s)
    bias, bias_n = float(np.log(0.375 / 0.625)), 1.0  # (1 + 0.5) of (2 + 2) rows
    z, n = {3: 0.0, 9: 0.0}, {3: 0.0, 9: 0.0}
    for label, row in ((1, [3]), (0, [3, 9])):
        w = {c: 0.0 if abs(z[c]) <= 0.1 else (np.sign(z[c]) * 0.1 - z[c]) / ((1 + n[c] ** 0.5) / 0.5 + 1) for c in row}
        g = 1 / (1 + np.exp(-sum(w.values()) - bias)) - label
        for c in row:
            z[c] += g - ((n[c] + g * g) ** 0.5 - n[c] ** 0.5) / 0.5 * w[c]
            n[c] += g * g
        bias_n += g * g
        bias -= 0.5 / (1 + bias_n ** 0.5) * g
    want = {c: (np.sign(z[c]) * 0.1 - z[c]) / ((1 + n[c] ** 0.5) / 0.5 + 1) for c in z if abs(z[c]) > 0.1}
    assert dict(zip(model.coordinates.tolist(), model.weights.tolist(), strict=True)) == {c: float(np.float32(v)) for c, v in want.items()}
    assert abs(model.bias - bias) < 1e-12


def test_held_out_rows_are_found_and_clean_ones_left(docs, labels):
    rows = corpus()
    model = toxicity.train(docs([r[:2] for r in rows]), labels([(i, 1, t) for i, _, t in rows]), Training(epochs=8))
    assert 0 < len(model.coordinates) < 2000
    scored = {r.doc_id: r.score for r in toxicity.with_score(docs([r[:2] for r in rows]), model).collect()}
    held = [(i, t) for i, _, t in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((scored[i] >= 0.5) != bool(t) for i, t in held) <= 2 and len(held) > 80


def test_labels_of_held_out_rows_do_not_matter(docs, labels):
    rows = corpus(200)
    d = docs([r[:2] for r in rows])
    a = toxicity.train(d, labels([(i, 1, t) for i, _, t in rows]))
    b = toxicity.train(d, labels([(i, 0, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, _, t in rows]))
    assert (a.coordinates == b.coordinates).all() and (a.weights == b.weights).all() and a.bias == b.bias


def test_null_empty_long_and_unlabelled(docs, labels):
    model = Model(np.array([], np.int32), np.array([], np.float32), -1.0)
    rows = [(1, None), (2, ""), (3, "x " * 80_000), (None, "a"), (1, "b")]
    scores = [r.score for r in toxicity.with_score(docs(rows), model).collect()]
    assert np.allclose(scores, 1 / (1 + np.e))
    untrained = toxicity.train(docs(rows), labels([(1, 1, None), (None, 1, 1)]))
    assert untrained.coordinates.size == 0 and abs(1 / (1 + np.exp(-untrained.bias)) - 0.25) < 1e-9
    assert toxicity.with_score(docs([]), model).collect() == []


def test_reject_keeps_columns_and_clean_rows(docs, labels):
    rows = corpus(300)
    d = docs([r[:2] for r in rows]).withColumnRenamed("lang", "score").withColumnRenamed("source", "row")
    kept = toxicity.reject_toxic(d, labels([(i, 1, t) for i, _, t in rows]), settings=Training(epochs=8))
    assert kept.columns == d.columns
    left = {r.doc_id for r in kept.collect()}
    assert {i for i, _, t in rows if not t} <= left and len(left) <= sum(not t for *_, t in rows) + 4


def test_coordinates_stay_in_range():
    f, _ = toxicity.features(ta.texts(pa.array(["some words of a text"])))
    assert f.min() >= 0 and f.max() < 2**BITS
