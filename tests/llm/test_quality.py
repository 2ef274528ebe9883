import random
import zlib

import numpy as np
import pyarrow as pa

from courtline.llm import quality
from courtline.llm import text_arrays as ta
from courtline.llm.quality import BLOCK, FILTERS, WIDTH, Network, Training


def network(seed=1):
    rng = np.random.default_rng(seed)
    return Network(rng.normal(0, 1, (WIDTH, 256, FILTERS)).astype(np.float32), rng.normal(0, 1, FILTERS).astype(np.float32),
                   rng.normal(0, 1, 2 * FILTERS).astype(np.float32), np.array([0.1], np.float32))


def brute(text, net):
    data = (text or "").encode()
    blocks = -(-(len(data) + WIDTH - 1) // BLOCK)
    padded = data + bytes(blocks * BLOCK + WIDTH - len(data))
    response = np.array([sum(net.filters[k][padded[i + k]] for k in range(WIDTH)) for i in range(blocks * BLOCK)])
    response[blocks * BLOCK - WIDTH + 1:] = -np.inf
    best = response.reshape(blocks, BLOCK, FILTERS).max(axis=1)
    chunks = np.maximum(best[:-1], best[1:]) if blocks > 1 else best
    chunks = np.maximum(chunks + net.offset, 0)
    logit = np.concatenate([chunks.mean(axis=0), chunks.max(axis=0)]) @ net.output + net.bias[0]
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


TEXTS = ["", None, "short", "é" * 400, "x" * (BLOCK - WIDTH + 1), "x" * (BLOCK - WIDTH + 2), "The quick fox. " * 90]


def test_probabilities_against_plain_loops():
    net = network()
    got = quality.probabilities(ta.texts(pa.array(TEXTS)), net)
    assert np.allclose(got, [brute(x, net) for x in TEXTS], atol=1e-4)


def test_the_end_of_a_long_text_counts():
    net = network()
    a, b = quality.probabilities(ta.texts(pa.array(["ab " * 50_000, "ab " * 50_000 + "\x01\x02\x03" * 90])), net)
    assert a != b


def test_gradient_against_differences():
    net = Network(*(a.astype(np.float64) for a in network(3)))
    net = net._replace(output=net.output * 0.05)  # no probability near 0 or 1
    t, y = ta.texts(pa.array(TEXTS)), np.array([0, 1, 1, 0, 1, 0, 1], np.float32)

    def loss(n):
        p = quality.probabilities(t, n)
        return float(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))

    g = quality._gradient(t, y, net)
    for part, places in ((0, [(0, ord("x"), 2), (3, ord("u"), 5), (1, 0xA9, 0)]), (1, [(0,), (7,)]), (2, [(3,), (20,)]), (3, [(0,)])):
        for place in places:
            up, down = [a.copy() for a in net], [a.copy() for a in net]
            up[part][place] += 1e-2
            down[part][place] -= 1e-2
            slope = (loss(Network(*up)) - loss(Network(*down))) / 2e-2
            assert abs(slope - g[part][place]) < 0.02 + 0.1 * abs(slope)


def corpus(n=400):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        words = [rng.choice(["the", "of", "river", "stone", "walks", "and"]) for _ in range(rng.randrange(20, 80))]
        good = i % 3 > 0
        rows.append((i, " ".join(words) if good else " | ".join(w.upper() + "!!" for w in words), int(good)))
    return rows


def test_held_out_accuracy_and_no_leak(docs, labels):
    rows = corpus()
    d = docs([r[:2] for r in rows])
    net = quality.train(d, labels([(i, q, 0) for i, _, q in rows]), Training(epochs=4))
    scored = {r.doc_id: r.score for r in quality.with_score(d, net).collect()}
    held = [(i, q) for i, _, q in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all((scored[i] >= 0.3) == bool(q) for i, q in held) and len(held) > 50
    other = quality.train(d, labels([(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, 0) for i, _, q in rows]), Training(epochs=4))
    assert all((a == b).all() for a, b in zip(net, other, strict=True))


def test_edge_rows(docs, labels):
    rows = [(1, None), (2, ""), (None, "x"), (1, "y " * 70_000), (1, "y")]
    net = quality.train(docs(rows), labels([(1, None, 0), (None, 1, 0)]))
    scores = {(r.doc_id, r.n_chars): r.score for r in quality.with_score(docs(rows), net).collect()}
    assert len(scores) == 5 and all(0 <= s <= 1 for s in scores.values())
    assert scores[1, None] == scores[2, 0]
    assert quality.with_score(docs([]), net).collect() == []
