import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from courtline.llm import simhash
from courtline.llm import text_arrays as ta
from courtline.llm.components import components


def shingles(text, width):
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = [w for w in re.split(rb"[\x20\x09-\x0d]+", data) if w]
    if len(words) < width:
        return [b" ".join(words)] if words else []
    return [b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)]


def brute_fingerprint(text, width=4, seed=42):
    hashes = [xxhash.xxh64_intdigest(s, seed) for s in shingles(text, width)]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_components(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_texts(seed=1, groups=12):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 30, 200]))]
        for _ in range(rng.randrange(1, 6)):
            edited = list(words)
            if rng.random() < 0.7:
                edited[rng.randrange(len(edited))] = "edit"
            rows.append((len(rows), " ".join(edited)))
    return [*rows, (900, None), (901, ""), (902, " \t"), (903, "ONE Two"), (904, "one  two"), (905, "é ü ß ñ é")]


def test_fingerprints_against_brute_force():
    texts = [x for _, x in near_texts()] + ["a b c d " * 30_000]
    got = simhash.fingerprints(ta.texts(pa.array(texts)))
    assert [int(v) for v in got] == [brute_fingerprint(x) for x in texts]


@pytest.mark.parametrize("together", [4_000_000, 500])
def test_classes_against_brute_force(docs, monkeypatch, together):
    monkeypatch.setattr(simhash, "SORTED_TOGETHER", together)
    rows = near_texts()
    fp = {i: brute_fingerprint(x) for i, x in rows}
    edges = [(a, b) for a in fp for b in fp if (fp[a] ^ fp[b]).bit_count() <= 4]
    want = brute_components(fp, edges)
    got = {r.id: (r.fp % 2**64, r.least.id) for r in simhash.classes(docs(rows)).collect()}
    assert got == {i: (fp[i], want[i]) for i in fp}


def test_several_seeds_link_if_any_does(docs):
    rows = near_texts(5)
    seeds = (42, 7)
    fps = [{i: brute_fingerprint(x, 5, s) for i, x in rows} for s in seeds]
    edges = [(a, b) for fp in fps for a in fp for b in fp if (fp[a] ^ fp[b]).bit_count() <= 4]
    want = brute_components([i for i, _ in rows], edges)
    assert {r.id: r.least.id for r in simhash.classes(docs(rows), width=5, seeds=seeds).collect()} == want


def test_dense_ball_and_chain_of_fingerprints(spark):
    rng = random.Random(3)
    center = rng.getrandbits(63)
    ball = {center ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) for _ in range(300)}
    chain = [rng.getrandbits(63)]
    for k in range(12):
        chain.append(chain[-1] ^ 0b1111 << 4 * k)
    far = {rng.getrandbits(63) for _ in range(100)}
    fps = sorted({*ball, *chain, *far})
    found = simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long"), len(fps)).collect()
    edges = [(a, b) for a in fps for b in fps if (a ^ b).bit_count() <= 4]
    assert brute_components(fps, [(r.u, r.v) for r in found]) == brute_components(fps, edges)
    assert len(found) < 64 * len(fps)


def test_groups_of_the_shuffle_together_hold_every_variant_once():
    code = simhash.Code(6, 2)
    fp = np.array([0x0123456789ABCDEF], np.uint64)
    own = code.syndrome(fp)[0]
    made = np.concatenate([fp ^ code.masks[a:b] for a, b in zip(code.starts[:-1], code.starts[1:], strict=True)])
    assert len(np.unique(made)) == 1 + 64 + 64 * 63 // 2
    for k, s in enumerate(code.syndromes):
        assert (code.syndrome(fp ^ code.masks[code.starts[k]:code.starts[k + 1]]) == own ^ s).all()


def test_an_odd_radius_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 1, radius=3)


def test_drop_keeps_the_smallest_id_of_each_class(docs):
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(5, text), (3, text + " more"), (9, "something else entirely"), (None, text), (None, "alone here"), (7, None), (8, ""),
            (9, "something else entirely")]
    kept = simhash.drop_near_copies(docs(rows))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [3, 7, 9, None]


def test_the_pipelines_stage_against_brute_force(spark, docs):
    rows = near_texts(9, 30)
    fp = {i: brute_fingerprint(x) for i, x in rows}
    want = brute_components(fp, [(a, b) for a in fp for b in fp if (fp[a] ^ fp[b]).bit_count() <= 4])
    kept = corpus_pipeline.drop_near_copies(spark, docs(rows).withColumn("a.b", F.lit(1)), "")
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "a.b"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
    assert len(set(want.values())) < len(rows)


def test_empty_table(docs):
    assert simhash.classes(docs([])).collect() == [] and simhash.drop_near_copies(docs([])).collect() == []


def test_components_of_a_star_a_chain_and_loops(spark):
    edges = [(0, k) for k in range(1, 400)] + [(k, k + 1) for k in range(1000, 1040)] + [(5000, 5000), (7, 0), (2000, 1999)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    nodes = {n for e in edges for n in e if n != 5000}
    assert got == brute_components(nodes, [e for e in edges if 5000 not in e])
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
