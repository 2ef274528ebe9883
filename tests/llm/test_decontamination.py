import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from courtline.llm import decontamination
from courtline.llm.decontamination import Settings, align, contaminated, drop_contaminated

RNG = random.Random(6)
WORDS = [f"w{k}" for k in range(800)] + ["the", "of", "and"] * 60
ITEMS = [(k, " ".join(RNG.choice(WORDS) for _ in range(RNG.randrange(12, 50)))) for k in range(25)]


def brute_align(item, window, s):
    h = np.zeros((len(item) + 1, len(window) + 1))
    for i, a in enumerate(item):
        for j, b in enumerate(window):
            h[i + 1, j + 1] = max(0, h[i, j] + (1 if a == b else s.mismatch), h[i, j + 1] + s.gap, h[i + 1, j] + s.gap)
    return h.max()


def test_alignment_against_the_recurrence():
    rng = np.random.default_rng(0)
    pairs = [(rng.integers(2, 9, rng.integers(1, 30)).astype(np.uint64), rng.integers(2, 9, rng.integers(1, 60)).astype(np.uint64)) for _ in range(150)]
    s = Settings()
    assert np.allclose(align(pairs, s), [brute_align(a, b, s) for a, b in pairs], atol=1e-4)


def edited(words, rng, share):
    out = []
    for w in words:
        r = rng.random()
        if r < share / 3:
            out.append("changed")
        elif r < 2 * share / 3:
            out += [w, "added"]
        elif r >= share:
            out.append(w)
    return out


def corpus():
    rng = random.Random(7)
    rows, want = [], set()
    for i in range(160):
        words = [rng.choice(WORDS) for _ in range(rng.randrange(0, 300))]
        if i % 4 == 0:
            k, x = ITEMS[i % len(ITEMS)]
            at = rng.randrange(len(words) + 1)
            words[at:at] = edited(x.split(), rng, 0.0 if i % 8 else 0.25)
            want.add((i, k))
        rows.append((i, " ".join(words).upper() if i % 3 else ", ".join(words)))
    return rows, want


@pytest.fixture
def benchmark(spark):
    def make(items=ITEMS):
        return spark.createDataFrame(items, "item_id long, text string")
    return make


@pytest.mark.parametrize("block", [decontamination.BLOCK_BYTES, 900])
def test_copies_and_edited_copies_are_found_and_nothing_else(docs, benchmark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    rows, want = corpus()
    got = contaminated(docs(rows), benchmark())
    assert got.columns == ["doc_id", "item_id", "score", "start", "end"]
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want


def test_scores_are_those_of_the_whole_text(docs, benchmark):
    rows, _ = corpus()
    s = Settings()
    texts = dict(rows)
    import re
    def words(x):
        ids = {}
        return [w for w in re.findall(r"[a-z0-9]+", x.lower())], ids
    for r in contaminated(docs(rows), benchmark()).collect()[:12]:
        item, text = words(dict(ITEMS)[r.item_id])[0], words(texts[r.doc_id])[0]
        assert abs(r.score * len(item) - brute_align(item, text, s)) < 1e-3
        assert 0 <= r.start < r.end <= len(text)


def test_copies_of_an_item_do_not_take_its_seeds(docs, benchmark):
    words = ITEMS[3][1].split()
    cut = " ".join("other" if k % 4 == 3 else w for k, w in enumerate(words))
    rows = [(i, f"before {i} {cut} after {i}") for i in range(60)] + [(100, ITEMS[3][1])]
    assert {r.doc_id for r in contaminated(docs(rows), benchmark()).collect()} == {*range(60), 100}


def test_an_item_that_every_text_holds_still_has_seeds(docs, benchmark):
    rows = [(i, f"before {i} {ITEMS[3][1]} after {i}") for i in range(80)]
    assert {(r.doc_id, r.item_id) for r in contaminated(docs(rows), benchmark()).collect()} == {(i, 3) for i in range(80)}


def test_short_runs_in_common_are_no_copy(docs, benchmark):
    long_items = [(k, x) for k, x in ITEMS if len(x.split()) >= 30]
    rows = [(k, "other words here " + " ".join(x.split()[4:10]) + " and more of the same") for k, x in long_items]
    assert contaminated(docs(rows), benchmark()).collect() == []


def test_drop_keeps_clean_rows_and_columns(docs, benchmark):
    rows, want = corpus()
    d = docs([*rows, (900, None), (901, ""), (None, "clean"), (902, "long " * 60_000 + ITEMS[0][1])]).withColumnRenamed("lang", "matches")
    kept = drop_contaminated(d, benchmark())
    assert kept.columns == d.columns
    ids = [r.doc_id for r in kept.collect()]
    assert set(ids) == ({i for i, _ in rows} - {i for i, _ in want}) | {900, 901, None}


def test_odd_items_and_empty_tables(docs, benchmark):
    odd = benchmark([(1, None), (2, ""), (3, "two words"), (None, ITEMS[0][1]), (5, ITEMS[0][1]), (5, ITEMS[0][1])])
    got = contaminated(docs([(1, ITEMS[0][1]), (2, "two words")]), odd).collect()
    assert sorted(((r.doc_id, r.item_id, r.score) for r in got), key=str) == [(1, 5, 1.0), (1, None, 1.0), (2, 3, 1.0)]
    assert contaminated(docs([(1, "x y z")]), benchmark([])).collect() == []
    assert drop_contaminated(docs([]), benchmark()).collect() == []
    assert drop_contaminated(docs([(1, "x y z")]), benchmark([])).count() == 1


def test_every_item_aligned_with_every_text_gives_the_same_matches(docs, benchmark):
    rows, want = corpus()
    s = Settings()
    def hashes(x):
        return decontamination._word_hashes(decontamination.ta.texts(pa.array([x])))[0]
    items, texts = [(k, hashes(x)) for k, x in ITEMS], [(i, hashes(x)) for i, x in rows]
    pairs = [(i, k, item, text) for k, item in items for i, text in texts if len(text)]
    scores = align([(item, text) for _, _, item, text in pairs], s)
    brute = {(i, k): score / len(item) for (i, k, item, _), score in zip(pairs, scores, strict=True) if score >= s.min_score * len(item)}
    got = {(r.doc_id, r.item_id): r.score for r in contaminated(docs(rows), benchmark()).collect()}
    assert got.keys() == brute.keys() == want
    assert all(abs(got[p] - brute[p]) < 1e-3 for p in got)


CHINESE = "光合作用是植物将阳光转化为化学能的过程并放出氧气"
THAI = "การสังเคราะห์แสงเปลี่ยนพลังงานแสงเป็นพลังงานเคมี"


def test_copies_in_scripts_without_blanks(docs, benchmark):
    items = [(1, CHINESE), (2, THAI)]
    cut = CHINESE[:10] + "其他" + CHINESE[12:]
    rows = [(1, f"序言如此{CHINESE}然后结束"), (2, f"some words {cut}"), (3, f"ก่อน{THAI}หลัง"), (4, "今天天气很好我们去公园散步"),
            (5, "植物需要水"), (6, "plain words")]
    got = contaminated(docs(rows), benchmark(items)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 1), (2, 1), (3, 2)}


def test_words_of_mixed_scripts():
    def cut(x):
        t = decontamination.ta.texts(pa.array(x))
        w = decontamination._words(decontamination.ta.lower(t.data), t)
        return [[bytes(t.data[a:b]).decode() for a, b in zip(w.start[lo:hi], w.end[lo:hi], strict=True)]
                for lo, hi in zip(w.bounds[:-1], w.bounds[1:], strict=True)]
    assert cut(["ab漢字cd", "", "漢", "字x 한국어 말", "\U00020000é", "ไทย-a", "x"]) == [
        ["ab", "漢", "字", "cd"], [], ["漢"], ["字", "x", "한국어", "말"], ["\U00020000", "é"], ["ไ", "ท", "ย", "a"], ["x"]]


def test_items_shorter_than_a_seed(docs, benchmark):
    filler = [(100 + k, "the of and " * 40 + f"w{k}") for k in range(200)]
    items = [(1, "zygote quark"), (2, "of the"), (3, "solitary")]
    rows = [(1, "before Zygote Quark after"), (2, "quark zygote"), (3, "and of the and"), (4, "Of the"), (5, "a solitary word"),
            (6, "solitary!")]
    got = contaminated(docs(rows + filler), benchmark(items)).collect()
    assert {(r.doc_id, r.item_id) for r in got if r.doc_id < 100} == {(1, 1), (4, 2), (6, 3)}
    assert not [r for r in got if r.doc_id >= 100]


def test_one_counting_pass_for_any_number_of_blocks(spark, docs, benchmark, monkeypatch):
    rows, _ = corpus()
    passes = []
    counted = decontamination.frequencies
    monkeypatch.setattr(decontamination, "frequencies", lambda *a: passes.append(1) or counted(*a))
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 300)
    assert decontamination.item_table(benchmark())[1] > 5
    monkeypatch.setattr(decontamination, "_COUNTED_AT_ONCE", 50)
    found = contaminated(docs(rows), benchmark())
    assert passes == [1]
    items, _ = decontamination.item_table(benchmark())
    counts, total, n = counted(docs(rows), items)
    def words(x):
        return decontamination._word_hashes(decontamination.ta.texts(pa.array([x])))[0].view(np.int64).tolist()
    every = Counter(w for _, x in rows for w in words(x))
    assert (total, n) == (sum(every.values()), len(rows))
    own = {w for _, x in ITEMS for w in words(x)}
    assert {r.word: r.n for r in counts.collect()} == {w: every[w] for w in own if every[w]}
    assert found.count() == len(corpus()[1])
