import random
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from courtline.llm import packing
from courtline.llm.packing import best_fit, cuts, dominating, encoder, encoding, pack, pieces, plan

PATH = public_tokenizers.path("byte_bpe_50k.json")


def histogram(lengths, capacity):
    return np.bincount(lengths, minlength=capacity + 1)


def optimum(lengths, capacity):
    """Fewest bins by exhaustive search with memory; small cases only."""
    lengths = tuple(sorted(lengths, reverse=True))
    best = [len(lengths)]

    def place(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(rooms)
            return
        for i in range(len(rooms)):
            if rooms[i] >= lengths[k] and rooms[i] not in rooms[:i]:
                place(k + 1, [*rooms[:i], rooms[i] - lengths[k], *rooms[i + 1:]])
        place(k + 1, [*rooms, capacity - lengths[k]])

    place(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(40))
def test_fixed_sets_lose_no_optimum(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 10, 13, 20])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
    counts = histogram(lengths, capacity)
    fixed = dominating(counts, capacity)
    rest = [n for n in range(capacity + 1) for _ in range(counts[n])]
    assert sum(p.times for p in fixed) + optimum(rest, capacity) == optimum(lengths, capacity)


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_gapless_and_complete(seed):
    rng = random.Random(seed)
    capacity = rng.choice([9, 50, 300])
    lengths = [min(rng.randint(1, capacity), rng.randint(1, capacity)) for _ in range(rng.randint(1, 900))]
    counts = histogram(lengths, capacity)
    p = plan(counts, capacity)
    after = np.append(p["rank"][1:], 0)
    last = np.append(p["length"][1:] != p["length"][:-1], True)
    ends = np.where(last, counts[p["length"]], after)
    filled = {}
    for n, rank, copies, sequence, offset, end in zip(*(p[c] for c in ("length", "rank", "copies", "sequence", "offset")), ends, strict=True):
        for r in range(end - rank):
            filled.setdefault(sequence + r // copies, []).append((offset + r % copies * n, n))
    assert sum(len(x) for x in filled.values()) == len(lengths) and sorted(filled) == list(range(len(filled)))
    for places in filled.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= capacity
    assert len(filled) <= 1.25 * max(-(-sum(lengths) // capacity), 1) + 1


def test_best_fit_takes_the_tightest_room():
    counts = histogram([6, 5, 4, 3], 10)
    assert sorted((p.content, p.times) for p in best_fit(counts, 10)) == [(((5, 1), (3, 1)), 1), (((6, 1), (4, 1)), 1)]


def test_the_plan_does_not_grow_with_the_documents():
    counts = np.zeros(2049, np.int64)
    counts[[1500, 500]] = 10**9
    began = time.time()
    assert len(plan(counts)["length"]) < 100 and time.time() - began < 1


@pytest.mark.parametrize("seed", range(20))
def test_many_sets_at_once_are_those_of_one_at_a_time(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 20])
    lengths = [rng.choice([rng.randint(1, capacity), capacity * 3 // 4, capacity // 4]) for _ in range(60)]

    def one_at_a_time(counts):
        """The same rules, a single set in each step."""
        while True:
            for large in [int(x) for x in np.flatnonzero(counts)[::-1]]:
                counts[large] -= 1
                beside = [int(x) for x in np.flatnonzero(counts[:capacity - large + 1])]
                items = [x for x in np.flatnonzero(counts) for _ in range(counts[x])][:2]
                if not beside:
                    yield (large,)
                    break
                if beside[-1] == capacity - large or len(items) < 2 or sum(items) > capacity - large:
                    counts[beside[-1]] -= 1
                    yield (large, beside[-1])
                    break
                counts[large] += 1
            else:
                return

    a, b = histogram(lengths, capacity), histogram(lengths, capacity)
    single = Counter(one_at_a_time(a))
    many = Counter()
    for p in dominating(b, capacity):
        many[tuple(n for n, copies in p.content for _ in range(copies))] += p.times
    assert many == single and (a == b).all()


def test_cuts():
    assert cuts(5, 4) == [(0, 1), (1, 4)] and cuts(8, 4) == [(0, 4), (4, 4)] and cuts(4, 4) == [(0, 4)] and cuts(1, 4) == [(0, 1)]


def test_ids_are_those_of_the_tokenizers_library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    rng = random.Random(1)
    texts = ["", " ", "a\n\n b", "don't  stop", "é ñ ß 漢字 🙂", "x" * 500, "<|endoftext|>", "\x00\x7f\t\r\n", "1234 56.7%"]
    texts += ["".join(chr(rng.choice([32, 10, 97, 233, 0x4E00, 0x1F600, 39, 115, 48])) for _ in range(60)) for _ in range(200)]
    assert [encoding(PATH).encode_ordinary(x) for x in texts] == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_added_tokens_and_long_white_space_as_by_the_tokenizers_library(docs):
    tokenizer = Tokenizer.from_file(PATH)
    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "<|endoftext", "x\n <|endoftext|>\n y", "\n" * 1_000_000 + "a",
             "a" + " " * 1_000_000 + "b", " \u3000" * 9_000 + "c", " " * 9_999 + "d", "\x1c\x1f\x85" * 5_000 + "e", "\u200b" * 20_000 + "f"]
    encode = encoder(PATH)
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [encode(x) for x in texts] == want and len(want[0]) == 4
    got = {(r.id, r.piece): r.ids_crc32 for r in pieces(docs(list(enumerate(texts))), PATH).collect()}
    assert got == {(i, k): zlib.crc32(np.array([*ids, 0][a:a + n], "<u4").tobytes())
                   for i, ids in enumerate(want) for k, (a, n) in enumerate(cuts(len(ids) + 1))}


def test_pieces_and_places(docs):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["one", "Zwei", "trois", "ñu"]) for _ in range(rng.randrange(0, 200)))) for i in range(200)]
    rows += [(200, None), (201, ""), (202, "long text " * 4000), (None, "a"), (7, "again"), (7, "again")]
    tokenizer = Tokenizer.from_file(PATH)
    want = []
    for i, x in rows:
        ids = [*tokenizer.encode(x or "", add_special_tokens=False).ids, 0]
        for k, (a, n) in enumerate(cuts(len(ids), 256)):
            want.append((i, k, a, n, zlib.crc32(np.array(ids[a:a + n], "<u4").tobytes())))
    cut = pieces(docs(rows), PATH, 256, keep_ids=True)
    got = pack(cut, 256).collect()
    assert sorted(((r.id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in got)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= 256
    tokens = sum(w[3] for w in want)
    assert len(by_sequence) <= -(-tokens // 256) + 2


def test_ranks_do_not_depend_on_the_buckets(docs, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_TOGETHER", 10)
    got = pack(pieces(docs([(i, "same") for i in range(300)]), PATH, 16), 16).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == 300


def test_empty_table(docs):
    assert pack(pieces(docs([]), PATH)).collect() == []
