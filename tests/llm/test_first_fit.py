import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from courtline.llm import first_fit
from courtline.llm.first_fit import first_fit_decreasing, pack, pieces

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("seed", range(30))
def test_tournament_against_a_scan_of_all_bins(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 50, 1024])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 400))]
    rooms, want = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = next((b for b, room in enumerate(rooms) if room >= lengths[i]), len(rooms))
        if at == len(rooms):
            rooms.append(capacity)
        want[i] = (at, capacity - rooms[at])
        rooms[at] -= lengths[i]
    bins, offsets = first_fit_decreasing(np.array(lengths), capacity)
    assert {i: (int(b), int(o)) for i, (b, o) in enumerate(zip(bins, offsets, strict=True))} == want


def check(got, want, capacity):
    assert sorted(((r.id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got), key=str) == sorted(want, key=str)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= capacity
    return by_sequence


def expected(rows, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    for i, x in rows:
        ids = [*tokenizer.encode(x or "", add_special_tokens=False).ids, 0]
        for a in range(0, len(ids), capacity):
            part = np.array(ids[a:a + capacity], "<u4")
            yield i, a, len(part), zlib.crc32(part.tobytes()), len(ids)


@pytest.mark.parametrize("group_pieces", [20_000, 40])
def test_pieces_and_places(docs, group_pieces):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["one", "Zwei", "trois", "ñu"]) for _ in range(rng.randrange(0, 200)))) for i in range(300)]
    rows += [(300, None), (301, ""), (302, "long text " * 40_000), (303, "a <|endoftext|> b"), (None, "a"), (None, "a"), (7, "again"), (7, "again")]
    cut = pieces(docs(rows), PATH, 256, keep_ids=True)
    got = pack(cut, 256, group_pieces).collect()
    want = list(expected(rows, 256))
    by_sequence = check(got, want, 256)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in got)
    tokens = sum(w[2] for w in want)
    if group_pieces == 20_000:
        assert len(by_sequence) <= 1.02 * tokens / 256 + 1
    else:
        assert len({r.sequence_id >> 32 for r in got}) > 10


def test_rows_that_repeat_crowd_no_group(docs):
    got = pack(pieces(docs([(1, "same")] * 1000), PATH, 16), 16, 50).collect()
    groups = {}
    for r in got:
        groups[r.sequence_id >> 32] = groups.get(r.sequence_id >> 32, 0) + 1
    assert len(got) == 1000 and len(groups) == 20 and max(groups.values()) < 100


def test_clashing_names_and_an_empty_table(docs):
    clash = docs([(1, "a b")]).withColumns({"sequence_id": F.lit(5), "id": F.lit("x"), "a.b": F.lit(1), "__lot": F.lit(0)})
    [row] = pack(pieces(clash, PATH)).collect()
    assert (row.id, row.start, row.length, row.doc_tokens, row.offset) == (1, 0, 3, 3, 0)
    assert pack(pieces(docs([]), PATH)).collect() == []


def test_the_query_over_whole_texts(spark):
    from courtline.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = QUERIES["op11_packing"](spark, folder)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    by_sequence = check(got.withColumnRenamed("doc_id", "id").collect(), list(expected(rows, first_fit.CAPACITY)), first_fit.CAPACITY)
    used = [sum(n for _, n in places) for places in by_sequence.values()]
    assert sum(first_fit.CAPACITY - n for n in used if n & (n - 1)) < 0.02 * sum(used)
