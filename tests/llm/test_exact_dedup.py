import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from courtline.llm import exact_dedup
from courtline.llm.exact_dedup import copies, drop_copies

ROWS = [(1, "a"), (2, "a"), (3, "b"), (4, None), (5, ""), (6, "c " * 70_000), (7, "c " * 70_000), (8, "A"), (None, "n"), (None, "d"), (9, "d")]


def brute(rows):
    groups = defaultdict(list)
    for i, x in rows:
        groups[x or ""].append(i)
    best = {x: max((i for i in ids if i is not None), default=None) for x, ids in groups.items()}
    return {(i, hashlib.sha256((x or "").encode()).hexdigest(), best[x or ""], len(groups[x or ""])) for i, x in rows}


def found(df):
    return {(r.doc_id, r.d, r.keep_id, r.group_size) for r in df.withColumn("d", F.lower(F.hex("digest"))).collect()}


def test_against_brute_force(docs):
    assert found(copies(docs(ROWS))) == brute(ROWS)


def test_many_rows_with_a_hot_text(docs):
    rows = [(i, "hot" if i % 3 == 0 else f"text {i // 4}") for i in range(3000)]
    assert found(copies(docs(rows))) == brute(rows)


def test_a_crowded_filter_gives_the_same_by_the_same_plan(docs, monkeypatch):
    rows = [(i, f"text {i // 2}" if i < 400 else f"alone {i}") for i in range(1200)]
    roomy = copies(docs(rows))
    monkeypatch.setattr(exact_dedup, "BROADCAST_BYTES", 2 * exact_dedup.WORD_BYTES)
    crowded = copies(docs(rows))
    assert found(crowded) == found(roomy) == brute(rows)

    def joins(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("Join LeftOuter"), plan.count("strategy=broadcast")

    assert joins(crowded) == joins(roomy)


def test_rows_that_set_bits_alone_are_not_shuffled(docs):
    plan = copies(docs([(i, str(i)) for i in range(50)]).select("doc_id", "text"))._jdf.queryExecution().toString()
    assert "Union" in plan and "Python" not in plan and "Arrow" not in plan


def test_drop_keeps_the_largest_id_and_all_columns(docs):
    assert found(copies(docs(ROWS).withColumn("a.b", F.lit(1)))) == brute(ROWS)
    kept = drop_copies(docs(ROWS).withColumns({"digest": F.lit("x"), "kept": F.lit(1), "id": F.lit(2), "row": F.lit(3)}))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "digest", "kept", "id", "row"]
    rows = kept.collect()
    assert sorted((r.doc_id for r in rows), key=str) == sorted([2, 3, 5, 7, 8, None, 9], key=str)
    assert {r.digest for r in rows} == {"x"} and {r.kept for r in rows} == {1}


def test_rows_that_repeat_entirely_leave_one(docs):
    assert [(r.doc_id, r.text) for r in drop_copies(docs([(1, "a"), (1, "a"), (1, "a")])).collect()] == [(1, "a")]


def test_empty_table(docs):
    assert copies(docs([])).collect() == [] and drop_copies(docs([])).collect() == []
