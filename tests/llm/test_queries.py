"""Registered queries against their SQL, and the pipeline's stages one by one."""

import os
import re
import zlib

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from courtline.llm.oracle import oracle_sql
from courtline.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "labels", "pages", "embeddings"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    assert sorted(columns) == sorted(result.columns)
    assert sorted(repr(tuple(r[c] for c in columns)) for r in result.collect()) == sorted(map(repr, expected.fetchall()))


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in names if re.match(r"op\d+_", n)} == {f"op{k}" for k in range(1, 14)} and "pipeline" in names


def test_base_figures_of_the_language_model(spark, duck):
    training = [x for i, x in duck.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall()
                if zlib.crc32(str(i).encode()) % 7 != 2]
    total = sum(len(x.split()) + 1 for x in training)
    rows = QUERIES["op1_context_tree"](spark, SF_DIR).collect()
    assert {r.train_tokens for r in rows} == {total}
    held = [r for r in rows if r.held_out]
    assert held and all(r.score < 0 and r.n_known <= r.n_tokens for r in rows)


def test_pipeline_stages(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stage(spark, docs, SF_DIR).cache()
        after = {r.doc_id for r in docs.collect()}
        seen.append(name)
        assert after <= set(before)
        if name == "toxicity":
            assert sum(labels.get(i) == 0 for i in set(before) - after) <= 1
        if name == "exact_dedup":
            best = {}
            for i, x in before.items():
                best[x] = max(i, best.get(x, i))
            assert after == set(best.values())
        if name == "packing":
            assert after == set(before) and "sequence_id" in docs.columns
        else:
            assert docs.columns == columns
    assert seen == ["toxicity", "exact_dedup", "simhash_near_dedup", "decontamination", "packing"]
    assert corpus_pipeline.run(spark, SF_DIR).count() == docs.count()
