from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from courtline.llm.common import labelled_sample, look_up, shared_folder


@pytest.mark.parametrize("weight", ["n", None])
def test_look_up_is_a_left_join(spark, weight):
    rows = spark.createDataFrame([(i, None if i % 10 == 9 else i % 7) for i in range(500)], "i long, `k.x` long").withColumn("k", F.col("`k.x`"))
    known = [k for k in range(7) if weight or k not in (2, 5)]
    table = spark.createDataFrame([(k, f"v{k}", 500 // 7) for k in known], "k long, v string, n long")
    got = look_up(rows, table, "k", ["v"], weight, 500, F.col("i"))
    assert got.columns == ["i", "k.x", "k", "v"]
    assert sorted(((r.i, r.k, r.v) for r in got.collect()), key=str) == sorted(
        ((i, k, f"v{k}" if k in known else None) for i in range(500) for k in [None if i % 10 == 9 else i % 7]), key=str)


def test_a_hot_key_that_the_table_lacks_spreads_over_all_tasks(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    for k, v in zip(before, ("false", "-1", "16"), strict=True):
        spark.conf.set(k, v)
    try:
        rows = spark.range(20_000).select("id", F.lit("the _").alias("k"))
        table = spark.createDataFrame([("other", 1)], "k string, v int")
        got = look_up(rows, table, "k", ["v"], None, 20_000, F.col("id"))
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 16 and max(sizes) < 3000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["toxic", "quality"])
def test_the_sample_is_bounded_in_rows(docs, labels, name):
    rows = [(i, f"text {i} {k}") for i in (1, 2, 3, 4) for k in range(500)] + [(None, "x"), (6, None)]
    marked = labels([(i, i % 2, i % 2) for i in range(8)] + [(1, 1, 1), (None, 1, 1)])
    for most in (2, 100):
        got = labelled_sample(docs(rows), marked, name, 5, most).collect()
        assert len(got) <= most and len({r.order for r in got}) == len(got)
    again = labelled_sample(docs(rows[::-1]), marked, name, 5, 100).collect()
    assert sorted(got) == sorted(again) and len(got) >= 4


def test_a_cluster_without_a_shared_folder_is_an_error(spark):
    def session(master, **conf):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)))

    shared = {"spark.checkpoint.dir": "hdfs://shared/x", "spark.sql.warehouse.dir": "/w/"}
    assert shared_folder(session("yarn", **shared)) == "hdfs://shared/x"
    assert shared_folder(session("local[8]", **{"spark.sql.warehouse.dir": "/w/"})) == "/w/intermediate"
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://x:1"):
        with pytest.raises(ValueError):
            shared_folder(session(master, **{"spark.sql.warehouse.dir": "/w/"}))
