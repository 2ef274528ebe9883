"""Session set-up shared by jobs, tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.driver.memory": "4g",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


PARTITION_BYTES = 256 * 1024 * 1024
MAX_PARTITIONS = 100_000


def initial_partitions(shuffle_bytes: int) -> int:
    """Shuffle partitions for a shuffle of this size, before adaptive merging."""
    return max(200, min(MAX_PARTITIONS, -(-shuffle_bytes // PARTITION_BYTES)))


def build_session(app_name: str = "courtline", master: str | None = None,
                  conf: dict[str, str] | None = None, shuffle_bytes: int | None = None) -> SparkSession:
    """Session with adaptive execution on; ``conf`` overrides any default.

    The master is left to spark-submit unless given.  ``shuffle_bytes``, the size
    of the largest expected shuffle, sets how many partitions it starts with:
    adaptive execution merges small ones but splits large ones only in joins.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    sized = {}
    if shuffle_bytes is not None:
        sized["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(initial_partitions(shuffle_bytes))
    for key, value in {**DEFAULTS, **sized, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark
