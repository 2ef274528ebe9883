"""Tables that are written in versions and read only as far as they are committed.

A store is a folder of one or more tables, each divided into named parts, such as the
snapshots of a table of odds.  Every write of a part goes to a folder of its own
(``<table>/part=<name>/run=<id>``).  When all its files are there, the write is
committed: one small file of the manifest, which lies in the same folder, says which run
now is the part, and what it holds.  Readers take the manifest first and open no other
run.  So a write that replaces a part leaves nothing of the old one, whatever either
holds; a write that broke off is never read; several tables change at once; and readers
that have begun go on with the files they know.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spark's readers skip folders whose names begin so.
_MANIFEST = "_manifest"
_ENTRY = T.StructType([
    T.StructField("part", T.StringType()), T.StructField("version", T.LongType()), T.StructField("run", T.StringType()),
    T.StructField("table", T.StringType()), T.StructField("rows", T.LongType()),
    T.StructField("keys", T.MapType(T.StringType(), T.StringType()))])
# Names of parts are used in paths as they are.
_NAME = re.compile(r"[A-Za-z0-9_.-]+")
# Runs that a reader names one by one; more of them are matched by a join.
NAMED_RUNS = 1000
# Folders that a task of a write holds open at a time; the rows of any further ones it sorts by folder first.
OPEN_FOLDERS = 16
_OPEN_FOLDERS = "spark.sql.maxConcurrentOutputFileWriters"
ROWS = "rows"
_RETIRED = "retired"
_BETWEEN = "\x01"


class Written(NamedTuple):
    """One table of one run: how many rows it has, and further counts made on the way."""

    part: str
    run: str
    table: str
    rows: int
    groups: tuple[str, ...]
    counts: Mapping[str, object]


def path_value(value: Column) -> Column:
    """A text as the value of a partition, from which null and the empty text can be told apart."""
    return F.when(value.isNotNull(), F.concat(F.lit("="), value)).otherwise(F.lit("null"))


def _folder(path: str, table: str, part: str = "", run: str = "") -> str:
    inner = f"/part={part}/run={run}" if part else ""
    return f"{path.rstrip('/')}/{table}{inner}"


def manifest_path(path: str) -> str:
    return _folder(path, _MANIFEST)


def new_run() -> str:
    return uuid.uuid4().hex


@contextmanager
def _open_folders(spark: SparkSession) -> Iterator[None]:
    """Rows go to their folders as they come: else a task sorts all its rows first, which in memory are many times their shuffled bytes.

    A number that the session has set itself stays.
    """
    before = spark.conf.get(_OPEN_FOLDERS, None)
    if before is None:
        spark.conf.set(_OPEN_FOLDERS, OPEN_FOLDERS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_OPEN_FOLDERS)


def write(rows: DataFrame, path: str, part: str, run: str, table: str = ROWS, groups: Sequence[str] = (),
          counts: Mapping[str, Column] | None = None) -> Written:
    """Write one table of a run, its folders divided by the texts in ``groups``; not read by anyone until committed.

    The rows keep all their columns.  They are counted on the way, and so are the
    aggregates ``counts``.  No rows, no files.
    """
    if not _NAME.fullmatch(part):
        raise ValueError(f"{part!r} is no name of a part: letters, digits, '_', '-' and '.' only")
    observed = Observation()
    placed = rows.withColumns({"part": F.lit(part), "run": F.lit(run)} | {f"{g}_key": path_value(F.col(g)) for g in groups})
    # Files of even size: a group with most of the rows is split over several.  Counted after that
    # shuffle, so that work that is done again for lost map output is not counted again.
    placed = placed.hint("rebalance", *groups).observe(
        observed, F.count(F.lit(1)).alias(ROWS), *(c.alias(n) for n, c in (counts or {}).items()))
    with _open_folders(rows.sparkSession):
        placed.write.mode("append").partitionBy("part", "run", *(f"{g}_key" for g in groups)).parquet(_folder(path, table))
    found = dict(observed.get)
    return Written(part, run, table, found.pop(ROWS), tuple(groups), found)


def commit(spark: SparkSession, path: str, written: Sequence[Written], retired: Sequence[str] = ()) -> None:
    """Make tables of one run the new version of their part, and end the parts ``retired``, all at once.

    Without any row nothing is committed, unless there is a part to be replaced.
    Of two writers of one part at a time, one wins as a whole.
    """
    [(part, run)] = {(w.part, w.run) for w in written}
    before = {r.part: r.version for r in manifest(spark, path).filter(F.col("part").isin([part, *retired])).groupBy("part").agg(
        F.max("version").alias("version")).collect()}
    entries = []
    filled = [w for w in written if w.rows]
    if not filled and part in before:
        entries.append((part, before[part] + 1, run, "", 0, None))
    entries += [(p, before[p] + 1, run, _RETIRED, 0, None) for p in retired if p in before]
    version = before.get(part, 0) + 1
    entries += [(part, version, run, w.table, w.rows, None) for w in filled if not w.groups]
    tables = [spark.createDataFrame(entries, _ENTRY)] if entries else []
    for w in filled:
        if w.groups:
            keys = F.create_map(*(x for g in w.groups for x in (F.lit(g), F.col(f"{g}_key"))))
            held = spark.read.schema(_with_keys(T.StructType(), w.groups)).option("basePath", _folder(path, w.table)).parquet(
                _folder(path, w.table, part, run)).groupBy(*(f"{g}_key" for g in w.groups)).agg(F.count(F.lit(1)).alias(ROWS))
            tables.append(held.select(F.lit(part).alias("part"), F.lit(version).cast("long").alias("version"), F.lit(run).alias("run"),
                                      F.lit(w.table).alias("table"), ROWS, keys.alias("keys")))
    if tables:
        # One task, so one file: the commit is there as a whole or not at all.
        reduce(DataFrame.unionByName, tables).repartition(1).write.mode("append").parquet(manifest_path(path))


def write_part(rows: DataFrame, path: str, part: str, groups: Sequence[str] = (), counts: Mapping[str, Column] | None = None,
               retired: Sequence[str] = ()) -> Written:
    """Write and commit a part of a store of one table."""
    written = write(rows, path, part, new_run(), ROWS, groups, counts)
    commit(rows.sparkSession, path, [written], retired)
    return written


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Every commit: a row for each table and each value of its groups (``keys``); empty if there is none."""
    try:
        return spark.read.schema(_ENTRY).parquet(manifest_path(path))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], _ENTRY)
        raise


def retired(spark: SparkSession, path: str, part: str) -> bool:
    """Whether a part was ended by a commit of another one."""
    newest = manifest(spark, path).filter(F.col("part") == part).agg(F.max_by("table", F.struct("version", "run")).alias("table"))
    return newest.first()["table"] == _RETIRED


def current(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """The manifest's rows of each part's newest version; a version of no rows leaves none."""
    newest = F.dense_rank().over(Window.partitionBy("part").orderBy(F.desc("version"), F.desc("run")))
    found = manifest(spark, path).withColumn("__newest", newest).filter((F.col("__newest") == 1) & (F.col(ROWS) > 0))
    return (found if table is None else found.filter(F.col("table") == table)).drop("__newest")


def _with_keys(schema: T.StructType, groups: Sequence[str]) -> T.StructType:
    text = T.StringType()
    return T.StructType([*schema.fields, *(T.StructField(n, text) for n in ("part", "run", *(f"{g}_key" for g in groups)))])


def written_rows(spark: SparkSession, path: str, schema: T.StructType, written: Sequence[Written]) -> DataFrame:
    """The rows of certain writes of one table and no others, with their ``part``; only their folders are listed."""
    folders = [_folder(path, w.table, w.part, w.run) for w in written if w.rows]
    if not folders:
        return spark.createDataFrame([], _with_keys(schema, ())).select(*schema.names, "part")
    full = _with_keys(schema, written[0].groups)
    return spark.read.schema(full).option("basePath", _folder(path, written[0].table)).parquet(*folders).select(*schema.names, "part")


def committed(spark: SparkSession, path: str, schema: T.StructType, table: str = ROWS, groups: Sequence[str] = (),
              only: DataFrame | None = None) -> DataFrame:
    """The rows of every part's newest version, with their ``part``.

    ``only`` are the manifest's rows to read, those of ``current`` if not given;
    their ``keys`` are matched in ``groups``.  Up to ``NAMED_RUNS`` rows of the
    manifest name the folders to be listed and become a filter on their
    partitions; with more of them the table is listed and its partitions are
    joined with the manifest.
    """
    keys = [f"{g}_key" for g in groups]
    full = _with_keys(schema, groups)
    wanted = only if only is not None else current(spark, path, table)
    wanted = wanted.select("part", "run", *(F.col("keys")[g].alias(k) for g, k in zip(groups, keys, strict=True))).distinct()
    named = wanted.limit(NAMED_RUNS + 1).collect()
    if not named:
        return spark.createDataFrame([], full).select(*schema.names, "part")
    reader = spark.read.schema(full).option("basePath", _folder(path, table))
    if len(named) > NAMED_RUNS:
        found = reader.parquet(_folder(path, table)).join(wanted, wanted.columns, "left_semi")
    else:
        found = reader.parquet(*sorted({_folder(path, table, r.part, r.run) for r in named}))
        if groups:
            # One text for all partition columns: a single list, which partitions are pruned by.
            found = found.filter(F.concat_ws(_BETWEEN, "run", *keys).isin([_BETWEEN.join((r.run, *(r[k] for k in keys))) for r in named]))
    return found.select(*schema.names, "part")


def text_of(key: Column) -> Column:
    """The text that ``path_value`` made a key of."""
    return F.when(key.startswith("="), F.substring(key, 2, 2**31 - 1))
