"""Reading the tables with explicit schemas."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from courtline import schemas
from courtline import wording as w
from courtline.sources import commits
from courtline.sources.commits import Written

_SNAPSHOT_NAME = r"([^/]+)_odds_(\d{8}_\d{4})\.csv"


_ODDS_TABLE = StructType(list(schemas.ODDS.fields)).add("snapshot_ts", "timestamp_ntz").add("snapshot_date", "date")
# What a path pattern gives a meaning of its own.
_PATTERN = re.compile(r"([\\\[\]{}*?])")


def _read(spark: SparkSession, path: str, format_: str, schema: StructType) -> DataFrame:
    reader = spark.read.schema(schema)
    if format_ == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    try:
        return reader.format(format_).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no file at {path}") from error
        raise


def read_team_stats(spark: SparkSession, path: str, format_: str = "csv") -> DataFrame:
    """Team statistics with all published columns.

    A CSV may lack some of them or have them in another order: columns are
    matched by its header.
    """
    if format_ != "csv":
        return _read(spark, path, format_, schemas.TEAM_STATS)
    header = _read_header(spark, path)
    by_name = {f.name: f for f in schemas.TEAM_STATS}
    present = StructType()
    for name in header:
        present = present.add(by_name[name]) if name in by_name else present.add(name, "string")
    found = _read(spark, path, format_, present)
    return found.select(*(
        F.col(f.name) if f.name in header else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schemas.TEAM_STATS
    ))


def _read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV; no data is read."""
    try:
        return spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no file at {path}") from error
        raise


def _named_part(path: Column, group: int) -> Column:
    return F.regexp_extract(path, _SNAPSHOT_NAME, group)


def read_odds_snapshots(spark: SparkSession, data_dir: str, sport: str = "*") -> DataFrame:
    """All odds CSVs ``{sport}_odds_yyyyMMdd_HHmm.csv`` of a folder, with the time in their name."""
    found = _read(spark, f"{data_dir}/{sport}_odds_*.csv", "csv", schemas.ODDS)
    return with_snapshot_ts(found)


def with_snapshot_ts(odds: DataFrame) -> DataFrame:
    """Add the time in the file name to rows read from odds CSVs."""
    stamp = _named_part(F.col("_metadata.file_path"), 2)
    return odds.withColumn("snapshot_ts", F.to_timestamp_ntz(stamp, F.lit(w.SNAPSHOT_FORMAT)))


def latest_odds_file(spark: SparkSession, data_dir: str, sport: str = "nba") -> str:
    """Path of the newest odds CSV of a sport, by the time in its name.

    Only the folder is listed; no file is opened.
    """
    missing = f"no odds file of {sport} in {data_dir}"
    try:
        named = _PATTERN.sub(r"\\\1", sport)
        files = spark.read.format("binaryFile").load(f"{data_dir}/{named}_odds_*.csv").select("path")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(missing) from error
        raise
    # A distributed write makes a folder of that name: cut off its part files.
    snapshot = F.regexp_extract("path", rf"^(.*/{_SNAPSHOT_NAME})(/.*)?$", 1)
    newest = files.select(
        F.max_by(snapshot, _named_part(F.col("path"), 2)).alias("path")
    ).first()["path"]
    if not newest:
        raise FileNotFoundError(missing)
    return newest


def read_latest_odds(spark: SparkSession, data_dir: str, sport: str = "nba") -> DataFrame:
    """The newest odds snapshot of a sport; older files are not read."""
    return with_snapshot_ts(_read(spark, latest_odds_file(spark, data_dir, sport), "csv", schemas.ODDS))


def read_odds_table(spark: SparkSession, path: str, only: Sequence[Written] | None = None) -> DataFrame:
    """All snapshots of the table of :func:`courtline.sources.writers.write_odds_snapshot`, or only certain writes of it.

    Only committed snapshots are read, of a snapshot written again the newest version.
    """
    if only is not None:
        found = commits.written_rows(spark, path, _ODDS_TABLE, only)
    else:
        found = commits.committed(spark, path, _ODDS_TABLE)
    return found.withColumnRenamed("part", "snapshot")


def newest_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """The manifest's rows of the newest snapshot of each sport: an aggregate over the manifest, no table file is opened.

    A missing sport is a sport like any other, and so is the empty text.
    """
    sport = F.col("keys")["sport"]
    newest = commits.current(spark, path, commits.ROWS).groupBy(sport.alias("sport_key")).agg(
        F.max(F.struct("part", "run", "rows")).alias("newest"))
    return newest.select(commits.text_of(F.col("sport_key")).alias("sport"), "newest.*",
                         F.create_map(F.lit("sport"), F.col("sport_key")).alias("keys"))


def read_newest_odds(spark: SparkSession, path: str) -> DataFrame:
    """The newest snapshot of each sport from the odds table; other partitions are not read."""
    found = commits.committed(spark, path, _ODDS_TABLE, commits.ROWS, ("sport",), newest_snapshots(spark, path))
    return found.withColumnRenamed("part", "snapshot")


def read_outcomes(spark: SparkSession, path: str, only: Sequence[Written] | None = None) -> DataFrame:
    """What became of every listed event of all landings, or only of certain writes."""
    if only is not None:
        return commits.written_rows(spark, path, schemas.OUTCOMES, only).drop("part")
    return commits.committed(spark, path, schemas.OUTCOMES).drop("part")


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """The quarantine of all landings; ``part`` names the landing."""
    return commits.committed(spark, path, schemas.REJECTED)


def read_ponderations(spark: SparkSession, path: str, format_: str = "csv") -> DataFrame:
    return _read(spark, path, format_, schemas.PONDERATIONS)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Landed documents; partition them by sport and kind, so that each hop reads only its kind."""
    return spark.read.schema(schemas.DOCUMENTS).parquet(path)
