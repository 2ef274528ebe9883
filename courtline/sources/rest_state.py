"""Rest splits that are kept up to date: each log is reduced once, later runs only add it up.

The state is a store of one row per team and game day of every batch of games, see
:mod:`courtline.sources.commits`.  A batch that is written again replaces itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtline.operators import rest
from courtline.sources import commits
from courtline.sources.commits import Written

_DAYS = T.StructType([
    T.StructField("day", T.StringType()), T.StructField("game_date", T.DateType()), T.StructField("first_rank", T.DecimalType(38, 0)),
    *(T.StructField(f"{first}{c}", T.LongType() if c in ("gp", "w") else T.DoubleType())
      for first in ("", "first_") for c in ("gp", "w", "pts", "plus_minus") if first + c != "first_gp")])


def _schema(keys: T.StructType) -> T.StructType:
    return T.StructType([*keys.fields, *_DAYS.fields])


def _stored(days: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Days as texts, whatever orders them; those of dates read the same way."""
    schema = _schema(T.StructType([days.schema[k] for k in keys]))
    return days.select(*(F.col(f.name).cast(f.dataType) for f in schema))


def add_games(game_log: DataFrame, path: str, batch: str, keys: Sequence[str] = ("team_id",), order_mode: str = "date") -> Written:
    """Add a batch of games that the state lacks, say a day's, or replace it.  Only these games are read.

    A batch that was merged with others cannot be replaced any more: its games are in the merged one.
    """
    if commits.retired(game_log.sparkSession, path, batch):
        raise ValueError(f"batch {batch!r} was merged with others already")
    return commits.write_part(_stored(rest.game_days(game_log, keys, order_mode), keys), path, batch)


def read_game_days(spark: SparkSession, path: str, keys: T.StructType, order_mode: str = "date") -> DataFrame:
    """One row per team and game day of all batches; ``keys`` are the team's columns."""
    days = commits.committed(spark, path, _schema(keys)).drop("part")
    if order_mode == "date":
        days = days.withColumn("day", F.col("game_date"))
    return rest.merge_game_days(days, keys.names)


def merge_batches(spark: SparkSession, path: str, keys: T.StructType, into: str) -> Written:
    """Make all batches one, so that readers add up fewer rows; readers see all of the old ones or the new one.

    Batches that come meanwhile stay as they are.  A merged batch can no longer be
    replaced on its own.
    """
    found = commits.current(spark, path)
    parts = sorted(r.part for r in found.select("part").distinct().collect())
    days = commits.committed(spark, path, _schema(keys), only=found).drop("part")
    return commits.write_part(_stored(rest.merge_game_days(days, keys.names), keys.names), path, into,
                              retired=[p for p in parts if p != into])
