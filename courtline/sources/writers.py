"""Writing the tables.  All writes are distributed; nothing passes through the driver."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from courtline import schemas
from courtline import wording as w
from courtline.operators import ingest
from courtline.operators.team_stats import conform
from courtline.operators.value import opportunity_counters
from courtline.sources.commits import Written, write_part


def snapshot_name(snapshot_ts: datetime) -> str:
    """``20251109_1200``: names a snapshot's files and partition."""
    return f"{snapshot_ts:%Y%m%d_%H%M}"


def write_odds_snapshot(games: DataFrame, path: str, snapshot_ts: datetime) -> Written:
    """Add one snapshot to the odds table, its folders divided by sport.

    Writing a snapshot again replaces it as a whole: no row is there twice, and a
    sport that the new one lacks is gone.  Until all its files are written, a
    snapshot is not there for readers.  No games, no files.
    """
    rows = games.select(
        *w.ODDS_COLUMNS,
        F.lit(snapshot_ts.isoformat(sep=" ")).cast("timestamp_ntz").alias("snapshot_ts"),
        F.lit(snapshot_ts.date()).alias("snapshot_date"),
    )
    return write_part(rows, path, snapshot_name(snapshot_ts), ("sport",))


def export_odds_csv(games: DataFrame, data_dir: str, snapshot_ts: datetime, sport: str = "nba") -> str | None:
    """CSV export named after sport and time; None and nothing written if there are no games.

    Call it on a table already written: the check for emptiness reads one row.
    """
    if games.isEmpty():
        return None
    path = f"{data_dir}/{sport}_odds_{snapshot_name(snapshot_ts)}.csv"
    games.select(*w.ODDS_COLUMNS).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_outcomes(outcomes: DataFrame, path: str, part: str) -> Written:
    """Write what became of a landing's events, its folders divided by disposition; counts these on the way."""
    return write_part(_conformed(outcomes, schemas.OUTCOMES), path, part, ("disposition",), ingest.disposition_counters())


def write_rejected(rejected: DataFrame, path: str, part: str) -> Written:
    """Write the quarantine of a landing."""
    return write_part(_conformed(rejected, schemas.REJECTED), path, part)


def _conformed(rows: DataFrame, schema: StructType) -> DataFrame:
    return rows.select(*(F.col(f.name).cast(f.dataType) for f in schema))


def write_team_stats(stats: DataFrame, path: str, format_: str = "parquet", season: str | None = None) -> int:
    """Overwrite the team-stats table, or only one season of it; the number of teams, counted on the way."""
    counted = Observation()
    table = conform(stats).observe(counted, F.count(F.lit(1)).alias("teams"))
    if season is not None:
        (table.withColumn("season", F.lit(season)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("season").format(format_)
         .option("header", True).save(path))
    else:
        table.write.mode("overwrite").format(format_).option("header", True).save(path)
    return counted.get["teams"]


def write_ponderations(published: DataFrame, path: str, format_: str = "csv") -> dict[str, int]:
    """Overwrite the published predictions; games and flags by type, counted on the way."""
    counted = Observation()
    rows = published.observe(counted, *(c.alias(n) for n, c in opportunity_counters().items()))
    rows.write.mode("overwrite").format(format_).option("header", True).save(path)
    return dict(counted.get)
