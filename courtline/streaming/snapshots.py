"""The daily re-run as a file stream: predictions for odds snapshots as they arrive.

Each new snapshot file is read once; the checkpoint remembers which.  Games are
joined with the static ratings and flagged row by row, so the stream keeps no
state and needs no watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from courtline import schemas
from courtline.config import ValueConfig
from courtline.operators.matchup import join_ratings, predict
from courtline.operators.value import ponderations, value_flags
from courtline.sources.readers import with_snapshot_ts


def stream_odds(spark: SparkSession, data_dir: str, sport: str = "nba") -> DataFrame:
    """New odds CSVs of a folder, with the time in their name."""
    files = (
        spark.readStream.schema(schemas.ODDS).option("header", True).option("enforceSchema", False)
        .option("pathGlobFilter", f"{sport}_odds_*.csv").csv(data_dir)
    )
    return with_snapshot_ts(files)


def checkpoint_folder(spark: SparkSession, name: str) -> str:
    """Folder for a stream's progress under the shared one the cluster names."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a shared folder, or pass a checkpoint path")
    return f"{shared.rstrip('/')}/{name}"


def stream_ponderations(odds: DataFrame, ratings: DataFrame, path: str, checkpoint: str | None = None,
                        cfg: ValueConfig = ValueConfig(),
                        ratings_row_bound: int | None = None) -> StreamingQuery:
    """Append published predictions of all snapshots not seen yet, then stop."""
    checkpoint = checkpoint or checkpoint_folder(odds.sparkSession, "ponderations")
    flagged = value_flags(predict(join_ratings(odds, ratings, (), ratings_row_bound), cfg), cfg)
    return (
        ponderations(flagged, ["snapshot_ts"]).writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
