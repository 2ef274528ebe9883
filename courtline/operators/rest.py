"""Team form by days of rest.

A log is first reduced to one row per team and day.  The previous game day is
looked up among those, so no task ever orders more rows than a team has game
days, however many games the team has.  Further games on a day follow at a gap
of -1 and count, like every other gap outside 0..3, as ``4+``.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtline import wording as w
from courtline.functions.dates import game_date

_SUMS = ("gp", "w", "pts", "plus_minus")


def rest_bucket(days: Column) -> Column:
    return F.when(days.isin(0, 1, 2, 3), days.cast("string")).when(days.isNotNull(), "4+")


def _game_rank(log: DataFrame) -> Column:
    """What orders the games of a day, as one whole number: the id, then the place in the log.

    Ids that are no whole numbers, missing ones among them, come last, so such
    games are in the order of the log.  A log without ``game_id`` or ``log_position``
    is ordered by the rest; games that still tie are told apart by what counts in
    the splits (and a textual id), so it does not matter which is first.
    """
    last = F.lit(2 ** 63 - 1)
    has_id = "game_id" in log.columns
    id_ = F.coalesce(F.col("game_id").try_cast("long"), last) if has_id else last
    content = F.shiftrightunsigned(F.xxhash64(*(["game_id"] if has_id else []), "wl", "pts", "plus_minus"), 1)
    place = F.coalesce(F.col("log_position").cast("long"), content) if "log_position" in log.columns else content
    return (id_.cast("decimal(19,0)") * F.lit(Decimal(10 ** 19))).cast("decimal(38,0)") + place.cast("decimal(19,0)")


def _dated(game_log: DataFrame, order_mode: str) -> DataFrame:
    if order_mode not in ("date", "text"):
        raise ValueError(f"order_mode must be 'date' or 'text', not {order_mode!r}")
    log = game_log
    if "game_date" not in game_log.columns:
        log = game_log.withColumn("game_date", game_date(F.col("game_date_text")))
    day = F.col("game_date") if order_mode == "date" else F.col("game_date_text")
    return log.withColumns({
        "day": F.when(F.col("game_date").isNotNull(), day),
        "game_rank": _game_rank(log).cast("decimal(38,0)"),
    })


_FIRST = tuple(f"first_{c}" for c in _SUMS[1:])


def _day_sums(dated: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per team and game day: its sums and its first game.  Undated games form one row with a null day."""
    win = F.coalesce((F.col("wl") == "W").cast("long"), F.lit(0))
    pts = F.coalesce("pts", F.lit(0.0))
    plus_minus = F.coalesce("plus_minus", F.lit(0.0))
    return dated.groupBy(*keys, "day").agg(
        F.min("game_date").alias("game_date"),
        F.min("game_rank").alias("first_rank"),
        F.count(F.lit(1)).alias("gp"),
        F.sum(win).alias("w"),
        F.sum(pts).alias("pts"),
        F.sum(plus_minus).alias("plus_minus"),
        *(F.min_by(c, "game_rank").alias(n) for c, n in zip((win, pts, plus_minus), _FIRST, strict=True)),
    )


def _with_rest(days: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds the days of rest before each day; the row without a day sorts first and gives the next one no rest."""
    previous = F.lag("game_date").over(Window.partitionBy(*keys).orderBy(F.asc_nulls_first("day")))
    return days.withColumn("rest", F.date_diff("game_date", previous) - 1)


def _game_days(dated: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _with_rest(_day_sums(dated, keys), keys)


def game_days(game_log: DataFrame, keys: Sequence[str] = ("team_id",), order_mode: str = "date") -> DataFrame:
    """What rest splits need of a log: one row per team and game day, with its sums and its first game.

    Such rows of several logs add up, see :func:`merge_game_days`.
    """
    return _day_sums(_dated(game_log, order_mode), keys)


def merge_game_days(days: DataFrame, keys: Sequence[str] = ("team_id",)) -> DataFrame:
    """One row per team and day of several logs' rows, in whatever order these came.

    A sum of sums with map-side combine; of the first games of a day the first is
    kept.  The logs must not share games.
    """
    return days.groupBy(*keys, "day").agg(
        F.min("game_date").alias("game_date"), F.min("first_rank").alias("first_rank"),
        *(F.sum(c).alias(c) for c in _SUMS), *(F.min_by(c, "first_rank").alias(c) for c in _FIRST))


def days_rest(game_log: DataFrame, keys: Sequence[str] = ("team_id",),
              order_mode: str = "date") -> DataFrame:
    """Each dated game with its days of rest and bucket; a team's first game has neither.

    A log may bring its dates as a typed ``game_date`` or as ``game_date_text``.
    Games of one day are taken in ``game_id`` order if ids are whole numbers, then
    by their place in the log; neither need be there.  ``order_mode='text'``
    orders days by their raw text (April before December), for results that
    equal logs sorted that way.
    """
    dated = _dated(game_log, order_mode)
    first = _game_days(dated, keys).select(
        *keys, "day", F.col("first_rank").alias("game_rank"), F.col("rest").alias("day_rest"), F.lit(True).alias("leads"))
    # Joined on the rank too, so a hot team or day spreads over all tasks; of games that tie, one is the first.
    ranks = [*keys, "day", "game_rank"]
    turn = F.row_number().over(Window.partitionBy(*ranks).orderBy("game_rank"))
    return (
        dated.filter(F.col("day").isNotNull()).join(first, ranks, "left")
        .withColumn("turn", turn)
        .withColumn("days_rest", F.when(F.col("leads") & (F.col("turn") == 1), F.col("day_rest")).otherwise(F.lit(-1)))
        .withColumn("rest_bucket", rest_bucket(F.col("days_rest")))
        .drop("day", "day_rest", "game_rank", "leads", "turn")
    )


def _contributions(days: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two rows per game day: its first game under its bucket, the others under ``4+``."""
    dated = F.col("game_date").isNotNull()
    first = F.struct(
        F.when(dated, rest_bucket(F.col("rest"))).alias("rest_bucket"),
        F.lit(1).cast("long").alias("gp"),
        *(F.col(f"first_{c}").alias(c) for c in _SUMS[1:]),
    )
    others = F.struct(
        F.when(dated, F.lit("4+")).alias("rest_bucket"),
        (F.col("gp") - 1).alias("gp"),
        *((F.col(c) - F.col(f"first_{c}")).alias(c) for c in _SUMS[1:]),
    )
    return _with_rest(days, keys).select(*keys, F.inline(F.array(first, others)))


def _metrics(gp: Column, won: Column, pts: Column, plus_minus: Column) -> dict[str, Column]:
    return {
        "GP": gp,
        "W": won,
        "L": gp - won,
        "W_PCT": F.try_divide(won, gp),
        "PTS": F.try_divide(pts, gp),
        "PLUS_MINUS": F.try_divide(plus_minus, gp),
    }


def rest_splits(game_log: DataFrame, keys: Sequence[str] = ("team_id",),
                order_mode: str = "date") -> DataFrame:
    """Record and averages per team and rest bucket that has games."""
    return rest_splits_of_days(game_days(game_log, keys, order_mode), keys)


def rest_splits_of_days(days: DataFrame, keys: Sequence[str] = ("team_id",)) -> DataFrame:
    """The same from one row per team and game day."""
    played = _contributions(days, keys).filter(
        F.col("rest_bucket").isNotNull() & (F.col("gp") > 0)
    )
    sums = played.groupBy(*keys, "rest_bucket").agg(*(F.sum(c).alias(c) for c in _SUMS))
    metrics = _metrics(*(F.col(c) for c in _SUMS))
    return sums.select(*keys, "rest_bucket", *(value.alias(name) for name, value in metrics.items()))


def rest_splits_wide(game_log: DataFrame, keys: Sequence[str] = ("team_id",),
                     order_mode: str = "date") -> DataFrame:
    """The 30 ``REST_*`` columns per team with a log; 0 where a bucket has no games.

    Conditional sums grouped on the team: the grouping of the window is reused,
    so the pivot costs no further shuffle.
    """
    return rest_splits_wide_of_days(game_days(game_log, keys, order_mode), keys)


def rest_splits_wide_of_days(days: DataFrame, keys: Sequence[str] = ("team_id",)) -> DataFrame:
    """The same from one row per team and game day."""
    def name(bucket: str, column: str) -> str:
        return f"{column}@{bucket}"

    inside = {b: F.col("rest_bucket") == b for b in w.REST_BUCKETS}
    sums = _contributions(days, keys).groupBy(*keys).agg(*(
        F.coalesce(F.sum(F.when(inside[b], F.col(c))), F.lit(0)).alias(name(b, c))
        for b in w.REST_BUCKETS for c in _SUMS
    ))
    columns = []
    for b in w.REST_BUCKETS:
        metrics = _metrics(*(F.col(name(b, c)) for c in _SUMS))
        for metric, value in metrics.items():
            if metric in ("W_PCT", "PTS", "PLUS_MINUS"):
                value = F.coalesce(value, F.lit(0.0))
            columns.append(value.alias(w.rest_column(b, metric)))
    return sums.select(*keys, *columns)
