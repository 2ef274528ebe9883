"""Choosing rows: best offer per game, latest snapshot, next day with games."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline import wording as w
from courtline.functions.odds import filled_fields
from courtline.operators.bounds import BROADCAST_BYTES

# Groups whose extremes may be known to the driver.
KNOWN_GROUPS = 10_000


def completeness() -> Column:
    """How many of the four prices an offer carries."""
    return filled_fields(*(F.col(c) for c in w.PRICE_COLUMNS))


def best_offer(offers: DataFrame, keys: Sequence[str] = ("event_id",), order: Sequence[str] = ("pos",)) -> DataFrame:
    """The most complete offer per key; the first in ``order`` among equals, missing positions last.

    An offer without any price still wins if it is the only one.  Offers that are
    equal in all that, as with repeated or missing positions, are told apart by
    their prices, so the result depends on the rows alone.  This is one aggregation
    with map-side combine, so a key with very many offers sends one row per task.
    """
    missing = F.lit(len(w.PRICE_COLUMNS)) - completeness()
    placed = [c.alias(f"{o}_{k}") for o in order for k, c in enumerate((F.col(o).isNull(), F.col(o)))]
    best = F.min(F.struct(missing.alias("missing"), *placed, *w.PRICE_COLUMNS))
    return offers.groupBy(*keys).agg(best.alias("best")).select(
        *keys, *(F.col(f"best.{c}") for c in w.PRICE_COLUMNS),
        (F.lit(len(w.PRICE_COLUMNS)) - F.col("best.missing")).alias("n_fields"),
        *(F.col("best")[f"{o}_1"].alias(o) for o in order))


def best_offer_of_items(items: Column) -> Column:
    """The same choice within one odds document, without a shuffle.

    Takes the ``items`` array of a decoded odds body and gives a struct of
    ``missing`` (4 - filled prices), ``index`` and the prices; null if empty.
    """
    def entry(item: Column, index: Column) -> Column:
        prices = {
            "spread": item["spread"],
            "away_moneyline": item["awayTeamOdds"]["moneyLine"],
            "home_moneyline": item["homeTeamOdds"]["moneyLine"],
            "total": item["overUnder"],
        }
        missing = F.lit(len(prices)) - filled_fields(*prices.values())
        return F.struct(missing.alias("missing"), index.alias("index"),
                        *(value.alias(name) for name, value in prices.items()))

    return F.array_min(F.transform(items, entry))


def keep_extreme(df: DataFrame, by: Sequence[str], column: str, extreme: Callable[[Column], Column]) -> DataFrame:
    """Rows whose ``column`` equals its extreme within their group; null is a group like any other.

    The extremes are one row per group, matched by a null-safe semi join.  They are
    worked out once: up to ``KNOWN_GROUPS`` of them, if they take no more than
    ``BROADCAST_BYTES``, go to all tasks, and the table itself is not shuffled.
    With more groups the join is left to Spark.
    """
    found = df.filter(F.col(column).isNotNull()).groupBy(*by).agg(extreme(F.col(column)).alias(column))
    found = found.select(*(F.col(c).alias(f"__{c}") for c in (*by, column)))
    known = found.limit(KNOWN_GROUPS + 1).toArrow()
    if known.num_rows <= KNOWN_GROUPS and known.nbytes <= BROADCAST_BYTES:
        found = F.broadcast(df.sparkSession.createDataFrame(known, found.schema))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in (*by, column)))
    return df.join(found, same, "left_semi")


def latest_snapshot(snapshots: DataFrame, by: Sequence[str] = ("sport",),
                    ts: str = "snapshot_ts") -> DataFrame:
    """Only the newest snapshot of each group."""
    return keep_extreme(snapshots, by, ts, F.max)


def next_game_day(games: DataFrame, as_of: date, by: Sequence[str] = ("sport",),
                  date_column: str = "event_date", days: int = 3) -> DataFrame:
    """Games of the first day from ``as_of`` on that has any, per group.

    Looks ``days`` days ahead, ``as_of`` included; a group without games in
    that time gives no rows.
    """
    last = as_of + timedelta(days=days - 1)
    near = games.filter(F.col(date_column).between(F.lit(as_of), F.lit(last)))
    return keep_extreme(near, by, date_column, F.min)
