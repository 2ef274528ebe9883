"""Where the model and the book disagree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline import wording as w
from courtline.config import ValueConfig
from courtline.functions.text import is_value


def _beyond(difference: str, threshold: float, above: str, below: str) -> Column:
    value = F.col(difference)
    return F.when(value > threshold, above).when(value < -threshold, below).otherwise(w.NO_VALUE)


def value_flags(predictions: DataFrame, cfg: ValueConfig = ValueConfig()) -> DataFrame:
    """Add the three recommendation flags, from unrounded numbers.

    Thresholds are strict; a null number never flags.
    """
    def underdog_win(side: str) -> Column:
        return (F.col(f"{side}_win_probability") > cfg.win_probability_threshold) & (
            F.col(f"{side}_moneyline") > 0
        )

    return predictions.withColumns({
        "spread_recommendation": _beyond(
            "spread_difference", cfg.spread_threshold, w.SPREAD_HOME, w.SPREAD_AWAY),
        "total_recommendation": _beyond(
            "total_difference", cfg.total_threshold, w.TOTAL_UNDER, w.TOTAL_OVER),
        "moneyline_recommendation": F.when(underdog_win("home"), w.MONEYLINE_HOME)
        .when(underdog_win("away"), w.MONEYLINE_AWAY)
        .otherwise(w.NO_VALUE),
    })


def any_value() -> Column:
    spread, total, moneyline = (is_value(F.col(c)) for c in w.FLAG_COLUMNS)
    return spread | total | moneyline


def value_games(flagged: DataFrame) -> DataFrame:
    """Games with at least one flag."""
    return flagged.filter(any_value())


def opportunity_counters() -> dict[str, Column]:
    """All games, games with value, and flags per bet type, as aggregates."""
    spread, total, moneyline = (is_value(F.col(c)) for c in w.FLAG_COLUMNS)
    return {
        "total_games": F.count(F.lit(1)),
        "value_games": F.count_if(any_value()),
        "spread_opportunities": F.count_if(spread),
        "total_opportunities": F.count_if(total),
        "moneyline_opportunities": F.count_if(moneyline),
    }


def opportunity_summary(flagged: DataFrame) -> DataFrame:
    """One row of counts: all games, games with value, and flags per bet type."""
    return flagged.agg(*(count.alias(name) for name, count in opportunity_counters().items()))


def ponderations(flagged: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The published 20-column table; rounding happens here and nowhere earlier.

    ``keys`` prepends pass-through columns such as an event id.
    """
    def rounded(source: str, target: str, digits: int) -> Column:
        return F.round(source, digits).alias(target)

    return flagged.select(
        *keys, "sport", "away_team", "home_team",
        rounded("spread", "sportsbook_spread", 1),
        "away_moneyline", "home_moneyline",
        rounded("total", "sportsbook_total", 1),
        rounded("predicted_point_diff", "predicted_spread", 1),
        rounded("predicted_away_moneyline", "predicted_away_ml", 0),
        rounded("predicted_home_moneyline", "predicted_home_ml", 0),
        rounded("predicted_total_points", "predicted_total", 1),
        rounded("away_win_probability", "away_win_prob", 3),
        rounded("home_win_probability", "home_win_prob", 3),
        rounded("away_power_rating", "away_power", 1),
        rounded("home_power_rating", "home_power", 1),
        rounded("spread_difference", "spread_diff", 1),
        rounded("total_difference", "total_diff", 1),
        *w.FLAG_COLUMNS,
    )


def recommendation_summary(flagged: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per game: who plays, model and book spread at one decimal, and the flags."""
    return flagged.select(
        *keys, "away_team", "home_team",
        F.round("predicted_point_diff", 1).alias("predicted_spread"),
        F.round("spread", 1).alias("sportsbook_spread"),
        *w.FLAG_COLUMNS,
    )
