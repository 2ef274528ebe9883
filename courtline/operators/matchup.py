"""Joining games with ratings and predicting their outcome."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.config import ValueConfig
from courtline.functions.odds import american_odds, logistic
from courtline.operators.bounds import small_side

# Rating column -> suffix it gets behind `away_` / `home_`.
CARRIED = {
    "power_rating": "power_rating",
    "offensive_rating": "offensive",
    "defensive_rating": "defensive",
    "PTS": "avg_pts",
    "OPP_PTS": "avg_opp_pts",
}


def join_ratings(games: DataFrame, ratings: DataFrame, scope: Sequence[str] = (),
                 ratings_row_bound: int | None = None) -> DataFrame:
    """Left-join both teams' ratings onto each game by team name.

    The ratings play two roles; each is renamed before its join.  A game whose
    team is unknown keeps null ratings.  With a proven ``ratings_row_bound`` the
    games are not shuffled at all.
    """
    out = games
    columns = list(games.columns)
    for role in ("away", "home"):
        side = ratings.select(
            *scope,
            F.col("TEAM_NAME").alias(f"{role}_team"),
            *(F.col(c).alias(f"{role}_{suffix}") for c, suffix in CARRIED.items()),
        )
        out = out.join(small_side(side, ratings_row_bound), [*scope, f"{role}_team"], "left")
        columns += [f"{role}_{suffix}" for suffix in CARRIED.values()]
    return out.select(*columns)


def predict(matchups: DataFrame, cfg: ValueConfig = ValueConfig()) -> DataFrame:
    """Margin, total, win probabilities, fair prices and their gaps to the book.

    A positive margin or spread difference favours the home team.  Anything built
    on a missing rating or price is null.
    """
    gap = F.col("home_power_rating") - F.col("away_power_rating")
    away_scoring = (F.col("away_avg_pts") + F.col("home_avg_opp_pts")) / 2
    home_scoring = (F.col("home_avg_pts") + F.col("away_avg_opp_pts")) / 2
    return (
        matchups.withColumns({
            "predicted_point_diff": gap / cfg.power_per_point + cfg.home_advantage,
            "predicted_total_points": away_scoring + home_scoring,
        })
        .withColumn("home_win_probability", logistic(F.col("predicted_point_diff"), cfg.logistic_scale))
        .withColumn("away_win_probability", 1 - F.col("home_win_probability"))
        .withColumns({
            f"predicted_{side}_moneyline": american_odds(F.col(f"{side}_win_probability"))
            for side in ("home", "away")
        })
        .withColumns({
            "spread_difference": F.col("predicted_point_diff") + F.col("spread"),
            "total_difference": F.col("total") - F.col("predicted_total_points"),
            "home_ml_difference": F.col("home_moneyline") - F.col("predicted_home_moneyline"),
            "away_ml_difference": F.col("away_moneyline") - F.col("predicted_away_moneyline"),
        })
    )
