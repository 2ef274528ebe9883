"""Composite team ratings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.config import RatingConfig, Term

# Carried along for the predicted totals, whatever the terms use.
CARRIED = ("PTS", "OPP_PTS")


def composite(terms: Sequence[Term], base: float | None = None) -> Column:
    """Sum of weighted inputs; null as soon as one input is."""
    total = None if base is None else F.lit(base)
    for term in terms:
        value = F.col(term.column)
        if term.complement:
            value = 1 - value
        part = value * term.scale * term.weight
        total = part if total is None else total + part
    return total


def power_rating(team_stats: DataFrame, cfg: RatingConfig = RatingConfig(),
                 scope: Sequence[str] = ()) -> DataFrame:
    """Offensive, defensive and power rating per team.

    ``scope`` names extra key columns to carry, such as sport and season.
    """
    made = ("offensive_rating", "defensive_rating")
    terms = (*cfg.offensive, *cfg.defensive, *cfg.power)
    inputs = dict.fromkeys(t.column for t in terms if t.column not in made)
    sides = team_stats.select(*scope, "TEAM_NAME", *dict.fromkeys((*inputs, *CARRIED))).withColumns({
        made[0]: composite(cfg.offensive),
        made[1]: composite(cfg.defensive, cfg.defensive_base),
    })
    return sides.withColumn("power_rating", composite(cfg.power))


def top_teams(ratings: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` strongest teams by power rounded to one decimal; ties by name."""
    return (
        ratings.select("TEAM_NAME", F.round("power_rating", 1).alias("power_rating"))
        .orderBy(F.desc_nulls_last("power_rating"), "TEAM_NAME")
        .limit(k)
    )
