"""American odds as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def american_odds(probability: Column) -> Column:
    """Fair American price of a win probability; null where no price exists (p = 0 or 1)."""
    lose = F.lit(1) - probability
    return F.when(probability > 0.5, F.try_divide(-100 * probability, lose)).otherwise(
        F.try_divide(100 * lose, probability)
    )


def implied_probability(moneyline: Column) -> Column:
    """Win probability a book price implies: the inverse of :func:`american_odds`."""
    return F.when(moneyline < 0, F.try_divide(-moneyline, 100 - moneyline)).otherwise(
        F.try_divide(F.lit(100.0), moneyline + 100)
    )


def payout(moneyline: Column, stake: float = 100.0) -> Column:
    """Money returned, stake included, by a winning bet; null for a zero price."""
    profit = F.when(moneyline > 0, moneyline * (stake / 100.0)).otherwise(
        F.try_divide(F.lit(stake * 100.0), F.abs(moneyline))
    )
    return stake + profit


def logistic(x: Column, scale: float) -> Column:
    return F.lit(1.0) / (1 + F.exp(-x / scale))


def filled_fields(*columns: Column) -> Column:
    """How many of the columns are present."""
    present = [c.isNotNull().cast("int") for c in columns]
    return sum(present[1:], present[0])
