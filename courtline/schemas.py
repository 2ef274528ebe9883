"""Explicit schemas: nothing in the library relies on inference."""

from __future__ import annotations

from pyspark.sql import types as T

from courtline import wording as w

_LONG_STATS = {"TEAM_ID", "GP", "W", "L"}


def _stat_type(name: str) -> T.DataType:
    if name in _LONG_STATS or (name.startswith("REST_") and name.endswith(("_GP", "_W", "_L"))):
        return T.LongType()
    return T.StringType() if name == "TEAM_NAME" else T.DoubleType()


TEAM_STATS = T.StructType([T.StructField(c, _stat_type(c)) for c in w.TEAM_STATS_COLUMNS])

ODDS = T.StructType([
    T.StructField(c, T.DoubleType() if c in w.PRICE_COLUMNS else T.StringType())
    for c in w.ODDS_COLUMNS
])

PONDERATIONS = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("sport", "away_team", "home_team")]
    + [T.StructField(c, T.DoubleType()) for c in (
        "sportsbook_spread", "away_moneyline", "home_moneyline", "sportsbook_total",
        "predicted_spread", "predicted_away_ml", "predicted_home_ml", "predicted_total",
        "away_win_prob", "home_win_prob", "away_power", "home_power", "spread_diff", "total_diff")]
    + [T.StructField(c, T.StringType()) for c in w.FLAG_COLUMNS]
)

# What became of every listed event, with the documents that were followed; `fetch` is the landing it belongs to.
OUTCOMES = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("fetch", "sport", "event_url")]
    + [T.StructField("event_date", T.DateType())]
    + [T.StructField(c, T.StringType()) for c in ("away_team", "home_team")]
    + [T.StructField(c, T.DoubleType()) for c in w.PRICE_COLUMNS]
    + [T.StructField(c, T.StringType()) for c in (
        "disposition", "reason", "competition_url", "away_url", "home_url", "odds_url")])

# Events dropped by an error, with the body to blame.
REJECTED = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("sport", "event_url")]
    + [T.StructField("event_date", T.DateType())]
    + [T.StructField(c, T.StringType()) for c in ("reason", "document_url")]
    + [T.StructField("page", T.DecimalType(38, 0)), T.StructField("body", T.StringType())])

# Landed documents: raw bodies by kind.  `page` orders several bodies of one URL.
DOCUMENTS = "sport string, kind string, url string, page long, body string"

# Bodies of the landed documents (DDL, for from_json).
STATS_BODY = "resultSets array<struct<headers: array<string>, rowSet: array<array<string>>>>"
EVENT_LIST_BODY = "items array<struct<`$ref`: string>>"
EVENT_BODY = "date string, competitions array<struct<`$ref`: string>>"
COMPETITION_BODY = (
    "competitors array<struct<homeAway: string, team: struct<`$ref`: string>>>, "
    "odds struct<`$ref`: string>"
)
TEAM_BODY = "displayName string"
ODDS_BODY = (
    "items array<struct<provider: struct<name: string>, spread: double, overUnder: double, "
    "awayTeamOdds: struct<moneyLine: double>, homeTeamOdds: struct<moneyLine: double>>>"
)
