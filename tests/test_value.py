"""Ratings, predictions and flags on hand-made rows."""

import math

import pytest
from pyspark.sql import functions as F

from courtline import wording as w
from courtline.config import RatingConfig, Term, ValueConfig
from courtline.operators.matchup import join_ratings, predict
from courtline.operators.ratings import power_rating, top_teams
from courtline.operators.value import (
    opportunity_summary, ponderations, recommendation_summary, value_flags, value_games)
from courtline.schemas import TEAM_STATS
from tests.conftest import records

TYPICAL = dict(PTS=110.0, OPP_PTS=110.0, W_PCT=0.5, PLUS_MINUS=0.0, FG_PCT=0.47, FG3_PCT=0.36,
               OPP_FG_PCT=0.47, REB=44.0, AST=26.0, TOV=14.0, OPP_TOV=14.0)


def stats(spark, *teams):
    rows = [[{**TYPICAL, **team}.get(f.name) for f in TEAM_STATS] for team in teams]
    return spark.createDataFrame(rows, TEAM_STATS)


def games(spark, *rows):
    return spark.createDataFrame(
        [(i, "NBA", *row) for i, row in enumerate(rows)],
        "event_id long, sport string, away_team string, home_team string, spread double, "
        "away_moneyline double, home_moneyline double, total double")


FLAG_INPUT = ("spread_difference double, total_difference double, home_win_probability double, "
              "away_win_probability double, home_moneyline double, away_moneyline double")


def flags(spark, *rows):
    return [tuple(r[c] for c in w.FLAG_COLUMNS)
            for r in records(value_flags(spark.createDataFrame(rows, FLAG_INPUT)))]


def test_typical_team(spark):
    [row] = records(power_rating(stats(spark, dict(TEAM_NAME="A"))))
    assert math.isclose(row["offensive_rating"], 44 + 14.1 + 5.4 + 7.8)
    assert math.isclose(row["defensive_rating"], 100 - 44 + 21.2 + 8.4)
    assert math.isclose(row["power_rating"], 12.5 + 0 + 71.3 * 0.3 + 85.6 * 0.25)


def test_missing_input_gives_no_rating(spark):
    [row] = records(power_rating(stats(spark, dict(TEAM_NAME="A", OPP_TOV=None))))
    assert row["offensive_rating"] is not None
    assert row["defensive_rating"] is None and row["power_rating"] is None


def test_weights_are_configurable(spark):
    cfg = RatingConfig(power=(Term("W_PCT", 1.0, scale=100.0),))
    [row] = records(power_rating(stats(spark, dict(TEAM_NAME="A", W_PCT=0.6)), cfg))
    assert row["power_rating"] == 60.0


def test_top_teams_break_ties_by_name_and_put_nulls_last(spark):
    teams = [dict(TEAM_NAME=n) for n in "EDCBA"] + [dict(TEAM_NAME="0", PTS=None), dict(TEAM_NAME="Z", W_PCT=0.9)]
    assert [r["TEAM_NAME"] for r in records(top_teams(power_rating(stats(spark, *teams)), 7))] == [
        "Z", "A", "B", "C", "D", "E", "0"]


def test_spread_flag_edges(spark):
    rows = [(d, None, None, None, None, None) for d in (3.0, 3.0000001, -3.0, -3.0000001, None)]
    assert [f[0] for f in flags(spark, *rows)] == [
        w.NO_VALUE, w.SPREAD_HOME, w.NO_VALUE, w.SPREAD_AWAY, w.NO_VALUE]


def test_total_flag_edges(spark):
    rows = [(None, d, None, None, None, None) for d in (5.0, 5.0000001, -5.0, -5.0000001, None)]
    assert [f[1] for f in flags(spark, *rows)] == [
        w.NO_VALUE, w.TOTAL_UNDER, w.NO_VALUE, w.TOTAL_OVER, w.NO_VALUE]


def test_moneyline_flag_edges(spark):
    rows = [
        (None, None, 0.55, 0.45, 150.0, 150.0),   # not above 0.55
        (None, None, 0.56, 0.44, 150.0, None),
        (None, None, 0.56, 0.44, 0.0, 150.0),     # price must be positive
        (None, None, 0.56, 0.44, None, 150.0),    # and known
        (None, None, 0.40, 0.60, 150.0, 120.0),
        (None, None, None, None, 150.0, 150.0),
    ]
    assert [f[2] for f in flags(spark, *rows)] == [
        w.NO_VALUE, w.MONEYLINE_HOME, w.NO_VALUE, w.NO_VALUE, w.MONEYLINE_AWAY, w.NO_VALUE]


@pytest.mark.parametrize("bound", [None, 10])
def test_predictions_and_missing_teams(spark, bound):
    ratings = power_rating(stats(spark, dict(TEAM_NAME="A"), dict(TEAM_NAME="B", W_PCT=0.7)))
    played = games(spark, ("A", "A", -3.0, 120.0, -140.0, 220.0), ("A", "B", None, None, None, None),
                   ("Unknown", "B", -3.0, 120.0, -140.0, 220.0), (None, "B", 1.0, 1.0, 1.0, 1.0))
    out = value_flags(predict(join_ratings(played, ratings, ratings_row_bound=bound)))
    same, better, unknown, nameless = sorted(records(out), key=lambda r: r["event_id"])
    assert same["predicted_point_diff"] == 3.0 and same["predicted_total_points"] == 220.0
    assert math.isclose(same["home_win_probability"] + same["away_win_probability"], 1.0)
    assert same["spread_difference"] == 0.0 and same["total_difference"] == 0.0
    assert math.isclose(better["predicted_point_diff"], 3.5)   # 20 points of win share * 0.25 / 10
    assert better["spread_difference"] is None and better["home_ml_difference"] is None
    for row in (unknown, nameless):
        assert row["predicted_point_diff"] is None and row["predicted_home_moneyline"] is None
        assert {row[c] for c in w.FLAG_COLUMNS} == {w.NO_VALUE}


def test_swapping_sides_flips_the_margin(spark):
    ratings = power_rating(stats(spark, dict(TEAM_NAME="A", W_PCT=0.2), dict(TEAM_NAME="B", PLUS_MINUS=4.0)))
    out = predict(join_ratings(games(spark, ("A", "B", *[None] * 4), ("B", "A", *[None] * 4)), ratings))
    one, other = (r["predicted_point_diff"] - 3 for r in records(out.orderBy("event_id")))
    assert math.isclose(one, -other)


def test_sure_winner_has_no_price(spark):
    ratings = power_rating(stats(spark, dict(TEAM_NAME="A", W_PCT=0.0), dict(TEAM_NAME="B", W_PCT=200.0)))
    cfg = ValueConfig(logistic_scale=0.1)
    [row] = records(predict(join_ratings(games(spark, ("A", "B", *[1.0] * 4)), ratings), cfg))
    assert row["home_win_probability"] == 1.0
    assert row["predicted_home_moneyline"] is None and row["predicted_away_moneyline"] is None


def test_scope_keeps_seasons_apart(spark):
    both = (stats(spark, dict(TEAM_NAME="A", W_PCT=0.1)).withColumn("season", F.lit("old"))
            .unionByName(stats(spark, dict(TEAM_NAME="A", W_PCT=0.9)).withColumn("season", F.lit("new"))))
    ratings = power_rating(both, scope=["season"])
    out = join_ratings(games(spark, ("A", "A", *[None] * 4)).withColumn("season", F.lit("new")), ratings, ["season"])
    [row] = records(out)
    assert row["home_power_rating"] == row["away_power_rating"]


def _published(spark):
    ratings = power_rating(stats(spark, dict(TEAM_NAME="A"), dict(TEAM_NAME="B", W_PCT=0.7)))
    played = games(spark, ("A", "B", 7.25, 120.0, 140.0, 250.04), ("A", "Z", 1.0, 1.0, 1.0, 1.0))
    return value_flags(predict(join_ratings(played, ratings)))


def test_published_table(spark):
    flagged = _published(spark)
    out = ponderations(flagged)
    assert len(out.columns) == 20
    first, unknown = records(out.orderBy(F.desc("sportsbook_spread")))
    assert first["sportsbook_spread"] == 7.3 and first["sportsbook_total"] == 250.0
    assert first["home_moneyline"] == 140.0
    assert first["home_win_prob"] == round(first["home_win_prob"], 3)
    assert unknown["predicted_spread"] is None and unknown["spread_recommendation"] == w.NO_VALUE
    assert ponderations(flagged, ["event_id"]).columns[0] == "event_id"
    assert [r["predicted_spread"] for r in records(recommendation_summary(flagged, ["event_id"]).orderBy("event_id"))
            ] == [3.5, None]


def test_value_games_and_counts(spark):
    flagged = _published(spark)
    assert value_games(flagged).count() == 1
    assert records(opportunity_summary(flagged)) == [dict(
        total_games=2, value_games=1, spread_opportunities=1, total_opportunities=1, moneyline_opportunities=1)]
