"""Report tables on hand-made published rows."""

import pytest
from pyspark.sql import functions as F

from courtline import wording as w
from courtline.operators import reports
from courtline.schemas import PONDERATIONS
from tests.conftest import records

BASE = dict(sport="NBA", away_team="Boston Celtics", home_team="Miami Heat", sportsbook_spread=-4.5,
            away_moneyline=-180.0, home_moneyline=150.0, sportsbook_total=220.5, predicted_spread=2.0,
            predicted_away_ml=120.0, predicted_home_ml=-120.0, predicted_total=221.0, away_win_prob=0.45,
            home_win_prob=0.55, away_power=55.5, home_power=60.25, spread_diff=-2.5, total_diff=-0.5,
            **dict.fromkeys(w.FLAG_COLUMNS, w.NO_VALUE))


def published(spark, *changes):
    rows = [(i, *({**BASE, **c}[n] for n in PONDERATIONS.names)) for i, c in enumerate(changes)]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PONDERATIONS)
    return spark.createDataFrame(rows, f"event_id long, {fields}")


def sheet(spark, *changes):
    return records(reports.bet_sheet(published(spark, *changes)).orderBy("event_id"))


def test_spread_cell(spark):
    home, strong, away, none = sheet(
        spark,
        dict(spread_recommendation=w.SPREAD_HOME, spread_diff=10.0),
        dict(spread_recommendation=w.SPREAD_HOME, spread_diff=10.1),
        dict(spread_recommendation=w.SPREAD_AWAY, spread_diff=-10.1),
        {})
    cells = ("spread_bet", "spread_line", "spread_strength", "spread_edge")
    assert [home[c] for c in cells] == ["Heat", -4.5, "VALUE", 10.0]      # exactly 10 is not strong
    assert [strong[c] for c in cells] == ["Heat", -4.5, "STRONG", 10.1]
    assert [away[c] for c in cells] == ["Celtics", 4.5, "STRONG", 10.1]
    assert [none[c] for c in cells] == ["No Value", None, "", None]


def test_total_cell(spark):
    over, strong, under, none = sheet(
        spark,
        dict(total_recommendation=w.TOTAL_OVER, total_diff=-8.0),
        dict(total_recommendation=w.TOTAL_OVER, total_diff=-8.1),
        dict(total_recommendation=w.TOTAL_UNDER, total_diff=5.1),
        {})
    cells = ("total_bet", "total_line", "total_strength", "total_edge")
    assert [over[c] for c in cells] == ["OVER", 220.5, "VALUE", 8.0]
    assert [strong[c] for c in cells] == ["OVER", 220.5, "STRONG", 8.1]
    assert [under[c] for c in cells] == ["UNDER", 220.5, "VALUE", 5.1]
    assert [none[c] for c in cells] == ["No Value", None, "", None]


def test_moneyline_cell(spark):
    home, away, none = sheet(
        spark, dict(moneyline_recommendation=w.MONEYLINE_HOME),
        dict(moneyline_recommendation=w.MONEYLINE_AWAY, away_moneyline=130.0), {})
    cells = ("moneyline_bet", "moneyline_price", "moneyline_win_prob", "moneyline_strength")
    assert [home[c] for c in cells] == ["Heat", 150.0, 0.55, "VALUE"]
    assert [away[c] for c in cells] == ["Celtics", 130.0, 0.45, "VALUE"]
    assert [none[c] for c in cells] == ["No Value", None, None, ""]


def test_sheet_texts(spark):
    rows = published(
        spark,
        dict(spread_recommendation=w.SPREAD_AWAY, spread_diff=-10.1, total_recommendation=w.TOTAL_OVER,
             total_diff=-8.0, moneyline_recommendation=w.MONEYLINE_HOME, home_win_prob=0.585),
        dict(sportsbook_spread=None, home_power=None))
    bet, none = records(reports.bet_sheet_text(reports.bet_sheet(rows), ["event_id"]).orderBy("event_id"))
    assert bet == dict(
        event_id=0, header="Boston Celtics @ Miami Heat",
        power_line="Power Ratings: Celtics 55.5 | Heat 60.2",
        spread_strength="STRONG", spread_label="Bet Celtics", spread_text="+4.5", spread_edge_text="Edge: 10.1 pts",
        total_strength="VALUE", total_label="Bet OVER", total_text="220.5", total_edge_text="Edge: 8.0 pts",
        moneyline_strength="VALUE", moneyline_label="Heat", moneyline_text="+150", moneyline_prob_text="58% win prob")
    assert none["power_line"] == "Power Ratings: Celtics 55.5 | Heat nan"
    assert (none["spread_label"], none["spread_text"], none["spread_edge_text"]) == ("No Value", "Book: +nan", "")
    assert (none["total_label"], none["total_text"]) == ("No Value", "Book: 220.5")
    assert (none["moneyline_label"], none["moneyline_text"]) == ("No Value", "")


def test_value_overview(spark):
    rows = published(spark, dict(spread_recommendation=w.SPREAD_AWAY, spread_diff=-10.1))
    got = {r["bet_type"]: r for r in records(reports.value_overview(rows))}
    assert got["spread"] == dict(matchup="Celtics @ Heat", bet_type="spread", value=-10.1, has_value=True,
                                 edge_label="10.1 edge", threshold=3.0)
    assert got["total"] == dict(matchup="Celtics @ Heat", bet_type="total", value=-0.5, has_value=False,
                                edge_label="", threshold=5.0)


def cards(spark, change):
    return {r["card"]: r["text"] for r in records(reports.guide_cards(published(spark, change)))}


def test_guide_cards_with_bets(spark):
    got = cards(spark, dict(
        spread_recommendation=w.SPREAD_AWAY, spread_diff=-10.1, total_recommendation=w.TOTAL_UNDER, total_diff=6.0,
        moneyline_recommendation=w.MONEYLINE_HOME))
    assert got["info"] == ("Power Ratings: Celtics (55.5) vs Heat (60.2)\n"
                           "Win Probabilities: Celtics 45.0% | Heat 55.0%")
    assert "✓ Bet Celtics +4.5\n" in got["spread"]
    assert "• Bet on Celtics with a 4.5 point cushion\n" in got["spread"]
    assert "• Sportsbook line: Celtics +4.5 / Heat -4.5\n" in got["spread"]
    assert "• Our prediction: Heat wins by 2.0\n" in got["spread"]
    assert "• Your edge: 10.1 points\n" in got["spread"]
    assert "✓ Bet UNDER 220.5\n" in got["total"] and "score LESS than 220.5" in got["total"]
    assert got["total"].endswith("We predict a lower-scoring game than the sportsbook expects.")
    assert "to win straight up (+150)" in got["moneyline"]
    assert "(payout: $250 on a $100 bet)" in got["moneyline"] and "55.0%" in got["moneyline"]


def test_guide_cards_for_the_other_sides(spark):
    got = cards(spark, dict(
        spread_recommendation=w.SPREAD_HOME, spread_diff=4.0, total_recommendation=w.TOTAL_OVER, total_diff=-6.0))
    assert "✓ Bet Heat -4.5\n" in got["spread"] and "• Sportsbook line: Heat -4.5\n" in got["spread"]
    assert "score MORE than" in got["total"] and "higher-scoring" in got["total"]
    assert got["moneyline"] == (
        "💰 MONEYLINE BET\n\n✗ No Value Found\n\n• Celtics: -180 (45.0% win prob)\n"
        "• Heat: +150 (55.0% win prob)\n\nThe odds accurately reflect the win probabilities.")


def test_guide_cards_without_value(spark):
    got = cards(spark, {})
    assert "• Our prediction: Heat +2.0\n• Difference: 2.5 points" in got["spread"]
    assert got["total"].startswith("🎯 TOTAL BET\n\n✗ No Value Found\n\n• Sportsbook total: 220.5\n")


def test_payout_text(spark):
    df = spark.createDataFrame([(150.0,), (-200.0,)], "x double")
    assert [r[0] for r in df.select(reports.payout_text(F.col("x"))).collect()] == [
        "$250 on a $100 bet", "$150 on a $100 bet"]


@pytest.fixture(scope="module")
def ranked_input(spark):
    return published(
        spark,
        dict(spread_recommendation=w.SPREAD_AWAY, spread_diff=-7.0),
        dict(spread_recommendation=w.SPREAD_HOME, spread_diff=9.0, total_recommendation=w.TOTAL_UNDER, total_diff=12.0),
        dict(spread_recommendation=w.SPREAD_HOME, spread_diff=7.0),
        dict(moneyline_recommendation=w.MONEYLINE_HOME),
        {})


def test_ranked_value_bets(ranked_input):
    got = [(r["bet_type"], r["rank"], r["event_id"], r["edge"]) for r in records(
        reports.ranked_value_bets(ranked_input, ["event_id"], 2).orderBy("bet_type", "rank"))]
    assert got == [("moneyline", 1, 3, 15.0), ("spread", 1, 1, 9.0), ("spread", 2, 0, 7.0), ("total", 1, 1, 12.0)]


def test_ranking_is_cut_before_the_shuffle(ranked_input):
    plan = reports.ranked_value_bets(ranked_input, ["event_id"], 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_best_bets(ranked_input):
    got = [(r["event_id"], r["best_edge"], r["recommendation"])
           for r in records(reports.best_bets(ranked_input, ["event_id"], 4))]
    assert got == [(1, 12.0, w.TOTAL_UNDER), (0, 7.0, w.SPREAD_AWAY), (2, 7.0, w.SPREAD_HOME),
                   (3, None, w.MONEYLINE_HOME)]


def test_histogram(spark):
    rows = published(spark, *(dict(spread_diff=d, total_diff=None) for d in (-0.1, 0.0, 1.9, 2.0, None)))
    assert {r["bin_start"]: r["n"] for r in records(reports.edge_histogram(rows))} == {-2.0: 1, 0.0: 2, 2.0: 1}


def test_errors(spark):
    rows = published(spark, dict(sportsbook_spread=-4.0, predicted_spread=2.0),
                     dict(sportsbook_spread=1.0, predicted_spread=2.0), dict(sportsbook_spread=None))
    errors = reports.prediction_errors(rows, ["event_id"])
    assert [r["spread_error"] for r in records(errors.orderBy("event_id"))] == [-2.0, 3.0, None]
    assert records(reports.prediction_error_summary(errors)) == [dict(
        spread_games=2, mean_abs_spread_error=2.5, total_games=3, mean_abs_total_error=0.5)]


def test_implied_against_model(spark):
    [row] = records(reports.implied_vs_model_probability(published(spark, {})))
    assert row["home_implied_prob"] == pytest.approx(0.4) and row["home_prob_edge"] == pytest.approx(0.15)
    assert row["away_implied_prob"] == pytest.approx(180 / 280)
