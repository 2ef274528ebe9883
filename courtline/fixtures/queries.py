"""Registered queries: every operator over the given tables, whole.

Dates and nullable integers leave as text and double, so that any comparison
tool reads them alike.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtline.functions.stats_json import row_map
from courtline.fixtures import tpch
from courtline.operators import ingest, reports, rest, selection, team_stats, value
from courtline.operators.matchup import join_ratings, predict
from courtline.operators.ratings import power_rating, top_teams
from courtline.plans.daily import team_stats_table
from courtline.sources import landing, readers, rest_state, writers

Query = Callable[[SparkSession, str], DataFrame]

LOCAL_DAY = date(2024, 1, 15)
NEXT_DAY_AS_OF = date(2023, 12, 30)
OUTCOME_DATES = (date(1996, 1, 1), date(1999, 12, 31))
KEY = ["event_id"]
# The second one is in both snapshots, the last two are apart only by what a path escapes.
SPORTS = ("NBA", "WNBA", "a+b", "a b")
SNAPSHOTS = (datetime(2025, 11, 8, 12, 0), datetime(2025, 11, 9, 12, 0))


def _round(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def _text(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("string") for n in names})


# --- shared inputs ----------------------------------------------------------

def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with offers, with the prices of its best one."""
    events = tpch.events(spark, sf_dir, tpch.row_count(spark, sf_dir, "supplier"))
    return events.join(best_offers(spark, sf_dir), "event_id")


def best_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.best_offer(tpch.odds_offers(spark, sf_dir), KEY, tpch.OFFER_ORDER)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return power_rating(tpch.team_stats(spark, sf_dir))


def matchups(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Teams are suppliers, so the supplier table bounds the ratings.
    bound = tpch.row_count(spark, sf_dir, "supplier")
    return join_ratings(games(spark, sf_dir), ratings(spark, sf_dir), ratings_row_bound=bound)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict(matchups(spark, sf_dir))


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value.value_flags(predictions(spark, sf_dir))


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published table with the event id in front."""
    return value.ponderations(flagged(spark, sf_dir), KEY)


# --- one function per query -------------------------------------------------

def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshots = tpch.table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("sport"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("snapshot_ts"), "value")
    return _text(selection.latest_snapshot(snapshots), "snapshot_ts")


def json_header_rowset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return team_stats.game_log(tpch.log_documents(spark, sf_dir), ("TEAM_ID",)).drop("log_position")


def json_row_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header -> value map of every row, one line per entry."""
    rows = team_stats.decode_result_set(tpch.log_documents(spark, sf_dir)).select(
        "TEAM_ID", F.posexplode("rowSet").alias("row_number", "row"), "headers")
    entries = rows.select("TEAM_ID", "row_number", F.explode(row_map(F.col("headers"), F.col("row"))))
    return entries.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.count("value").alias("n_values"))


def json_nested_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = F.from_json("props", "k int, name string, odds struct<moneyLine: double>")
    return tpch.table(spark, sf_dir, "events").select("event_id", parsed.alias("p")).select(
        "event_id",
        F.coalesce("p.k", F.lit(0)).alias("k"),
        F.coalesce("p.name", F.lit("Unknown")).alias("name"),
        F.col("p.odds.moneyLine").isNull().cast("int").alias("no_moneyline"))


def power_rating_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("offensive_rating", "defensive_rating", "power_rating")
    return _round(ratings(spark, sf_dir).select("TEAM_NAME", *names), 6, *names)


def top_teams_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_teams(ratings(spark, sf_dir))


def matchup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [f"{side}_{c}" for side in ("away", "home")
             for c in ("power_rating", "offensive", "defensive", "avg_pts", "avg_opp_pts")]
    return _round(matchups(spark, sf_dir).select(*KEY, "away_team", "home_team", *names), 6, *names)


def matchup_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("predicted_point_diff", "predicted_total_points", "home_win_probability",
             "away_win_probability", "spread_difference", "total_difference")
    return _round(predictions(spark, sf_dir).select(*KEY, *names), 6, *names)


def american_odds(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("predicted_home_moneyline", "predicted_away_moneyline")
    return _round(predictions(spark, sf_dir).select(*KEY, *names), 4, *names)


def moneyline_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("home_ml_difference", "away_ml_difference")
    return _round(predictions(spark, sf_dir).select(*KEY, *names), 4, *names)


def value_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagged(spark, sf_dir).select(
        *KEY, "spread_recommendation", "total_recommendation", "moneyline_recommendation")


def ponderations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value.ponderations(flagged(spark, sf_dir))


def value_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value.value_games(published(spark, sf_dir))


def opportunity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value.opportunity_summary(flagged(spark, sf_dir))


def recommendation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value.recommendation_summary(flagged(spark, sf_dir), KEY)


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return team_stats.row_counts(
        teams=tpch.team_stats(spark, sf_dir), games=games(spark, sf_dir))


def best_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_offers(spark, sf_dir).withColumn("n_fields", F.col("n_fields").cast("long"))


def home_away_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    away, home = ingest.sides(F.col("doc.competitors"))
    docs = ingest.decode(tpch.documents(spark, sf_dir), "competition", ingest.schemas.COMPETITION_BODY)
    return docs.filter(~F.col("unreadable")).select(
        "url", away["team"]["$ref"].alias("away_ref"), home["team"]["$ref"].alias("home_ref"))


def ref_dereference(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound = tpch.row_count(spark, sf_dir, "nation")
    snapshot = ingest.odds_snapshot(tpch.documents(spark, sf_dir), tpch.ZONE, teams_row_bound=bound)
    return _text(snapshot, "event_date")


def event_disposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound = tpch.row_count(spark, sf_dir, "nation")
    outcomes = ingest.event_outcomes(tpch.documents(spark, sf_dir), tpch.ZONE, *OUTCOME_DATES, bound)
    return ingest.disposition_counts(outcomes)


def _landed(spark: SparkSession, sf_dir: str) -> landing.LandedDocuments:
    """The landed documents decoded into a store; a first landing of no other use is replaced."""
    path = _new_folder(spark, "landed")
    documents = tpch.documents(spark, sf_dir)
    landing.land(documents.filter(F.col("kind") == "team"), path, "fetch-1")
    landing.land(documents, path, "fetch-1")
    return landing.LandedDocuments(spark, path, page_type=documents.schema["page"].dataType.simpleString())


def landed_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games of a window from the landed store: only its events' partitions are opened."""
    found = ingest.odds_snapshot(_landed(spark, sf_dir), tpch.ZONE, *OUTCOME_DATES)
    return _text(found.drop("fetch"), "event_date")


def outcomes_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every listed event's outcome and reason, written by disposition and read back."""
    path = _new_folder(spark, "outcomes")
    writers.write_outcomes(ingest.event_outcomes(_landed(spark, sf_dir), tpch.ZONE, *OUTCOME_DATES), path, "fetch-1")
    found = readers.read_outcomes(spark, path)
    return found.select("event_url", "disposition", "reason", F.col("away_team"), F.col("home_team"), "spread", "total")


def quarantine_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events dropped by an error, with the bodies to blame, written and read back."""
    path = _new_folder(spark, "rejected")
    documents = tpch.documents(spark, sf_dir)
    outcomes = ingest.event_outcomes(_landed(spark, sf_dir), tpch.ZONE, *OUTCOME_DATES)
    writers.write_rejected(ingest.rejected_documents(outcomes, documents), path, "fetch-1")
    return readers.read_rejected(spark, path).select("event_url", "reason", "document_url", "body")


def events_on_local_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tpch.table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    found = ingest.on_local_dates(events, "ts", tpch.ZONE, LOCAL_DAY, LOCAL_DAY)
    return _text(found.drop("ts"), "local_date")


def event_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tpch.table(spark, sf_dir, "events")
    return _text(ingest.event_date_range(events, "ts", tpch.ZONE), "first_date", "last_date")


def next_game_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tpch.table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("sport"),
        ingest.local_date_of_utc(F.col("ts"), tpch.ZONE).alias("event_date"))
    return _text(selection.next_game_day(events, NEXT_DAY_AS_OF), "event_date")


def days_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rest.days_rest(tpch.game_log(spark, sf_dir)).select(
        "team_id", "game_id", F.col("days_rest").cast("double").alias("days_rest"), "rest_bucket")


def days_rest_text_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rest.days_rest(tpch.game_log(spark, sf_dir), order_mode="text").select(
        "team_id", "game_id", F.col("days_rest").cast("double").alias("days_rest"), "rest_bucket")


def rest_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(rest.rest_splits(tpch.game_log(spark, sf_dir)), 4, "W_PCT", "PTS", "PLUS_MINUS")


def rest_splits_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = rest.rest_splits_wide(tpch.game_log(spark, sf_dir))
    return _round(wide, 4, *(c for c in wide.columns if c.endswith(("PCT", "PTS", "PLUS_MINUS"))))


def team_stats_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    teams = tpch.team_stats(spark, sf_dir).select("TEAM_NAME", "TEAM_ID", "PTS", "W_PCT")
    customers = tpch.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("TEAM_NAME"), (F.col("c_acctbal") / 100).alias("OPP_PTS"))
    nations = tpch.table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("TEAM_NAME"), F.col("n_nationkey").cast("long").alias("TEAM_ID"),
        F.col("n_regionkey").cast("double").alias("AST"))
    united = team_stats.conform(team_stats.union_stats(teams, customers, nations), strict=False)
    return _round(united.withColumn("TEAM_ID", F.col("TEAM_ID").cast("double")), 6, "PTS", "W_PCT")


def team_stats_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, opponent = tpch.nation_documents(spark, sf_dir)
    log = tpch.log_documents(spark, sf_dir)
    wide = team_stats_table(base, opponent, log)
    names = [c for c in wide.columns if c.startswith("REST_") and c.endswith(("PCT", "PTS", "PLUS_MINUS"))]
    return _round(wide, 4, *names)


def team_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = team_stats.preview(tpch.team_stats(spark, sf_dir))
    return _round(shown, 6, "W_PCT", "PTS", "OPP_PTS", "PLUS_MINUS")


def matchup_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = tpch.table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat_ws(" ", "p_brand", "p_name").alias("away_team"),
        F.concat_ws("  ", "p_name", "p_type").alias("home_team"))
    return reports.with_labels(names)


def bet_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheet = reports.bet_sheet(published(spark, sf_dir))
    return sheet.select(
        *KEY, "full_matchup", "matchup", *(c for c in sheet.columns if c.startswith(
            ("spread_", "total_", "moneyline_")) and c.endswith(
            ("_bet", "_line", "_strength", "_edge", "_price", "_win_prob"))))


def bet_sheet_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.bet_sheet_text(reports.bet_sheet(published(spark, sf_dir)), KEY)


def value_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.value_overview(published(spark, sf_dir), keys=KEY)


def guide_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.guide_cards(published(spark, sf_dir), keys=KEY)


def moneyline_payout(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = reports.moneyline_payouts(games(spark, sf_dir), KEY)
    return _round(paid, 4, "away_payout", "home_payout")


def ranked_value_bets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = reports.ranked_value_bets(published(spark, sf_dir), KEY)
    return ranked.withColumn("rank", F.col("rank").cast("long"))


def implied_vs_model_prob(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = reports.implied_vs_model_probability(published(spark, sf_dir), KEY)
    return _round(compared, 6, "away_implied_prob", "away_prob_edge", "home_implied_prob", "home_prob_edge")


def edge_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.edge_histogram(published(spark, sf_dir))


def prediction_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = reports.prediction_errors(published(spark, sf_dir))
    return _round(reports.prediction_error_summary(errors), 4, "mean_abs_spread_error", "mean_abs_total_error")


def prediction_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(reports.prediction_errors(published(spark, sf_dir), KEY), 4, "spread_error", "total_error")


def best_bets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.best_bets(published(spark, sf_dir), KEY)


def _new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run, below the one that driver and executors share."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}-{uuid.uuid4().hex}"


def odds_table_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sports written as snapshots of two times, one of them twice; the newest of each sport read back.

    The later snapshot first holds all games of all sports, then, written again,
    only what it should; sports whose names a path must escape stay apart.
    """
    path = _new_folder(spark, "odds")
    found = games(spark, sf_dir).withColumn("sport", F.element_at(
        F.array(*map(F.lit, SPORTS)), (F.col("event_id") % len(SPORTS)).cast("int") + 1))
    writers.write_odds_snapshot(found.withColumn("sport", F.lit("NBA")), path, SNAPSHOTS[1])
    for sports, stamp in ((SPORTS[:2], SNAPSHOTS[1]), (SPORTS[1:], SNAPSHOTS[0])):
        writers.write_odds_snapshot(found.filter(F.col("sport").isin(list(sports))), path, stamp)
    return readers.read_newest_odds(spark, path).drop("snapshot_ts", "snapshot_date")


def team_stats_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _new_folder(spark, "team_stats")
    writers.write_team_stats(tpch.team_stats(spark, sf_dir), path)
    found = readers.read_team_stats(spark, path, "parquet").select("TEAM_NAME", "TEAM_ID", "PTS", "W_PCT", "REB")
    return _round(found, 6, "PTS", "W_PCT")


def ponderations_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _new_folder(spark, "ponderations")
    writers.write_ponderations(ponderations(spark, sf_dir), path)
    return readers.read_ponderations(spark, path)


def rest_splits_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The splits of a log that came in batches, out of order; one came twice, some were merged meanwhile."""
    path = _new_folder(spark, "game_days")
    log = tpch.game_log(spark, sf_dir)
    team = T.StructType([log.schema["team_id"]])
    for batch in (3, 0, 2, 0):
        rest_state.add_games(log.filter(F.col("game_id") % 4 == batch), path, f"batch-{batch}")
    rest_state.merge_batches(spark, path, team, "merged")
    rest_state.add_games(log.filter(F.col("game_id") % 4 == 1), path, "batch-1")
    return _round(rest.rest_splits_of_days(rest_state.read_game_days(spark, path, team)), 4, "W_PCT", "PTS", "PLUS_MINUS")


QUERIES: dict[str, Query] = {
    "odds_table_round_trip": odds_table_round_trip,
    "team_stats_round_trip": team_stats_round_trip,
    "ponderations_round_trip": ponderations_round_trip,
    "latest_snapshot": latest_snapshot,
    "json_header_rowset": json_header_rowset,
    "json_row_map": json_row_map,
    "json_nested_defaults": json_nested_defaults,
    "power_rating": power_rating_query,
    "top_teams": top_teams_query,
    "matchup_join": matchup_join,
    "matchup_predictions": matchup_predictions,
    "american_odds": american_odds,
    "moneyline_difference": moneyline_difference,
    "value_flags": value_flags,
    "ponderations": ponderations,
    "value_games": value_games,
    "opportunity_summary": opportunity_summary,
    "recommendation_summary": recommendation_summary,
    "row_counts": row_counts,
    "best_provider": best_provider,
    "home_away_roles": home_away_roles,
    "ref_dereference": ref_dereference,
    "event_disposition": event_disposition,
    "landed_window": landed_window,
    "outcomes_round_trip": outcomes_round_trip,
    "quarantine_round_trip": quarantine_round_trip,
    "events_on_local_date": events_on_local_date,
    "event_date_range": event_date_range,
    "next_game_day": next_game_day,
    "days_rest": days_rest,
    "days_rest_text_order": days_rest_text_order,
    "rest_splits": rest_splits,
    "rest_splits_pivot": rest_splits_pivot,
    "rest_splits_kept": rest_splits_kept,
    "team_stats_union": team_stats_union,
    "team_stats_wide": team_stats_wide,
    "team_preview": team_preview,
    "matchup_label": matchup_label,
    "bet_sheet": bet_sheet,
    "bet_sheet_text": bet_sheet_text,
    "value_overview": value_overview,
    "guide_cards": guide_cards,
    "moneyline_payout": moneyline_payout,
    "ranked_value_bets": ranked_value_bets,
    "implied_vs_model_prob": implied_vs_model_prob,
    "edge_histogram": edge_histogram,
    "prediction_error": prediction_error,
    "prediction_pairs": prediction_pairs,
    "best_bets": best_bets,
}
