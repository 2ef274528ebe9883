"""The operators put together: raw documents -> tables -> predictions -> reports.

Each step is lazy and returns a DataFrame; only :func:`run_day` writes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.config import RatingConfig, ReportConfig, ValueConfig
from courtline.operators import ingest, reports, team_stats
from courtline.operators.matchup import join_ratings, predict
from courtline.operators.ratings import power_rating
from courtline.operators.rest import rest_splits_wide
from courtline.operators.selection import keep_extreme, next_game_day
from courtline.operators.value import ponderations, value_flags
from courtline.sources import landing, readers, writers


def flagged_predictions(games: DataFrame, stats: DataFrame, rating: RatingConfig = RatingConfig(),
                        value: ValueConfig = ValueConfig(), scope: Sequence[str] = (),
                        teams_row_bound: int | None = None) -> DataFrame:
    """Games with unrounded predictions and flags."""
    ratings = power_rating(stats, rating, scope)
    matchups = join_ratings(games, ratings, scope, teams_row_bound)
    return value_flags(predict(matchups, value), value)


def team_stats_table(base_docs: DataFrame, opponent_docs: DataFrame, log_docs: DataFrame,
                     keys: Sequence[str] = team_stats.TEAM_KEYS, order_mode: str = "date") -> DataFrame:
    """The wide team-stats table from the three landed documents per team."""
    rest = rest_splits_wide(team_stats.game_log(log_docs, keys), keys, order_mode)
    wide = team_stats.assemble(
        team_stats.base_stats(base_docs, keys), team_stats.opponent_stats(opponent_docs, keys), rest, keys)
    extra = [k for k in keys if k not in team_stats.TEAM_KEYS]
    return team_stats.conform(wide, keys=extra)


def games_in_window(documents: DataFrame | ingest.Source, zone: str, as_of: date, days: int = 3,
                    teams_row_bound: int | None = None, scope: Sequence[str] = ()) -> DataFrame:
    """Games with odds from ``as_of`` on, for ``days`` days.

    Of documents of several fetches, ``scope`` names the columns that tell these
    apart; a fetch that landed twice counts once.  Raw bodies are decoded here,
    each once; of a landed store (:mod:`courtline.sources.landing`) only the events
    of those days are opened.
    """
    return ingest.odds_snapshot(documents, zone, as_of, as_of + timedelta(days=days - 1), teams_row_bound, scope=scope)


def next_available_games(documents: DataFrame | ingest.Source, zone: str, as_of: date, days: int = 3,
                         teams_row_bound: int | None = None, scope: Sequence[str] = ()) -> DataFrame:
    """Games with odds on the first day from ``as_of`` on that has any, per sport and fetch."""
    near = games_in_window(documents, zone, as_of, days, teams_row_bound, scope)
    if isinstance(documents, ingest.Source):
        scope = documents.scope
    return next_game_day(near, as_of, ("sport", *scope), "event_date", days)


REPORTS: dict[str, Callable[[DataFrame, ReportConfig], DataFrame]] = {
    "bet_sheet": reports.bet_sheet,
    "bet_sheet_text": lambda published, cfg: reports.bet_sheet_text(reports.bet_sheet(published, cfg)),
    "value_overview": reports.value_overview,
    "guide_cards": reports.guide_cards,
}


@dataclass(frozen=True)
class DayPaths:
    """Where one day's tables go, under a shared root."""

    root: str
    reports: tuple[str, ...] = field(default=tuple(REPORTS))

    def of(self, name: str) -> str:
        return f"{self.root}/{name}"


@dataclass(frozen=True)
class DayCounts:
    """What :func:`run_day` counted while it wrote."""

    dispositions: dict[str, int]
    games: int
    teams: int
    opportunities: dict[str, int]


def run_day(spark: SparkSession, documents: DataFrame, stats: DataFrame, paths: DayPaths, zone: str,
            as_of: date, snapshot_ts: datetime, value: ValueConfig = ValueConfig(),
            report: ReportConfig = ReportConfig(), fetch: str | None = None, days: int = 3) -> DayCounts:
    """Write one day's outcomes, quarantine, odds snapshot, predictions and reports.

    If the landed documents hold several fetches, ``fetch`` names the column that
    orders them; the newest one of each sport is used.

    Every body is decoded once, when the documents are landed.  Every step reads
    the table the step before wrote, so nothing is computed twice and a lost
    executor costs at most one step's tasks.  All counts are made by the writes.
    Run again for the same ``snapshot_ts``, everything of that time is replaced.
    """
    if fetch is not None:
        documents = keep_extreme(documents, ("sport",), fetch, F.max)
    name = writers.snapshot_name(snapshot_ts)
    teams = writers.write_team_stats(stats, paths.of("team_stats"))

    landing.land(documents, paths.of("landed"), name)
    landed = landing.LandedDocuments(spark, paths.of("landed"), F.col("part") == name, documents.schema["page"].dataType.simpleString())
    last = as_of + timedelta(days=days - 1)
    outcomes = writers.write_outcomes(
        ingest.event_outcomes(landed, zone, as_of, last), paths.of("outcomes"), name)
    became = readers.read_outcomes(spark, paths.of("outcomes"), [outcomes])
    errors = outcomes.counts[ingest.ERROR]
    rejected = ingest.rejected_documents(became, documents, row_bound=errors)
    writers.write_rejected(rejected, paths.of("rejected"), name)

    games = became.filter(F.col("disposition") == ingest.GAME)
    added = writers.write_odds_snapshot(next_game_day(games, as_of, days=days), paths.of("odds"), snapshot_ts)
    snapshot = readers.read_odds_table(spark, paths.of("odds"), [added])
    team_table = readers.read_team_stats(spark, paths.of("team_stats"), "parquet")
    flagged = flagged_predictions(snapshot, team_table, value=value)
    found = writers.write_ponderations(ponderations(flagged), paths.of("ponderations"), "parquet")

    published = readers.read_ponderations(spark, paths.of("ponderations"), "parquet")
    for report_name in paths.reports:
        REPORTS[report_name](published, report).write.mode("overwrite").parquet(paths.of(report_name))
    return DayCounts(dict(outcomes.counts), added.rows, teams, found)
