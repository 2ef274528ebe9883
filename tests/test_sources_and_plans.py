"""Readers, writers, the daily run and the file stream."""

from datetime import date, datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from courtline import schemas
from courtline import wording as w
from courtline.config import ValueConfig
from courtline.operators.ratings import power_rating
from courtline.operators.selection import latest_snapshot
from courtline.operators.value import ponderations
from courtline.plans import daily
from courtline.session import MAX_PARTITIONS, initial_partitions
from courtline.sources import readers, writers
from courtline.streaming.snapshots import checkpoint_folder, stream_odds, stream_ponderations
from tests.conftest import records
from tests.test_ingest import OFFER, Landed, team
from tests.test_value import stats

HEADER = "sport,away_team,home_team,spread,away_moneyline,home_moneyline,total\n"
NOON = datetime(2025, 11, 9, 12, 0)


def odds_rows(spark, *rows):
    return spark.createDataFrame(rows, schemas.ODDS)


def write(folder, name, *lines):
    (folder / name).write_text(HEADER + "".join(f"{line}\n" for line in lines))


def test_latest_odds_file(spark, tmp_path):
    write(tmp_path, "nba_odds_20251108_2359.csv", "NBA,A,B,1,2,3,4")
    write(tmp_path, "nba_odds_20251109_0001.csv", "NBA,A,B,5,,,", "NBA,B,A,,,,")
    write(tmp_path, "nfl_odds_20251201_0000.csv", "NFL,A,B,9,9,9,9")
    latest = readers.read_latest_odds(spark, str(tmp_path))
    assert sorted((r["spread"] is None, r["spread"], r["total"]) for r in records(latest)) == [
        (False, 5.0, None), (True, None, None)]
    assert {r["snapshot_ts"] for r in records(latest)} == {datetime(2025, 11, 9, 0, 1)}
    assert latest.schema["away_moneyline"].dataType.simpleString() == "double"   # all null, still a number
    every = readers.read_odds_snapshots(spark, str(tmp_path))
    assert every.count() == 4
    assert sorted(r["sport"] for r in records(latest_snapshot(every))) == ["NBA", "NBA", "NFL"]
    assert readers.read_latest_odds(spark, str(tmp_path), "nfl").count() == 1


def test_missing_inputs_are_errors(spark, tmp_path):
    for read in (
        lambda: readers.read_latest_odds(spark, str(tmp_path)),
        lambda: readers.read_ponderations(spark, str(tmp_path / "none")),
        lambda: readers.read_team_stats(spark, str(tmp_path / "none.csv")),
    ):
        with pytest.raises(FileNotFoundError):
            read()


def test_csv_export_is_found_again(spark, tmp_path):
    games = odds_rows(spark, ("NBA", "A", "B", -1.5, None, 120.0, 220.0))
    assert writers.export_odds_csv(games.limit(0), str(tmp_path), NOON) is None
    assert list(tmp_path.iterdir()) == []
    path = writers.export_odds_csv(games, str(tmp_path), NOON)
    assert path.endswith("nba_odds_20251109_1200.csv")
    assert readers.latest_odds_file(spark, str(tmp_path)).endswith("nba_odds_20251109_1200.csv")
    [row] = records(readers.read_latest_odds(spark, str(tmp_path)))
    assert (row["spread"], row["away_moneyline"], row["snapshot_ts"]) == (-1.5, None, NOON)


def test_odds_table(spark, tmp_path):
    path = str(tmp_path / "odds")
    games = odds_rows(spark, ("NBA", "A", "B", -1.5, None, 120.0, 220.0), ("NFL", "C", "D", None, None, None, None))
    writers.write_odds_snapshot(games.limit(0), path, NOON)
    assert not list((tmp_path / "odds").rglob("*.parquet"))
    for when in (NOON, datetime(2025, 11, 9, 18, 30), NOON):       # the repeated one replaces itself
        writers.write_odds_snapshot(games, path, when)
    table = readers.read_odds_table(spark, path)
    assert table.count() == 4
    newest = records(latest_snapshot(table, ts="snapshot"))
    assert {r["snapshot"] for r in newest} == {"20251109_1830"} and len(newest) == 2
    assert newest[0]["snapshot_date"] == date(2025, 11, 9)


def test_team_stats_round_trip(spark, tmp_path):
    teams = stats(spark, dict(TEAM_NAME="A", TEAM_ID=1), dict(TEAM_NAME="B", TEAM_ID=2))
    for format_ in ("csv", "parquet"):
        path = str(tmp_path / format_)
        writers.write_team_stats(teams, path, format_)
        back = readers.read_team_stats(spark, path, format_)
        assert back.schema == schemas.TEAM_STATS
        assert sorted(map(str, records(back))) == sorted(map(str, records(teams)))
    (tmp_path / "short.csv").write_text("PTS,TEAM_NAME,EXTRA\n101.5,A,x\n")
    [row] = records(readers.read_team_stats(spark, str(tmp_path / "short.csv")))
    assert (row["TEAM_NAME"], row["PTS"], row["OPP_PTS"]) == ("A", 101.5, None)


def test_one_season_is_replaced(spark, tmp_path):
    path = str(tmp_path / "stats")
    for season, name in (("2024-25", "A"), ("2025-26", "B"), ("2025-26", "C")):
        writers.write_team_stats(stats(spark, dict(TEAM_NAME=name)), path, season=season)
    assert sorted(r["TEAM_NAME"] for r in records(spark.read.parquet(path))) == ["A", "C"]


def test_ponderations_round_trip(spark, tmp_path):
    games = odds_rows(spark, ("NBA", "A", "Z", -1.5, None, 120.0, 220.0))
    out = ponderations(daily.flagged_predictions(games, stats(spark, dict(TEAM_NAME="A"))))
    for format_ in ("csv", "parquet"):
        for _ in range(2):
            writers.write_ponderations(out, str(tmp_path / format_), format_)
        back = readers.read_ponderations(spark, str(tmp_path / format_), format_)
        assert records(back) == records(out)


def test_run_day(spark, tmp_path):
    landed = Landed()
    landed.event("tomorrow", event={"date": "2025-11-05T17:30Z"}, items=[OFFER])
    landed.event("later", event={"date": "2025-11-06T17:30Z"}, items=[OFFER])
    landed.event("also tomorrow", event={"date": "2025-11-06T03:30Z"}, competitors=[team("B", "away"), team("A", "home")],
                 items=[{"spread": 9.0}])
    documents = landed.frame(spark)
    teams = stats(spark, dict(TEAM_NAME="Team A"), dict(TEAM_NAME="Team B", W_PCT=0.7))
    paths = daily.DayPaths(str(tmp_path / "day"))
    for _ in range(2):
        daily.run_day(spark, documents, teams, paths, "America/New_York", date(2025, 11, 4), NOON)
    published = records(readers.read_ponderations(spark, paths.of("ponderations"), "parquet"))
    assert sorted(r["away_team"] for r in published) == ["Team A", "Team B"]
    assert spark.read.parquet(paths.of("guide_cards")).count() == 8
    assert spark.read.parquet(paths.of("value_overview")).count() == 4
    bets = {r["away_team"]: r["spread_bet"] for r in records(spark.read.parquet(paths.of("bet_sheet")))}
    assert bets == {"Team A": "No Value", "Team B": "A"}
    assert spark.read.parquet(paths.of("bet_sheet_text")).count() == 2


def test_run_day_without_games(spark, tmp_path):
    paths = daily.DayPaths(str(tmp_path / "day"))
    landed = Landed()
    landed.event("past", event={"date": "2025-10-05T17:30Z"}, items=[OFFER])
    daily.run_day(spark, landed.frame(spark), stats(spark, dict(TEAM_NAME="A")), paths, "UTC", date(2025, 11, 4), NOON)
    assert readers.read_ponderations(spark, paths.of("ponderations"), "parquet").count() == 0


def test_documents_are_pruned_to_their_kind(spark, tmp_path):
    path = str(tmp_path / "documents")
    landed = Landed()
    landed.event("x", items=[OFFER])
    landed.frame(spark).write.partitionBy("sport", "kind").parquet(path)
    games = daily.next_available_games(readers.read_documents(spark, path), "UTC", date(2025, 11, 4))
    assert games.count() == 1
    twice = readers.read_documents(spark, path)
    assert daily.next_available_games(twice.unionAll(twice), "UTC", date(2025, 11, 4)).count() == 1
    fetches = twice.withColumn("fetch", F.lit("a")).unionAll(twice.withColumn("fetch", F.lit("b")))
    assert daily.next_available_games(fetches, "UTC", date(2025, 11, 4), scope=("fetch",)).count() == 2
    plan = games._jdf.queryExecution().executedPlan().toString()
    assert plan.count("(kind#") >= plan.count("FileScan")


def test_stream_takes_each_snapshot_once(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    source.mkdir()
    ratings = power_rating(stats(spark, dict(TEAM_NAME="A"), dict(TEAM_NAME="B")))

    def run():
        query = stream_ponderations(stream_odds(spark, str(source)), ratings, out, checkpoint, ValueConfig(), 2)
        query.awaitTermination()
        return records(spark.read.parquet(out))

    write(source, "nba_odds_20251108_1200.csv", "NBA,A,B,9,,,")
    write(source, "nfl_odds_20251108_1200.csv", "NFL,A,B,9,,,")
    first = run()
    assert [(r["spread_recommendation"], r["snapshot_ts"]) for r in first] == [
        (w.SPREAD_HOME, datetime(2025, 11, 8, 12, 0))]
    write(source, "nba_odds_20251109_1200.csv", "NBA,B,A,-9,,,", "NBA,Z,A,,,,")
    assert len(run()) == 3
    assert len(run()) == 3


def test_checkpoint_folder_comes_from_the_session():
    def session(**conf):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: conf.get(key, default)))

    shared = session(**{"spark.checkpoint.dir": "hdfs://shared/checkpoints/"})
    assert checkpoint_folder(shared, "x") == "hdfs://shared/checkpoints/x"
    with pytest.raises(ValueError):
        checkpoint_folder(session(), "x")


def test_partitions_grow_with_the_shuffle():
    assert initial_partitions(0) == 200
    assert initial_partitions(256 * 1024 ** 2 * 1000 + 1) == 1001
    assert initial_partitions(10 ** 15) == MAX_PARTITIONS


def test_nothing_needs_the_session_zone(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
    assert spark.range(1).select(F.current_timezone()).first()[0] == "America/New_York"


def test_sports_with_digits_and_underscores(spark, tmp_path):
    for name in ("ncaa_m", "u21"):
        for stamp, spread in (("20251108_1200", 1.0), ("20251109_1200", 2.0)):
            (tmp_path / f"{name}_odds_{stamp}.csv").write_text(
                f"sport,away_team,home_team,spread,away_moneyline,home_moneyline,total\n{name},A,B,{spread},,,\n")
        [row] = readers.read_latest_odds(spark, str(tmp_path), name).collect()
        assert row["spread"] == 2.0 and str(row["snapshot_ts"]).startswith("2025-11-09")
