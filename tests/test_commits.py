"""Versioned tables: what is committed is read, and nothing else."""

import json
import os
import subprocess
import sys
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtline import schemas
from courtline.plans import daily
from courtline.sources import commits, readers, writers
from tests.conftest import records
from tests.test_ingest import OFFER, Landed
from tests.test_value import stats

EARLY, LATE = datetime(2025, 11, 8, 12, 0), datetime(2025, 11, 9, 12, 0)
# Names that a path must escape, that differ only by that, that mean something in paths, and none.
SPORTS = ["a+b", "a b", "a%20b", "a%2Bb", "A/B", "x=y", "=", "null", "", None, "Füßball", "サッカー", "nba ", "nba", "__HIVE_DEFAULT_PARTITION__", "*", ".", ".."]


def games(spark, sports, spread=1.0):
    return spark.createDataFrame([(s, "A", "B", spread, None, None, 200.0) for s in sports], schemas.ODDS)


def sports_of(df):
    return sorted((r["sport"] for r in records(df)), key=str)


def test_a_sport_that_the_new_version_lacks_is_gone(spark, tmp_path):
    path = str(tmp_path / "odds")
    writers.write_odds_snapshot(games(spark, ["NBA", "WNBA"]), path, LATE)
    before = readers.read_odds_table(spark, path)
    added = writers.write_odds_snapshot(games(spark, ["NBA"], 2.0), path, LATE)
    assert added.rows == 1
    for read in (readers.read_odds_table(spark, path), readers.read_newest_odds(spark, path),
                 readers.read_odds_table(spark, path, [added])):
        [row] = records(read)
        assert (row["sport"], row["spread"], row["snapshot"]) == ("NBA", 2.0, "20251109_1200")
    assert sports_of(before) == ["NBA", "WNBA"]      # a reader that has begun goes on with its files


def test_every_name_of_a_sport_comes_back(spark, tmp_path):
    path = str(tmp_path / "odds")
    writers.write_odds_snapshot(games(spark, SPORTS, 1.0), path, EARLY)
    writers.write_odds_snapshot(games(spark, SPORTS[:5], 2.0), path, LATE)
    newest = records(readers.read_newest_odds(spark, path))
    assert sorted(((r["sport"], r["spread"]) for r in newest), key=str) == sorted(
        [*((s, 2.0) for s in SPORTS[:5]), *((s, 1.0) for s in SPORTS[5:])], key=str)
    assert readers.read_odds_table(spark, path).count() == len(SPORTS) + 5


def test_a_write_that_broke_off_is_never_read(spark, tmp_path):
    path = str(tmp_path / "odds")
    writers.write_odds_snapshot(games(spark, ["NBA"]), path, EARLY)

    def fail(batches):
        yield from batches
        raise RuntimeError("lost")

    broken = games(spark, ["NBA", "WNBA"], 9.0).mapInArrow(fail, schemas.ODDS)
    with pytest.raises(Exception):
        writers.write_odds_snapshot(broken, path, LATE)
    # All files written, but not the manifest.
    games(spark, ["NFL"], 9.0).withColumns({
        "snapshot_ts": F.lit("2025-11-10 12:00:00").cast("timestamp_ntz"), "snapshot_date": F.lit(date(2025, 11, 10)),
        "part": F.lit("20251110_1200"), "run": F.lit("0" * 32), "sport_key": F.lit("=NFL")}).write.mode("append").partitionBy(
        "part", "run", "sport_key").parquet(f"{path}/rows")
    assert sports_of(readers.read_odds_table(spark, path)) == ["NBA"]
    assert sports_of(readers.read_newest_odds(spark, path)) == ["NBA"]


def test_no_rows(spark, tmp_path):
    path = str(tmp_path / "odds")
    assert writers.write_odds_snapshot(games(spark, []), path, EARLY).rows == 0
    assert not list((tmp_path / "odds").rglob("*.parquet"))
    assert readers.read_odds_table(spark, path).count() == readers.read_newest_odds(spark, path).count() == 0
    writers.write_odds_snapshot(games(spark, ["NBA"]), path, EARLY)
    none = writers.write_odds_snapshot(games(spark, []), path, EARLY)
    assert readers.read_odds_table(spark, path).count() == readers.read_odds_table(spark, path, [none]).count() == 0
    writers.write_odds_snapshot(games(spark, ["NFL"]), path, EARLY)
    assert sports_of(readers.read_odds_table(spark, path)) == ["NFL"]


def test_two_writers_at_a_time_one_wins_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "odds")
    writers.write_odds_snapshot(games(spark, ["NBA", "WNBA"], 1.0), path, EARLY)
    first = commits.manifest(spark, path).collect()
    writers.write_odds_snapshot(games(spark, ["NFL"], 2.0), path, EARLY)
    # The first one's commit once more under the second one's version, as if both had begun at once.
    again = spark.createDataFrame(first, commits.manifest(spark, path).schema).withColumn("version", F.lit(2).cast("long"))
    again.write.mode("append").parquet(commits.manifest_path(path))
    assert sports_of(readers.read_odds_table(spark, path)) in (["NBA", "WNBA"], ["NFL"])


def test_only_the_wanted_folders_are_listed_and_opened(spark, tmp_path):
    path = str(tmp_path / "odds")
    for day in range(1, 6):
        writers.write_odds_snapshot(games(spark, ["NBA", "NFL"]), path, datetime(2025, 11, day))
    writers.write_odds_snapshot(games(spark, ["NFL"]), path, datetime(2025, 11, 6))
    newest = readers.read_newest_odds(spark, path)
    assert {f.split("part=")[1].split("/")[0] for f in newest.inputFiles()} == {"20251105_0000", "20251106_0000"}
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [concat_ws(" in plan
    manifest_plan = readers.newest_snapshots(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert manifest_plan.count("FileScan") == 1
    assert "ReadSchema: struct<part:string,version:bigint,run:string," in manifest_plan


def test_more_runs_than_a_filter_names_are_joined(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "odds")
    for day in (1, 2, 3):
        writers.write_odds_snapshot(games(spark, ["NBA", None], float(day)), path, datetime(2025, 11, day))
    writers.write_odds_snapshot(games(spark, [None], 9.0), path, datetime(2025, 11, 2))
    expected = sorted(map(str, records(readers.read_odds_table(spark, path))))
    newest = sorted(map(str, records(readers.read_newest_odds(spark, path))))
    monkeypatch.setattr(commits, "NAMED_RUNS", 1)
    assert sorted(map(str, records(readers.read_odds_table(spark, path)))) == expected and len(expected) == 5
    assert sorted(map(str, records(readers.read_newest_odds(spark, path)))) == newest and len(newest) == 2


def test_names_of_parts(spark, tmp_path):
    for name in ("a b", "a/b", "", "ä", "a=b"):
        with pytest.raises(ValueError):
            commits.write_part(games(spark, ["NBA"]), str(tmp_path), name)


def test_a_day_that_is_run_again_predicts_on_the_new_games_only(spark, tmp_path):
    paths = daily.DayPaths(str(tmp_path / "day"))
    for name in ("one", "two"):
        landed = Landed()
        landed.event(name, event={"date": "2025-11-04T17:30Z"}, items=[OFFER])
        documents = landed.frame(spark).withColumn("sport", F.lit("nba" if name == "one" else "wnba"))
        daily.run_day(spark, documents, stats(spark, dict(TEAM_NAME="Team A")), paths, "UTC", date(2025, 11, 4), LATE)
    assert sports_of(readers.read_ponderations(spark, paths.of("ponderations"), "parquet")) == ["WNBA"]


LOGGED_WRITE = """
import sys
from pyspark.sql import functions as F
from courtline.session import build_session
from courtline.sources import commits
path, log = sys.argv[1:]
spark = build_session(master="local[2]", conf={
    "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.host": "127.0.0.1", "spark.sql.shuffle.partitions": "4",
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": log, "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
rows = spark.range(0, 50_000, 1, 4).select("id", F.concat(F.lit("g"), (F.col("id") % 6).cast("string")).alias("g"))
commits.write_part(rows, path, "p", ("g",))
spark.stop()
"""


def test_a_write_sorts_no_rows_by_folder(spark, tmp_path):
    """Sorted, the rows of one task of few shuffled bytes took a gigabyte of memory."""
    path, log = str(tmp_path / "rows"), tmp_path / "log"
    log.mkdir()
    subprocess.run([sys.executable, "-c", LOGGED_WRITE, path, log.as_uri()], check=True, timeout=120, capture_output=True,
                   env=os.environ | {"PYTHONPATH": os.pathsep.join(sys.path)})
    events = [json.loads(line) for file in log.iterdir() for line in file.read_text().splitlines()]
    plans = [e["physicalPlanDescription"] for e in events if "physicalPlanDescription" in e]
    written = [p for p in plans if "InsertIntoHadoopFsRelationCommand" in p and "g_key" in p.split("InsertInto")[-1]]
    assert written and not any("Sort" in p for p in written)
    tasks = [e["Task Metrics"] for e in events if e["Event"] == "SparkListenerTaskEnd"]
    writers = [t["Peak Execution Memory"] for t in tasks if t["Output Metrics"]["Records Written"] > 1000]
    assert writers and max(writers) == 0
    found = commits.committed(spark, path, T.StructType().add("id", "long").add("g", "string"))
    assert found.count() == found.select("id").distinct().count() == 50_000


def test_more_folders_than_a_task_holds_open(spark, tmp_path):
    path, n = str(tmp_path / "rows"), 3 * commits.OPEN_FOLDERS
    rows = spark.range(0, 10_000, 1, 1).select("id", (F.col("id") % n).cast("string").alias("g"))
    before = spark.conf.get(commits._OPEN_FOLDERS, None)
    assert commits.write_part(rows, path, "p", ("g",)).rows == 10_000
    assert spark.conf.get(commits._OPEN_FOLDERS, None) == before
    found = commits.committed(spark, path, rows.schema)
    assert sorted((r["id"], r["g"]) for r in records(found)) == [(i, str(i % n)) for i in range(10_000)]
    assert commits.current(spark, path).count() == n


def test_a_session_keeps_its_own_number_of_open_folders(spark, tmp_path):
    path, before = str(tmp_path / "odds"), spark.conf.get(commits._OPEN_FOLDERS, None)
    for own in ("0", "2"):
        spark.conf.set(commits._OPEN_FOLDERS, own)
        try:
            writers.write_odds_snapshot(games(spark, SPORTS), path, LATE)
            assert spark.conf.get(commits._OPEN_FOLDERS) == own
        finally:
            spark.conf.unset(commits._OPEN_FOLDERS) if before is None else spark.conf.set(commits._OPEN_FOLDERS, before)
        assert sports_of(readers.read_odds_table(spark, path)) == sorted(SPORTS, key=str)
