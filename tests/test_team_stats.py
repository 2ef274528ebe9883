"""Statistics documents -> wide team table."""

import json

import pytest

from courtline import schemas
from courtline import wording as w
from courtline.operators import team_stats
from courtline.plans.daily import team_stats_table
from tests.conftest import records

DOCS = "TEAM_ID long, TEAM_NAME string, body string"


def result_set(headers, *rows):
    return json.dumps({"resultSets": [{"headers": headers, "rowSet": list(rows)}]})


NO_SETS = json.dumps({"resultSets": []})
TORN = '{"resultSets": ['
OPPONENT = ["OPP_PTS", "OPP_FG_PCT", "OPP_TOV"]
LOG = ["Team_ID", "Game_ID", "GAME_DATE", "WL", "PTS", "PLUS_MINUS"]


def frame(spark, bodies):
    return spark.createDataFrame([(i, f"T{i}", b) for i, b in bodies.items()], DOCS)


@pytest.fixture(scope="module")
def wide(spark):
    base = {i: result_set(["GP", "PTS", "W_PCT", "OTHER"], [10 + i, 100.5, 0.5, "x"], [99, 0, 0, ""])
            for i in range(1, 6)}
    base[6] = NO_SETS                                    # readable but empty; has an opponent row
    base[7] = NO_SETS                                    # nothing at all
    base[8] = TORN                                       # lost
    base[9] = json.dumps({"other": 1})                   # no result sets: lost
    opponent = {
        1: result_set(OPPONENT, [99.5, 0.4, 13]),
        2: result_set(["OPP_PTS", "OPP_FG_PCT"], [None, 0.4]),   # null stays, absent header is 0
        3: result_set(OPPONENT),                                 # no row
        4: TORN,
        6: result_set(OPPONENT, [1.0, 0.4, 13]),
        8: result_set(OPPONENT, [1.0, 0.4, 13]),
    }
    log = {
        1: result_set(LOG, [1, 2, "NOV 04, 2025", "W", 110, 5], [1, 1, "NOV 02, 2025", "L", 90, -5]),
        2: result_set(LOG, [1, 1, "NOV 04, 2025", "W", 110, 5]),
        3: result_set(LOG),
        5: TORN,
    }
    table = team_stats_table(frame(spark, base), frame(spark, opponent), frame(spark, log))
    return table, {r["TEAM_ID"]: r for r in records(table)}


def test_schema_is_fixed(wide):
    assert wide[0].columns == w.TEAM_STATS_COLUMNS == schemas.TEAM_STATS.names
    assert len(wide[0].columns) == 62
    assert [f.dataType for f in wide[0].schema] == [f.dataType for f in schemas.TEAM_STATS]


def test_which_teams_stay(wide):
    assert wide[1].keys() == {1, 2, 3, 4, 5, 6}


def test_base_takes_the_first_row(wide):
    row = wide[1][1]
    assert (row["TEAM_NAME"], row["GP"], row["PTS"], row["W_PCT"], row["FGM"]) == ("T1", 11, 100.5, 0.5, None)
    assert wide[1][6]["GP"] is None and wide[1][6]["OPP_PTS"] == 1.0


def test_opponent_defaults(wide):
    rows = wide[1]
    assert (rows[1]["OPP_PTS"], rows[1]["OPP_TOV"], rows[1]["OPP_REB"]) == (99.5, 13.0, 0.0)
    assert (rows[2]["OPP_PTS"], rows[2]["OPP_TOV"]) == (None, 0.0)
    for team in (3, 4, 5):
        assert all(rows[team][c] is None for c in w.OPPONENT_COLUMNS)


def test_empty_bucket_is_zero_but_no_log_is_null(wide):
    rows = wide[1]
    assert (rows[1]["REST_1_GP"], rows[1]["REST_1_W"], rows[1]["REST_1_PTS"]) == (1, 1, 110.0)
    assert rows[1]["REST_0_GP"] == 0 and rows[1]["REST_0_W_PCT"] == 0.0
    assert all(rows[2][c] == 0 for c in w.REST_COLUMNS)          # one game: no rest yet
    for team in (3, 4, 5, 6):
        assert all(rows[team][c] is None for c in w.REST_COLUMNS)


def test_game_log_rows(spark):
    docs = frame(spark, {1: result_set(LOG[:5], [1, 7, "NOV 04, 2025", None, 110.5], [1, 8, "", "L"])})
    assert records(team_stats.game_log(docs, ["TEAM_ID"]).orderBy("game_id")) == [
        dict(TEAM_ID=1, log_position=0, game_id=7, game_date_text="NOV 04, 2025", wl=None, pts=110.5, plus_minus=None),
        dict(TEAM_ID=1, log_position=1, game_id=8, game_date_text="", wl="L", pts=None, plus_minus=None),
    ]


def test_row_map(spark):
    from pyspark.sql import functions as F
    from courtline.functions.stats_json import row_map
    df = spark.createDataFrame([(["a", "b"], ["1", "2"]), (["a", "b"], ["1"]), (["a"], ["1", "2"])],
                               "h array<string>, r array<string>")
    assert [r[0] for r in df.select(row_map(F.col("h"), F.col("r"))).collect()] == [
        {"a": "1", "b": "2"}, {"a": "1"}, {"a": "1"}]
    odd = spark.createDataFrame([(["a", None, "a", "b"], ["1", "2", "3", None]), ([], ["1"]), (None, ["1"])],
                                "h array<string>, r array<string>")
    assert [r[0] for r in odd.select(row_map(F.col("h"), F.col("r"))).collect()] == [{"a": "3", "b": None}, {}, {}]


def test_last_of_equal_headers_and_numbers_with_decimals(spark):
    docs = frame(spark, {1: result_set(["GP", "W", "W", "PTS"], ["12.0", 3, "7.0", "x"])})
    [row] = records(team_stats.base_stats(docs, ["TEAM_ID"]))
    assert (row["GP"], row["W"], row["L"], row["PTS"]) == (12, 7, None, None)


def test_union_conform_and_preview(spark):
    a = spark.createDataFrame([("B", 1.0)], "TEAM_NAME string, PTS double")
    b = spark.createDataFrame([("A", 0.5, "x")], "TEAM_NAME string, W_PCT double, OTHER string")
    both = team_stats.union_stats(a, b)
    loose = team_stats.conform(both, strict=False)
    assert loose.columns == ["TEAM_NAME", "W_PCT", "PTS"]
    assert records(team_stats.preview(both)) == [
        dict(TEAM_NAME="A", W_PCT=0.5, PTS=None), dict(TEAM_NAME="B", W_PCT=None, PTS=1.0)]
    full = team_stats.conform(both)
    assert full.columns == w.TEAM_STATS_COLUMNS
    assert team_stats.preview(full, 1).columns == [
        "TEAM_NAME", "W_PCT", "PTS", "OPP_PTS", "PLUS_MINUS", "REST_0_W_PCT", "REST_2_W_PCT"]
    counts = {r["name"]: r["n"] for r in records(team_stats.row_counts(a=a, both=both))}
    assert counts == {"a": 1, "both": 2}
