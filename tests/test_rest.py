"""Days of rest and rest splits against a loop over each team's games."""

import math
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtline import wording as w
from courtline.functions.dates import game_date
from courtline.operators.rest import days_rest, rest_splits, rest_splits_of_days, rest_splits_wide, rest_splits_wide_of_days
from courtline.sources import rest_state
from tests.conftest import records

LOG = "team_id long, game_id long, game_date_text string, wl string, pts double, plus_minus double"
MONTHS = "JAN FEB MAR APR MAY JUN JUL AUG SEP OCT NOV DEC".split()


def text_of(day):
    return f"{MONTHS[day.month - 1]} {day.day:02d}, {day.year}"


def day_of(text):
    month, day, year = text.replace(",", "").split()
    return date(int(year), MONTHS.index(month) + 1, int(day))


def random_log(seed):
    """Team 1 plays a third of all games; some dates are blank, some days hold several games."""
    rng = random.Random(seed)
    rows = []
    for game in range(400):
        team = 1 if game % 3 == 0 else rng.randrange(2, 9)
        day = date(2025, 10, 20) + timedelta(days=rng.randrange(0, 190))
        text = text_of(day) if rng.random() > 0.05 else rng.choice(["", None])
        rows.append((team, game, text, rng.choice(["W", "L", None]),
                     float(rng.randrange(80, 140)), float(rng.randrange(-20, 20))))
    rows.append((20, 900, text_of(date(2025, 11, 4)), "W", 100.0, 1.0))   # a single game
    rows.append((21, 901, "", "W", 100.0, 1.0))                           # only an undated one
    rng.shuffle(rows)
    return rows


def loop(rows, order_mode):
    """game id -> (days of rest, bucket)."""
    out = {}
    for team in {r[0] for r in rows}:
        dated = [r for r in rows if r[0] == team and r[2]]
        key = (lambda r: (r[2], r[1])) if order_mode == "text" else (lambda r: (day_of(r[2]), r[1]))
        previous = None
        for row in sorted(dated, key=key):
            rest = None if previous is None else (day_of(row[2]) - previous).days - 1
            bucket = None if rest is None else str(rest) if rest in (0, 1, 2, 3) else "4+"
            out[row[1]] = (rest, bucket)
            previous = day_of(row[2])
    return out


def splits(rows, order_mode):
    found = loop(rows, order_mode)
    out = {}
    for row in rows:
        bucket = found.get(row[1], (None, None))[1]
        if bucket:
            out.setdefault((row[0], bucket), []).append(row)
    return {
        key: dict(GP=len(g), W=sum(r[3] == "W" for r in g), L=sum(r[3] != "W" for r in g),
                  W_PCT=sum(r[3] == "W" for r in g) / len(g), PTS=sum(r[4] for r in g) / len(g),
                  PLUS_MINUS=sum(r[5] for r in g) / len(g))
        for key, g in out.items()
    }


def same(a, b):
    return all(math.isclose(a[m], b[m], abs_tol=1e-9) for m in w.REST_METRICS)


@pytest.mark.parametrize("order_mode", ["date", "text"])
def test_against_the_loop(spark, order_mode):
    rows = random_log(7)
    log = spark.createDataFrame(rows, LOG).repartition(5)
    got = {r["game_id"]: (r["days_rest"], r["rest_bucket"]) for r in records(days_rest(log, order_mode=order_mode))}
    assert got == loop(rows, order_mode)

    expected = splits(rows, order_mode)
    long = {(r["team_id"], r["rest_bucket"]): r for r in records(rest_splits(log, order_mode=order_mode))}
    assert long.keys() == expected.keys()
    assert all(same(long[k], expected[k]) for k in expected)
    assert all(r["GP"] == r["W"] + r["L"] for r in long.values())

    zero = dict.fromkeys(w.REST_METRICS, 0)
    wide = {r["team_id"]: r for r in records(rest_splits_wide(log, order_mode=order_mode))}
    assert wide.keys() == {r[0] for r in rows}
    for team, row in wide.items():
        for bucket in w.REST_BUCKETS:
            cells = {m: row[w.rest_column(bucket, m)] for m in w.REST_METRICS}
            assert same(cells, expected.get((team, bucket), zero)), (team, bucket)
        dated = sum(1 for r in rows if r[0] == team and r[2])
        assert sum(row[w.rest_column(b, "GP")] for b in w.REST_BUCKETS) == max(dated - 1, 0)


def test_orders_differ_only_where_months_change(spark):
    rows = [(1, 1, "OCT 30, 2025", "W", 1.0, 1.0), (1, 2, "NOV 01, 2025", "W", 1.0, 1.0),
            (1, 3, "NOV 03, 2025", "W", 1.0, 1.0), (1, 4, "DEC 01, 2025", "W", 1.0, 1.0)]
    log = spark.createDataFrame(rows, LOG)
    by_date = {r["game_id"]: r["days_rest"] for r in records(days_rest(log))}
    by_text = {r["game_id"]: r["days_rest"] for r in records(days_rest(log, order_mode="text"))}
    assert by_date == {1: None, 2: 1, 3: 1, 4: 27}
    assert by_text == {4: None, 2: -31, 3: 1, 1: -5}
    with pytest.raises(ValueError):
        days_rest(log, order_mode="other")


def test_typed_dates(spark):
    log = spark.createDataFrame(random_log(3), LOG)
    typed = log.withColumn("game_date", game_date(F.col("game_date_text"))).drop("game_date_text")
    for operator in (days_rest, rest_splits_wide):
        as_text, as_date = operator(log), operator(typed)
        columns = [c for c in as_date.columns if c in as_text.columns]
        assert sorted(map(str, records(as_text.select(*columns)))) == sorted(map(str, records(as_date.select(*columns))))


def test_missing_numbers_count_as_zero(spark):
    rows = [(1, 1, "NOV 01, 2025", "W", 90.0, 1.0), (1, 2, "NOV 02, 2025", None, None, None),
            (1, 3, "NOV 03, 2025", "W", 100.0, 4.0)]
    [row] = records(rest_splits(spark.createDataFrame(rows, LOG)))
    assert (row["GP"], row["W"], row["L"], row["PTS"], row["PLUS_MINUS"]) == (2, 1, 1, 50.0, 2.0)


def test_wide_form_reuses_the_window_grouping(spark):
    plan = rest_splits_wide(spark.createDataFrame(random_log(1), LOG))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert "SortAggregate" not in plan


@pytest.mark.parametrize("kind", ["absent", "repeated", "null"])
def test_games_without_ids_of_their_own(spark, kind):
    """The first game of a day is picked exactly once, and both forms agree game by game."""
    rows = random_log(11)
    place = {row: k for k, row in enumerate(rows)}
    log = spark.createDataFrame([(*row, place[row]) for row in rows], LOG + ", log_position long")
    if kind == "absent":
        log = log.drop("game_id")
    else:
        log = log.withColumn("game_id", F.lit(5 if kind == "repeated" else None).cast("long"))
    # The loop takes the log order within a day.
    by_place = [(t, place[r], d, *rest) for r in rows for t, _, d, *rest in [r]]
    found, expected = loop(by_place, "date"), splits(by_place, "date")
    got = {r["log_position"]: (r["days_rest"], r["rest_bucket"]) for r in records(days_rest(log))}
    assert got == found
    long = {(r["team_id"], r["rest_bucket"]): r for r in records(rest_splits(log))}
    assert long.keys() == expected.keys() and all(same(long[k], expected[k]) for k in expected)


def test_a_log_without_ids_and_places_picks_one_first_game_a_day(spark):
    rows = [(1, "NOV 01, 2025", "W", 90.0, 1.0)] * 3 + [(1, "NOV 04, 2025", "L", 80.0, -1.0)] * 2
    log = spark.createDataFrame(rows, "team_id long, game_date_text string, wl string, pts double, plus_minus double")
    got = sorted((r["game_date_text"], str(r["days_rest"])) for r in records(days_rest(log)))
    assert got == [("NOV 01, 2025", "-1"), ("NOV 01, 2025", "-1"), ("NOV 01, 2025", "None"),
                   ("NOV 04, 2025", "-1"), ("NOV 04, 2025", "2")]
    assert {r["rest_bucket"]: (r["GP"], r["W"]) for r in records(rest_splits(log))} == {"2": (1, 0), "4+": (3, 2)}


def test_textual_ids_are_taken_in_the_order_of_the_log(spark):
    rows = random_log(11)
    named = [(t, f"G-{g}", d, wl, p, m, k) for k, (t, g, d, wl, p, m) in enumerate(sorted(rows, key=lambda r: r[1]))]
    schema = LOG.replace("game_id long", "game_id string") + ", log_position long"
    textual = spark.createDataFrame(named, schema).repartition(5)
    got = {r["game_id"]: (r["days_rest"], r["rest_bucket"]) for r in records(days_rest(textual))}
    assert got == {f"G-{g}": v for g, v in loop(rows, "date").items()}
    numbers = spark.createDataFrame(rows, LOG)
    for split in (rest_splits, rest_splits_wide):
        assert sorted(map(str, records(split(textual)))) == sorted(map(str, records(split(numbers))))
    # Without places the result still depends on the rows alone.
    bare = textual.drop("log_position")
    once = sorted(map(str, records(days_rest(bare))))
    assert once == sorted(map(str, records(days_rest(bare.repartition(3)))))
    mixed = numbers.withColumn("game_id", F.when(F.col("game_id") % 2 == 0, F.col("game_id").cast("string")).otherwise("id?"))
    assert days_rest(mixed).count() == len(loop(rows, "date"))


@pytest.mark.parametrize("order_mode", ["date", "text"])
def test_kept_splits_equal_a_full_run(spark, tmp_path, order_mode):
    rows = random_log(12)
    log = spark.createDataFrame(rows, LOG)
    path, team_ = str(tmp_path / "days"), T.StructType([log.schema["team_id"]])

    def kept():
        return rest_state.read_game_days(spark, path, team_, order_mode)

    batches = {f"b{k}": log.filter(F.col("game_id") % 5 == k) for k in range(5)}
    for name in ("b3", "b0", "b4"):
        rest_state.add_games(batches[name], path, name, order_mode=order_mode)
    rest_state.add_games(batches["b1"], path, "b0", order_mode=order_mode)      # a mistake,
    rest_state.add_games(batches["b0"], path, "b0", order_mode=order_mode)      # replaced
    before = kept()
    seen = sorted(map(str, records(before)))
    assert rest_state.merge_batches(spark, path, team_, "merged").rows
    assert sorted(map(str, records(kept()))) == seen == sorted(map(str, records(before)))
    with pytest.raises(ValueError):
        rest_state.add_games(batches["b0"], path, "b0", order_mode=order_mode)
    for name in ("b2", "b1"):
        rest_state.add_games(batches[name], path, name, order_mode=order_mode)

    def rounded(df):
        return sorted(str({k: round(v, 9) if isinstance(v, float) else v for k, v in r.items()}) for r in records(df))

    assert rounded(rest_splits_of_days(kept())) == rounded(rest_splits(log, order_mode=order_mode))
    assert rounded(rest_splits_wide_of_days(kept())) == rounded(rest_splits_wide(log, order_mode=order_mode))
    rest_state.merge_batches(spark, path, team_, "merged")
    assert rounded(rest_splits_of_days(kept())) == rounded(rest_splits(log, order_mode=order_mode))


def test_no_games_kept(spark, tmp_path):
    team_ = T.StructType([T.StructField("team_id", T.LongType())])
    assert rest_splits_of_days(rest_state.read_game_days(spark, str(tmp_path / "none"), team_)).count() == 0
    rest_state.add_games(spark.createDataFrame([], LOG), str(tmp_path / "none"), "b")
    assert rest_splits_of_days(rest_state.read_game_days(spark, str(tmp_path / "none"), team_)).count() == 0
