"""Best offer, latest snapshot, next game day: against brute force."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from courtline import schemas
from courtline import wording as w
from courtline.operators import selection
from courtline.operators.selection import best_offer, best_offer_of_items, latest_snapshot, next_game_day
from tests.conftest import records

OFFER = "event_id long, pos int, spread double, away_moneyline double, home_moneyline double, total double"


def random_offers(seed, hot_share=3):
    """Offers of 40 games; every ``hot_share``-th offer belongs to game 0."""
    rng = random.Random(seed)
    rows, positions = [], {}
    for i in range(900):
        event = 0 if i % hot_share == 0 else rng.randrange(1, 40)
        positions[event] = positions.get(event, -1) + 1
        rows.append((event, positions[event],
                     *(rng.choice([None, float(rng.randrange(-9, 9))]) for _ in range(4))))
    rng.shuffle(rows)
    return rows


def brute_best(rows):
    best = {}
    for row in sorted(rows, key=lambda r: (r[0], r[1])):
        filled = sum(v is not None for v in row[2:])
        if row[0] not in best or filled > best[row[0]][0]:
            best[row[0]] = (filled, row)
    return {event: row for event, (_, row) in best.items()}


@pytest.mark.parametrize("position_type", ["int", "long"])
def test_best_offer(spark, position_type):
    """Whatever the type of the position."""
    rows = random_offers(1)
    offers = spark.createDataFrame(rows, OFFER).withColumn("pos", F.col("pos").cast(position_type)).repartition(7)
    got = {r["event_id"]: (r["event_id"], r["pos"], *(r[c] for c in w.PRICE_COLUMNS))
           for r in records(best_offer(offers))}
    assert got == brute_best(rows)


def test_best_offer_by_several_columns(spark):
    offers = spark.createDataFrame(
        [(1, "b", 1, 5.0), (1, "a", 2, 6.0), (1, "a", 1, 7.0), (1, "a", 0, None)],
        "event_id long, book string, pos int, spread double")
    for c in w.PRICE_COLUMNS[1:]:
        offers = offers.withColumn(c, F.lit(None).cast("double"))
    [row] = records(best_offer(offers, order=["book", "pos"]))
    assert (row["book"], row["pos"], row["spread"], row["n_fields"]) == ("a", 1, 7.0, 1)


def test_sole_offer_without_prices_is_chosen(spark):
    [row] = records(best_offer(spark.createDataFrame([(5, 0, None, None, None, None)], OFFER)))
    assert row["event_id"] == 5 and row["n_fields"] == 0


@pytest.mark.parametrize("order", [["pos"], ["pos", "book"], ["book"]])
def test_equal_positions_give_the_same_offer_for_every_partitioning(spark, order):
    rng = random.Random(4)
    rows = [(rng.randrange(4), rng.choice([None, 0, 1]), rng.choice([None, "a"]), *(rng.choice([None, 1.0, -1.0]) for _ in range(4)))
            for _ in range(300)]
    rows += rows[:20]

    def key(r):
        """Most prices, then the order with nulls last, then the prices with nulls first."""
        named = dict(zip(("event_id", "pos", "book", *w.PRICE_COLUMNS), r, strict=True))
        return (sum(x is None for x in r[3:]), [(named[o] is None, named[o] or 0) if named[o] is None or not isinstance(named[o], str)
                else (False, named[o]) for o in order], [(x is not None, x or 0.0) for x in r[3:]])

    want = {e: min((r for r in rows if r[0] == e), key=key) for e in range(4)}
    for n in (1, 2, 3, 7):
        for some in (rows, rows[::-1]):
            offers = spark.createDataFrame(some, OFFER.replace("pos int", "pos int, book string")).repartition(n)
            got = {r["event_id"]: r for r in records(best_offer(offers, order=order))}
            assert {e: [got[e][c] for c in w.PRICE_COLUMNS] for e in got} == {e: list(r[3:]) for e, r in want.items()}
            assert all(got[e][o] == want[e][1 if o == "pos" else 2] for e in got for o in order)


def test_best_offer_of_items(spark):
    bodies = [
        '{"items":[{"spread":1},{"spread":2,"overUnder":200},{"spread":3,"awayTeamOdds":{"moneyLine":5}}]}',
        '{"items":[{"provider":{"name":"x"},"awayTeamOdds":null}]}',
        '{"items":[]}',
        '{}',
    ]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string")
    out = df.select("i", best_offer_of_items(F.from_json("body", schemas.ODDS_BODY)["items"]).alias("b"))
    first, bare, empty, absent = (r["b"] for r in records(out.orderBy("i")))
    assert (first["index"], first["spread"], first["total"]) == (1, 2.0, 200.0)
    assert bare["missing"] == 4 and bare["index"] == 0
    assert empty is None and absent is None


@pytest.mark.parametrize("type_", ["timestamp", "timestamp_ntz", "date", "string"])
@pytest.mark.parametrize("groups", [3, 200])
def test_latest_snapshot(spark, type_, groups):
    """The group null is one like any other, however many there are."""
    rng = random.Random(groups)
    rows = [(f"s{g}" if g else None, str(datetime(2025, 11, rng.randrange(1, 6), rng.randrange(0, 3), 30)), n)
            for g in range(groups) for n in range(4)]
    if type_ == "date":
        rows = [(s, t[:10], n) for s, t, n in rows]
    df = spark.createDataFrame(rows, "sport string, t string, n int").withColumn("snapshot_ts", F.col("t").cast(type_))
    newest = {}
    for sport, t, _ in rows:
        newest[sport] = max(t, newest.get(sport, ""))
    got = sorted((str(r["sport"]), r["t"], r["n"]) for r in records(latest_snapshot(df)))
    assert got == sorted((str(s), t, n) for s, t, n in rows if newest[s] == t)


def test_the_extremes_are_worked_out_once_and_the_table_is_not_shuffled(spark):
    df = spark.range(1000).selectExpr("id % 7 as sport", "id as snapshot_ts", "rand() as x")
    plan = latest_snapshot(df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "Aggregate" not in plan


def test_more_groups_than_the_driver_may_know(spark, monkeypatch):
    monkeypatch.setattr(selection, "KNOWN_GROUPS", 5)
    df = spark.range(1000).selectExpr("nullif(id % 50, 3) as sport", "id as snapshot_ts")
    newest = latest_snapshot(df)
    assert sorted(r["snapshot_ts"] for r in records(newest)) == list(range(950, 1000))
    assert "Aggregate" in newest._jdf.queryExecution().executedPlan().toString()


def test_latest_snapshot_of_nothing(spark):
    empty = spark.createDataFrame([], "sport string, snapshot_ts timestamp")
    assert latest_snapshot(empty).count() == 0


def test_missing_positions_are_last_for_every_type(spark):
    rows = [(1, None, 1.0, None, None, None), (2, None, 1.0, None, None, None), (2, 7, 2.0, None, None, None),
            (3, None, None, None, None, None)]
    expected = [(1, None, 1.0, 1), (2, 7, 2.0, 1), (3, None, None, 0)]
    for type_ in ("int", "long", "decimal(20,0)"):
        offers = spark.createDataFrame(rows, OFFER).withColumn("pos", F.col("pos").cast(type_))
        got = sorted((r["event_id"], r["pos"] and int(r["pos"]), r["spread"], r["n_fields"]) for r in records(best_offer(offers)))
        assert got == expected


def test_next_game_day(spark):
    rows = [("nba", date(2025, 11, 8)), ("nba", date(2025, 11, 10)), ("nba", date(2025, 11, 11)),
            ("nfl", date(2025, 11, 11)), ("nfl", date(2025, 11, 11)), ("mlb", date(2025, 11, 12)),
            ("mlb", None)]
    df = spark.createDataFrame(rows, "sport string, event_date date")
    got = sorted((r["sport"], r["event_date"]) for r in records(next_game_day(df, date(2025, 11, 9))))
    assert got == [("nba", date(2025, 11, 10)), ("nfl", date(2025, 11, 11)), ("nfl", date(2025, 11, 11))]
    assert next_game_day(df, date(2025, 12, 1)).count() == 0
