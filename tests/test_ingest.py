"""Landed odds documents, one case per disposition."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from courtline import schemas
from courtline.operators import ingest
from tests.conftest import records

DAY = date(2025, 11, 4)
NEW_YORK = "America/New_York"


def ref(url):
    return {"$ref": url}


def team(name, role=None):
    out = {"team": ref(f"/team/{name}")}
    if role:
        out["homeAway"] = role
    return out


class Landed:
    """Collects documents; ``event`` adds one listed event with everything behind it."""

    def __init__(self):
        self.rows = []
        self.listed = []
        for name in ("A", "B"):
            self.add("team", f"/team/{name}", {"displayName": f"Team {name}"})
        self.add("team", "/team/none", {})
        self.add("team", "/team/torn", "{")

    def add(self, kind, url, body, page=0):
        self.rows.append(("nba", kind, url, page, body if isinstance(body, str) else json.dumps(body)))

    def event(self, key, event=None, competitors=None, odds="ref", items=(), competition=None, odds_body=None):
        self.listed.append(ref(f"/event/{key}"))
        body = {"date": "2025-11-04T17:30Z", "competitions": [ref(f"/comp/{key}")]}
        body.update(event or {})
        self.add("event", f"/event/{key}", {k: v for k, v in body.items() if v is not None})
        comp = {"competitors": competitors or [team("A", "away"), team("B", "home")]}
        if odds == "ref":
            comp["odds"] = ref(f"/odds/{key}")
        elif odds is not None:
            comp["odds"] = odds
        if competition != "missing":
            self.add("competition", f"/comp/{key}", competition or comp)
        if odds_body is not None:
            self.add("odds", f"/odds/{key}", odds_body)
        elif items is not None:
            self.add("odds", f"/odds/{key}", {"items": list(items)})

    def frame(self, spark):
        self.add("events", "/events", {"items": self.listed})
        return spark.createDataFrame(self.rows, schemas.DOCUMENTS)


OFFER = {"spread": -3.5, "overUnder": 220.5, "awayTeamOdds": {"moneyLine": 130}, "homeTeamOdds": {"moneyLine": -150}}


@pytest.fixture(scope="module")
def documents(spark):
    d = Landed()
    d.event("plain", items=[{"spread": 1.0}, OFFER])
    d.event("reversed", competitors=[team("B", "home"), team("A", "away")], items=[OFFER])
    d.event("one role", competitors=[team("B", "home"), team("A")], items=[OFFER])
    d.event("no name", competitors=[team("none", "away"), team("B", "home")], items=[OFFER])
    d.event("no price", items=[{"provider": {"name": "x"}}])
    d.event("null side", items=[{"spread": 2.0, "awayTeamOdds": None}])
    d.event("late", event={"date": "2025-11-05T04:30Z"}, items=[OFFER])        # still the 4th in New York
    d.event("next day", event={"date": "2025-11-05T05:30Z"}, items=[OFFER])
    d.event("no competition", event={"competitions": None})
    d.event("empty competitions", event={"competitions": []})
    d.event("no date", event={"date": None})
    d.event("bad date", event={"date": "soon"})
    d.event("no odds", odds=None)
    d.event("empty odds", odds={})
    d.event("no items", items=[])
    d.event("odds not landed", items=None)
    d.event("odds torn", odds_body='{"items": [')
    d.event("competition not landed", competition="missing")
    d.event("competition torn", competition='{"competitors": ')
    d.event("one team", competitors=[team("A", "away")], items=[OFFER])
    d.event("team not landed", competitors=[team("Z", "away"), team("B", "home")], items=[OFFER])
    d.event("team torn", competitors=[team("torn", "away"), team("B", "home")], items=[OFFER])
    d.listed.append(ref("/event/not landed"))
    return d.frame(spark)


EXPECTED = {
    "plain": "game", "reversed": "game", "one role": "game", "no name": "game", "no price": "game",
    "null side": "game", "late": "game", "next day": "wrong_date", "no competition": "no_competition",
    "empty competitions": "error", "no date": "no_date", "bad date": "error", "no odds": "no_odds",
    "empty odds": "no_odds", "no items": "no_odds", "odds not landed": "error", "odds torn": "error",
    "competition not landed": "error", "competition torn": "error", "one team": "error",
    "team not landed": "error", "team torn": "error", "not landed": "error",
}


def by_key(df):
    return {r["event_url"].removeprefix("/event/"): r for r in records(df)}


@pytest.mark.parametrize("teams, events", [(None, None), (30, None), (30, 100), (None, 10 ** 9)])
def test_outcomes(documents, teams, events):
    outcomes = ingest.event_outcomes(documents, NEW_YORK, DAY, DAY, teams, events)
    assert {k: r["disposition"] for k, r in by_key(outcomes).items()} == EXPECTED


def test_counts(documents):
    counts = ingest.disposition_counts(ingest.event_outcomes(documents, NEW_YORK, DAY, DAY))
    assert {r["disposition"]: r["n"] for r in records(counts)} == {
        d: list(EXPECTED.values()).count(d) for d in set(EXPECTED.values())}


def test_snapshot(documents):
    games = by_key(ingest.odds_snapshot(documents, NEW_YORK, DAY, DAY))
    assert games.keys() == {k for k, d in EXPECTED.items() if d == "game"}
    plain = games["plain"]
    assert (plain["sport"], plain["away_team"], plain["home_team"]) == ("NBA", "Team A", "Team B")
    assert (plain["spread"], plain["away_moneyline"], plain["home_moneyline"], plain["total"]) == (
        -3.5, 130.0, -150.0, 220.5)
    assert games["reversed"]["away_team"] == "Team A"
    assert games["one role"]["away_team"] == "Team B"      # both by position
    assert games["no name"]["away_team"] == "Unknown"
    assert games["no price"]["spread"] is None
    assert games["null side"]["spread"] == 2.0
    assert games["late"]["event_date"] == DAY


def test_few_events_leave_other_bodies_undecoded(documents):
    games = ingest.odds_snapshot(documents, NEW_YORK, DAY, DAY, 30, 100)
    plan = games._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") >= 2
    assert by_key(games).keys() == {k for k, d in EXPECTED.items() if d == "game"}


def test_every_date(documents):
    games = by_key(ingest.odds_snapshot(documents, NEW_YORK))
    assert games["next day"]["event_date"] == date(2025, 11, 5)
    utc = by_key(ingest.odds_snapshot(documents, "UTC", DAY, DAY))
    assert "late" not in utc


def test_pages_of_one_odds_document(spark):
    d = Landed()
    d.event("x", items=[{"spread": 1.0}])
    d.add("odds", "/odds/x", {"items": [{"overUnder": 1.0}, {"spread": 4.0, "overUnder": 2.0}]}, page=2)
    d.add("odds", "/odds/x", {"items": [{"spread": 3.0, "overUnder": 3.0}]}, page=1)
    [row] = records(ingest.odds_snapshot(d.frame(spark), "UTC"))
    assert (row["spread"], row["total"]) == (3.0, 3.0)


def test_many_fetches_at_once(spark):
    """The same URLs fetched twice: every reference stays within its own fetch."""
    fetches = []
    for stamp, price in (("20251104_0900", 1.0), ("20251104_1800", 2.0)):
        d = Landed()
        d.event("x", items=[{"spread": price}])
        d.event("y", items=[OFFER] if price == 2.0 else [])
        fetches.append(d.frame(spark).withColumn("snapshot", F.lit(stamp)))
    documents = fetches[0].unionByName(fetches[1])
    for bound in (None, 10):
        games = ingest.odds_snapshot(documents, "UTC", DAY, DAY, events_row_bound=bound, scope=["snapshot"])
        assert sorted((r["snapshot"], r["event_url"], r["spread"]) for r in records(games)) == [
            ("20251104_0900", "/event/x", 1.0), ("20251104_1800", "/event/x", 2.0),
            ("20251104_1800", "/event/y", -3.5)]
    outcomes = ingest.event_outcomes(documents, "UTC", DAY, DAY, scope=["snapshot"])
    assert outcomes.count() == 4 and outcomes.columns[0] == "snapshot"


def test_roles(spark):
    competitors = [
        [("away", "1"), ("home", "2")], [("home", "1"), ("away", "2")], [(None, "1"), ("home", "2")],
        [("away", "1"), (None, "2")], [("away", "1")], []]
    rows = [(i, [{"homeAway": r, "team": {"$ref": t}} for r, t in c]) for i, c in enumerate(competitors)]
    df = spark.createDataFrame(rows, "i int, c array<struct<homeAway: string, team: struct<`$ref`: string>>>")
    away, home = ingest.sides(F.col("c"))
    out = df.orderBy("i").select(away["team"]["$ref"].alias("a"), home["team"]["$ref"].alias("h")).collect()
    assert [tuple(r) for r in out] == [
        ("1", "2"), ("2", "1"), ("1", "2"), ("1", "2"), ("1", None), (None, None)]


def test_local_date_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.sql("SELECT id, TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, CAST(id AS INT)) AS ts "
              "FROM range(240)").write.parquet(path)
    found = ingest.on_local_dates(spark.read.parquet(path), "ts", "-05:00", date(2024, 1, 5), date(2024, 1, 6))
    assert sorted(r["id"] for r in records(found)) == list(range(4 * 24 + 5, 6 * 24 + 5))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in found._jdf.queryExecution().executedPlan().toString()
    [span] = records(ingest.event_date_range(spark.read.parquet(path), "ts", "-05:00"))
    assert span == {"first_date": date(2023, 12, 31), "last_date": date(2024, 1, 10)}
