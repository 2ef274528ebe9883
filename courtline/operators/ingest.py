"""Landed odds documents -> one row per game.

Documents refer to one another by URL: event list -> event -> competition ->
two teams and one odds document.  Every hop is an equi-join, and each kind of
document is decoded and cut down to the needed fields before it is shuffled.

Documents are those of one fetch.  Of a table holding many fetches, name the
columns that tell them apart (say a snapshot time) as ``scope``: references are
then followed within each fetch, all fetches at once.

What the functions below take as ``documents`` is either a table of raw bodies or
a :class:`Source`, such as the tables of bodies decoded at landing.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtline import schemas
from courtline import wording as w
from courtline.functions.dates import event_local_date, local_date_of_utc, utc_window
from courtline.operators.bounds import fits, small_side
from courtline.operators.selection import best_offer_of_items

GAME = "game"
NO_COMPETITION = "no_competition"
NO_DATE = "no_date"
WRONG_DATE = "wrong_date"
NO_ODDS = "no_odds"
ERROR = "error"

EVENT_UNREADABLE = "event missing or unreadable"
COMPETITION_UNREADABLE = "competition missing or unreadable"
ODDS_UNREADABLE = "odds missing or unreadable"

_NO_REFERENCE = "no reference from "
# Documents behind an event, in the order in which they are followed.
_HOPS = ("competition", "away", "home", "odds")

def decode(documents: DataFrame, kind: str, body: str, scope: Sequence[str] = ()) -> DataFrame:
    """Documents of one kind with their decoded body and whether it was unreadable.

    The body leaves through `explode_outer`, so that filters on its fields are
    not moved below it and decode it again.
    """
    parsed = F.from_json(
        "body", f"{body}, _corrupt_record string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"},
    )
    return (
        documents.filter(F.col("kind") == kind)
        .select(*scope, "sport", "url", "page", F.explode_outer(F.array(parsed)).alias("doc"))
        .withColumn("unreadable", F.col("doc").isNull() | F.col("doc._corrupt_record").isNotNull())
    )


def sides(competitors: Column) -> tuple[Column, Column]:
    """Away and home competitor.

    Taken by their declared role; if either role is missing, both are taken by
    position: away first, home second.
    """
    def declared(role: str) -> Column:
        return F.try_element_at(F.filter(competitors, lambda c: c["homeAway"] == role), F.lit(-1))

    away, home = declared("away"), declared("home")
    both = away.isNotNull() & home.isNotNull()
    return (
        F.when(both, away).otherwise(F.get(competitors, F.lit(0))),
        F.when(both, home).otherwise(F.get(competitors, F.lit(1))),
    )


def listed_events(documents: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Every event reference of the event lists."""
    lists = decode(documents, "events", schemas.EVENT_LIST_BODY, scope)
    return lists.select(*scope, "sport", F.explode("doc.items").alias("item")).select(
        *scope, "sport", F.col("item")["$ref"].alias("event_url")
    ).distinct()


def _one_each(decoded: DataFrame, keys: Sequence[str], apart: bool = False) -> DataFrame:
    """One row for each URL, should a fetch have landed twice: a readable one, if any.

    The join that follows has the same keys, so this adds no shuffle of its own;
    where the other side may have hot keys, ``apart`` keeps the join's own shuffle,
    which can be split.
    """
    others = [c for c in decoded.columns if c not in keys]
    window = Window.partitionBy(F.struct(*keys) if apart else keys).orderBy(*others)
    return decoded.withColumn("copy", F.row_number().over(window)).filter("copy = 1").drop("copy")


def event_fields(documents: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """What the hops need of event bodies."""
    return decode(documents, "event", schemas.EVENT_BODY, scope).select(
        *scope,
        F.col("url").alias("event_url"),
        "unreadable",
        F.col("doc.date").alias("date_text"),
        F.col("doc.competitions").isNotNull().alias("has_competitions"),
        F.get("doc.competitions", F.lit(0))["$ref"].alias("competition_url"),
    )


def competition_fields(documents: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    away, home = sides(F.col("doc.competitors"))
    return decode(documents, "competition", schemas.COMPETITION_BODY, scope).select(
        *scope,
        F.col("url").alias("competition_url"),
        F.col("unreadable").alias("competition_unreadable"),
        away["team"]["$ref"].alias("away_ref"),
        home["team"]["$ref"].alias("home_ref"),
        F.col("doc.odds")["$ref"].alias("odds_ref"),
    )


def team_fields(documents: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Readable team documents."""
    return decode(documents, "team", schemas.TEAM_BODY, scope).filter(~F.col("unreadable")).select(
        *scope,
        F.col("url").alias("team_url"),
        F.coalesce("doc.displayName", F.lit(w.UNKNOWN_TEAM)).alias("name"),
    )


def odds_fields(documents: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """The best offer of every odds body."""
    return decode(documents, "odds", schemas.ODDS_BODY, scope).select(
        *scope, F.col("url").alias("odds_url"), "page", "unreadable",
        best_offer_of_items(F.col("doc.items")).alias("best"),
    )


class Source:
    """Where the hops find their documents: raw bodies, decoded when a hop gets to them."""

    def __init__(self, documents: DataFrame, scope: Sequence[str] = ()):
        self.documents, self.scope = documents, tuple(scope)

    def listed(self) -> DataFrame:
        return listed_events(self.documents, self.scope)

    def events(self, first: date | None = None, last: date | None = None) -> DataFrame:
        """All events, or at least those that may be dated ``first..last`` in any zone."""
        return event_fields(self.documents, self.scope)

    def competitions(self, urls: DataFrame, row_bound: int | None) -> DataFrame:
        return competition_fields(_referenced(self.documents, "competition", urls, row_bound, self.scope), self.scope)

    def teams(self) -> DataFrame:
        return team_fields(self.documents, self.scope)

    def odds(self, urls: DataFrame, row_bound: int | None) -> DataFrame:
        return odds_fields(_referenced(self.documents, "odds", urls, row_bound, self.scope), self.scope)


def _source(documents: DataFrame | Source, scope: Sequence[str]) -> Source:
    return documents if isinstance(documents, Source) else Source(documents, scope)


def dated_events(documents: DataFrame | Source, zone: str, first: date | None = None, last: date | None = None,
                 scope: Sequence[str] = (), others: bool = True) -> DataFrame:
    """Listed events with their local date and, if they stop here, their disposition and its reason.

    Only events dated ``first..last`` (inclusive, both optional) stay open
    (null disposition).  Without ``others`` a source may leave out events of
    other dates, which then seem to be missing.
    """
    source = _source(documents, scope)
    scope = source.scope
    events = source.events() if others else source.events(first, last)
    event_date = event_local_date(F.col("date_text"), zone)
    wrong = F.lit(False)
    if first is not None:
        wrong = wrong | (F.col("event_date") < F.lit(first))
    if last is not None:
        wrong = wrong | (F.col("event_date") > F.lit(last))
    stops = (
        (F.coalesce("unreadable", F.lit(True)), ERROR, EVENT_UNREADABLE),
        (~F.col("has_competitions"), NO_COMPETITION, "event without competitions"),
        (F.col("date_text").isNull(), NO_DATE, "event without date"),
        (F.col("event_date").isNull(), ERROR, "event date unreadable"),
        (wrong, WRONG_DATE, "event of another date"),
    )
    return (
        source.listed().join(_one_each(events, [*scope, "event_url"]), [*scope, "event_url"], "left")
        .withColumn("event_date", event_date)
        .withColumns(_stopped(stops))
        .select(*scope, "sport", "event_url", "event_date", "competition_url", "disposition", "reason")
    )


def _referenced(documents: DataFrame, kind: str, urls: DataFrame, row_bound: int | None,
                scope: Sequence[str]) -> DataFrame:
    """Documents of a kind, cut to the referenced URLs before they are decoded.

    Only if those are known to be few: then they are broadcast and the other
    bodies are neither decoded nor shuffled.  Otherwise every body is decoded and
    cut down to a few numbers first, which is cheaper than shuffling raw bodies.
    """
    wanted = documents.filter(F.col("kind") == kind)
    if not fits(urls, row_bound):
        return wanted
    return wanted.join(F.broadcast(urls), [*scope, "url"], "left_semi")


def _best_prices(bodies: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Best offer per odds URL: chosen within each body already, here across its pages."""
    offer = F.when(F.col("best").isNotNull(), F.struct(
        F.col("best.missing").alias("missing"), F.col("page").isNull().alias("no_page"), "page",
        F.col("best.index").alias("index"), *(F.col("best")[c].alias(c) for c in w.PRICE_COLUMNS)))
    return bodies.groupBy(*scope, "odds_url").agg(
        F.bool_or("unreadable").alias("odds_unreadable"), F.bool_or(F.col("best").isNotNull()).alias("has_offer"),
        F.min(offer).alias("best")).select(
        *scope, "odds_url", "odds_unreadable", "has_offer", *(F.col(f"best.{c}") for c in w.PRICE_COLUMNS))


def _key(reference: Column) -> Column:
    """Join key of an optional reference: rows without one spread over all tasks, matching nothing."""
    return F.coalesce(reference, F.concat(F.lit(_NO_REFERENCE), F.col("event_url")))


def _stopped(stops: Sequence[tuple[Column, str, str]], otherwise: str | None = None) -> dict[str, Column]:
    """``disposition`` and ``reason`` by the first condition that holds."""
    disposition, reason = F.lit(otherwise), F.lit(None).cast("string")
    for condition, outcome, why in reversed(stops):
        disposition = F.when(condition, outcome).otherwise(disposition)
        reason = F.when(condition, why).otherwise(reason)
    return {"disposition": disposition, "reason": reason}


def resolve(documents: DataFrame | Source, events: DataFrame, teams_row_bound: int | None = None,
            events_row_bound: int | None = None, scope: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Follow open events to teams and best prices; every one gets a disposition.  ``keep`` names further columns of theirs.

    The bounds are proven upper limits on the number of team documents and of
    ``events``, if known; small ones save shuffles and decoding.
    """
    source = _source(documents, scope)
    scope = source.scope
    competitions = source.competitions(events.select(*scope, F.col("competition_url").alias("url")), events_row_bound)
    teams = _one_each(source.teams(), [*scope, "team_url"], apart=True)
    out = (
        events.withColumn("competition_url", _key(F.col("competition_url")))
        .join(_one_each(competitions, [*scope, "competition_url"]), [*scope, "competition_url"], "left")
    )
    bodies = source.odds(out.select(*scope, F.col("odds_ref").alias("url")), events_row_bound)
    for role in ("away", "home"):
        side = teams.select(*scope, F.col("team_url").alias(f"{role}_url"), F.col("name").alias(f"{role}_team"))
        out = out.withColumn(f"{role}_url", _key(F.col(f"{role}_ref"))).join(
            small_side(side, teams_row_bound), [*scope, f"{role}_url"], "left"
        )
    out = out.withColumn("odds_url", _key(F.col("odds_ref"))).join(
        _best_prices(bodies, scope), [*scope, "odds_url"], "left"
    )
    stops = (
        (F.coalesce("competition_unreadable", F.lit(True)), ERROR, COMPETITION_UNREADABLE),
        (F.col("away_team").isNull(), ERROR, "away team missing or unreadable"),
        (F.col("home_team").isNull(), ERROR, "home team missing or unreadable"),
        (F.col("odds_ref").isNull(), NO_ODDS, "competition without odds"),
        (F.coalesce("odds_unreadable", F.lit(True)), ERROR, ODDS_UNREADABLE),
        (~F.col("has_offer"), NO_ODDS, "odds without offers"),
    )
    return out.withColumns(_stopped(stops, GAME)).select(
        *scope, F.upper("sport").alias("sport"), "event_url", "event_date", "away_team", "home_team",
        *w.PRICE_COLUMNS, "disposition", "reason",
        *(F.when(~F.col(f"{c}_url").startswith(_NO_REFERENCE), F.col(f"{c}_url")).alias(f"{c}_url") for c in _HOPS), *keep,
    )


def open_events(documents: DataFrame | Source, zone: str, first: date | None = None,
                last: date | None = None, scope: Sequence[str] = ()) -> DataFrame:
    """Listed events dated ``first..last`` that are worth following."""
    events = dated_events(documents, zone, first, last, scope, others=False)
    return events.filter(F.col("disposition").isNull()).drop("disposition", "reason")


def odds_snapshot(documents: DataFrame | Source, zone: str, first: date | None = None,
                  last: date | None = None, teams_row_bound: int | None = None,
                  events_row_bound: int | None = None, scope: Sequence[str] = ()) -> DataFrame:
    """One row per game dated ``first..last`` with the prices of its best provider.

    Events of other dates are dropped before any further hop.
    """
    events = open_events(documents, zone, first, last, scope)
    games = resolve(documents, events, teams_row_bound, events_row_bound, scope)
    return games.filter(F.col("disposition") == GAME).drop("disposition", "reason", *(f"{c}_url" for c in _HOPS))


def event_outcomes(documents: DataFrame | Source, zone: str, first: date | None = None,
                   last: date | None = None, teams_row_bound: int | None = None,
                   events_row_bound: int | None = None, scope: Sequence[str] = ()) -> DataFrame:
    """Every listed event with what became of it (see the constants above).

    ``disposition`` and, unless it is a game, the ``reason``; games with all that
    :func:`odds_snapshot` gives, others with as much as was found; and the URLs of
    the documents that were followed.
    """
    events = dated_events(documents, zone, first, last, scope).withColumnsRenamed({"disposition": "stopped", "reason": "because"})
    # Events that stop here go along without a reference, which matches nothing.
    open_ = events.withColumn("competition_url", F.when(F.col("stopped").isNull(), F.col("competition_url")))
    followed = resolve(documents, open_, teams_row_bound, events_row_bound, scope, keep=("stopped", "because"))
    return followed.withColumns({
        "disposition": F.coalesce("stopped", "disposition"),
        "reason": F.when(F.col("stopped").isNotNull(), F.col("because")).otherwise(F.col("reason")),
    }).drop("stopped", "because")


def rejected_documents(outcomes: DataFrame, documents: DataFrame, scope: Sequence[str] = (),
                       row_bound: int | None = None) -> DataFrame:
    """The quarantine: every listed event that was dropped by an error, with the body to blame.

    ``document_url`` is that of the event, or of the document behind it that could
    not be followed; ``body`` is null if there is no such document.  A document of
    several pages gives a row for each.  ``row_bound`` is a proven upper limit on
    the errors, if known: of few ones only the URLs are sent out, and no body of
    any other document is shuffled.
    """
    blamed = (
        F.when(F.col("reason") == COMPETITION_UNREADABLE, F.col("competition_url"))
        .when(F.col("reason").startswith("away team"), F.col("away_url"))
        .when(F.col("reason").startswith("home team"), F.col("home_url"))
        .when(F.col("reason") == ODDS_UNREADABLE, F.col("odds_url"))
        .otherwise(F.col("event_url"))
    )
    errors = outcomes.filter(F.col("disposition") == ERROR).select(
        *scope, "sport", "event_url", "event_date", "reason", blamed.alias("document_url"))
    keys = [*scope, "document_url"]
    bodies = documents.select(*scope, F.col("url").alias("document_url"), "page", "body")
    wanted = errors.select(*keys).distinct()
    found = bodies.join(small_side(wanted, row_bound), keys, "left_semi")
    return errors.join(found, keys, "left").select(*errors.columns, "page", "body")


def disposition_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("disposition").agg(F.count(F.lit(1)).alias("n"))


def disposition_counters() -> dict[str, Column]:
    """The same as aggregates to be observed while outcomes are written."""
    return {d: F.count_if(F.col("disposition") == d) for d in (GAME, NO_COMPETITION, NO_DATE, WRONG_DATE, NO_ODDS, ERROR)}


def on_local_dates(events: DataFrame, utc_column: str, zone: str, first: date, last: date) -> DataFrame:
    """Rows of a UTC-stamped table whose local date lies in ``first..last``; adds ``local_date``."""
    utc = F.col(utc_column)
    near = events.filter(utc_window(utc, first, last))
    return near.withColumn("local_date", local_date_of_utc(utc, zone)).filter(
        F.col("local_date").between(F.lit(first), F.lit(last))
    )


def event_date_range(events: DataFrame, utc_column: str, zone: str) -> DataFrame:
    """First and last local date over all events.

    Local dates follow the clock, so only the two extreme times are converted.
    """
    return events.agg(F.min(utc_column).alias("lo"), F.max(utc_column).alias("hi")).select(
        local_date_of_utc(F.col("lo"), zone).alias("first_date"),
        local_date_of_utc(F.col("hi"), zone).alias("last_date"),
    )
