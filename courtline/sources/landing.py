"""Landed documents decoded once: what the hops need of every body, as tables by kind.

A fetch is landed as one part of a store (see :mod:`courtline.sources.commits`), all its
tables at once, so that no hop decodes, or even reads, a body again.  Events are divided
by the month of their UTC date: a reader of a few days opens only theirs, and of these
only the row groups that may hold the days.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline import schemas
from courtline.functions.dates import event_local_date
from courtline.operators import ingest
from courtline.sources import commits
from courtline.sources.commits import Written

FETCH = "fetch"
_DAY, _MONTH = "utc_day", "utc_month"


def _with_day(events: DataFrame) -> DataFrame:
    day = event_local_date(F.col("date_text"), "UTC")
    return events.withColumns({_DAY: day, _MONTH: F.date_format(day, "yyyy-MM")})


_TABLES = {
    "listed": ingest.listed_events,
    "events": lambda documents: _with_day(ingest.event_fields(documents)),
    "competitions": ingest.competition_fields,
    "teams": ingest.team_fields,
    "odds": ingest.odds_fields,
}
_GROUPS = {"events": (_MONTH,)}


def land(documents: DataFrame, path: str, fetch: str) -> list[Written]:
    """Decode the documents of one fetch and add them to the store; a fetch landed again is replaced."""
    run = commits.new_run()
    written = [commits.write(fields(documents), path, fetch, run, table, _GROUPS.get(table, ()))
               for table, fields in _TABLES.items()]
    commits.commit(documents.sparkSession, path, written)
    return written


class LandedDocuments(ingest.Source):
    """The store as a source of the hops; ``fetch`` is its scope.

    ``only`` chooses fetches, all of them if not given.  The files of the manifest
    are listed when the source is made, so all hops see the same fetches.
    ``page_type`` is the type of the landed documents' pages.
    """

    def __init__(self, spark: SparkSession, path: str, only: Column | None = None, page_type: str = "long"):
        self._entries = commits.current(spark, path).filter(F.lit(True) if only is None else only)
        self._spark, self._path, self.scope = spark, path, (FETCH,)
        self._documents = spark.createDataFrame([], schemas.DOCUMENTS).withColumn("page", F.col("page").cast(page_type))

    def _table(self, table: str, only: Column | None = None) -> DataFrame:
        entries = self._entries.filter(F.col("table") == table)
        schema = _TABLES[table](self._documents).schema
        if only is not None:
            entries = entries.filter(only)
        found = commits.committed(self._spark, self._path, schema, table, _GROUPS.get(table, ()) if only is not None else (), entries)
        return found.withColumnRenamed("part", FETCH)

    def listed(self) -> DataFrame:
        return self._table("listed")

    def events(self, first: date | None = None, last: date | None = None) -> DataFrame:
        """All events, or those of the UTC dates that local dates ``first..last`` can fall on, undated ones left out."""
        month = commits.text_of(F.col("keys")[_MONTH])
        months, days = F.lit(True), F.lit(True)
        if first is not None:
            lower = first - timedelta(days=1)
            months, days = months & (month >= f"{lower:%Y-%m}"), days & (F.col(_DAY) >= F.lit(lower))
        if last is not None:
            upper = last + timedelta(days=1)
            months, days = months & (month <= f"{upper:%Y-%m}"), days & (F.col(_DAY) <= F.lit(upper))
        near = None if first is None and last is None else months
        return self._table("events", near).filter(days).drop(_DAY, _MONTH)

    def competitions(self, urls: DataFrame, row_bound: int | None) -> DataFrame:
        return self._table("competitions")

    def teams(self) -> DataFrame:
        return self._table("teams")

    def odds(self, urls: DataFrame, row_bound: int | None) -> DataFrame:
        return self._table("odds")
