"""Date parsing as column expressions; the time zone is always a parameter."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from courtline import wording as w


def game_date(text: Column) -> Column:
    """``NOV 04, 2025`` -> date; null for blank or unreadable text."""
    return F.to_date(F.try_to_timestamp(text, F.lit(w.GAME_DATE_FORMAT)))


def event_instant(text: Column) -> Column:
    """ISO-8601 text with an offset (``2025-11-04T00:30Z``) -> instant; null if unreadable."""
    return F.try_to_timestamp(text, F.lit(w.EVENT_TIME_FORMAT))


def local_date_of_instant(instant: Column, zone: str) -> Column:
    """Calendar date of an instant in ``zone``, whatever the session zone is."""
    # The UTC wall clock by arithmetic: through the session's own clock a repeated hour would be ambiguous.
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    utc = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return local_date_of_utc(utc, zone)


def event_local_date(text: Column, zone: str) -> Column:
    """Calendar date in ``zone`` of an event time; a time without offset is taken as local already."""
    zoneless = F.when(text.rlike(w.ZONELESS_TIME), F.substring(text, 1, 10).try_cast("date"))
    return F.coalesce(local_date_of_instant(event_instant(text), zone), zoneless)


def local_date_of_utc(utc: Column, zone: str) -> Column:
    """Calendar date in ``zone`` of a zone-less UTC wall-clock time."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc))


def utc_window(utc: Column, first: date, last: date) -> Column:
    """Coarse range on a raw UTC column covering local dates ``first..last`` in any zone.

    Zones lie within a day of UTC, so this never drops a wanted row; unlike the
    exact local-date test it reaches the file scan.
    """
    lower, upper = first - timedelta(days=1), last + timedelta(days=2)
    return (utc >= F.lit(lower.isoformat()).cast("timestamp_ntz")) & (
        utc < F.lit(upper.isoformat()).cast("timestamp_ntz")
    )
