"""Reading header/row statistics documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def place(name: str, headers: Column) -> Column:
    """Index of a header, of the last one if it is repeated; null if absent.  Look it up once a document."""
    from_end = F.array_position(F.reverse(headers), name)
    return F.when(from_end > 0, (F.size(headers) - from_end).cast("int"))


def stat(at: Column, row: Column, type_: str = "string") -> Column:
    """Value at an index (see ``place``); null if the index is, the row short or the text unreadable.

    A whole number may be written with decimals.
    """
    text = F.when(at.isNotNull(), F.get(row, at))
    if type_ in ("long", "bigint", "int"):
        return F.coalesce(text.try_cast(type_), text.try_cast("decimal(38,9)").try_cast(type_))
    return text.try_cast(type_)


def stat_or_default(at: Column, row: Column, default: float) -> Column:
    """Like :func:`stat`, with a default for an absent header only; an explicit null stays null."""
    return F.when(at.isNotNull(), stat(at, row, "double")).otherwise(F.lit(float(default)))


def row_map(headers: Column, row: Column) -> Column:
    """Header -> value map, cut to the shorter of the two lists; the last of equal headers counts, null ones do not."""
    n = F.least(F.size(headers), F.size(row))
    names = F.slice(headers, F.lit(1), n)
    last = F.filter(F.sequence(F.lit(0), n), lambda i: (
        F.get(names, i).isNotNull() & (F.size(names) - F.array_position(F.reverse(names), F.get(names, i)) == i)))
    return F.map_from_arrays(F.transform(last, lambda i: F.get(names, i)), F.transform(last, lambda i: F.get(row, i)))
