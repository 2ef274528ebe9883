"""Names and number texts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from courtline import wording as w


def nickname(name: Column) -> Column:
    """Last whitespace-separated word of a team name; null for a blank one."""
    words = F.split(F.trim(F.regexp_replace(name, r"\s+", " ")), " ")
    last = F.element_at(words, -1)
    return F.when(last != "", last)


def matchup(away: Column, home: Column) -> Column:
    """``away @ home``; null if either side is."""
    return F.concat(away, F.lit(" @ "), home)


def number_text(value: Column, decimals: int, signed: bool = False, percent: bool = False) -> Column:
    """Fixed-point text of a number, ties to even, ``nan`` for a missing one.

    The sign is read off the unrounded value, so -0.04 at one decimal is ``-0.0``.
    """
    scaled = value * 100 if percent else value
    rounded = F.bround(F.abs(scaled), decimals)
    # Up to 28 digits a decimal prints faster than a format string; beyond, it does not fit.
    digits = F.coalesce(
        rounded.try_cast(f"decimal({28 + decimals},{decimals})").cast("string"),
        F.format_string(f"%.{decimals}f", rounded),
    )
    plus = "+" if signed else ""
    unit = "%" if percent else ""
    sign = F.when(scaled.cast("string").startswith("-"), "-").otherwise(plus)
    return F.when(value.isNull(), f"{plus}nan{unit}").otherwise(F.concat(sign, digits, F.lit(unit)))


def fill(template: str, *arguments: Column | str) -> Column:
    """A ``%s`` template with its placeholders filled in order; ``nan`` for a missing value.

    A plain concatenation, which Spark compiles, unlike a format string.
    """
    pieces = template.split("%s")
    if len(pieces) != len(arguments) + 1:
        raise ValueError(f"{len(pieces) - 1} placeholders, {len(arguments)} arguments")
    parts = [F.lit(pieces[0])] if pieces[0] else []
    for argument, piece in zip(arguments, pieces[1:]):
        value = F.col(argument) if isinstance(argument, str) else argument
        parts.append(F.coalesce(value, F.lit("nan")))
        if piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)


def has_side(flag: Column, side: str) -> Column:
    """Does a recommendation name this side (HOME, AWAY, OVER, UNDER)?"""
    return F.coalesce(flag.contains(side), F.lit(False))


def is_value(flag: Column) -> Column:
    return flag != w.NO_VALUE
