"""Team statistics: decoding header/row documents and merging them per team."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline import schemas
from courtline import wording as w
from courtline.functions.stats_json import place, stat, stat_or_default

TEAM_KEYS = ("TEAM_ID", "TEAM_NAME")


def decode_result_set(documents: DataFrame) -> DataFrame:
    """Documents plus the ``headers`` and ``rowSet`` of their first result set.

    Unreadable documents are dropped; one with an empty list of result sets
    stays, with both null.  The decoded set leaves through `explode_outer`, so
    that filters on it are not moved below it and decode the body again.
    """
    sets = F.from_json("body", schemas.STATS_BODY)["resultSets"]
    first = F.get("result_sets", F.lit(0))
    headers, rows = first["headers"], first["rowSet"]
    usable = (F.size("result_sets") == 0) | (headers.isNotNull() & rows.isNotNull())
    found = F.when(usable, F.array(F.struct(headers.alias("headers"), rows.alias("rowSet"))))
    kept = [c for c in documents.columns if c != "body"]
    return (
        documents.select(*kept, sets.alias("result_sets"))
        .select(*kept, F.explode_outer(found).alias("found"))
        .filter(F.col("found").isNotNull())
        .select(*kept, "found.headers", "found.rowSet")
    )


def _with_places(documents: DataFrame, names: Sequence[str]) -> DataFrame:
    """Decoded documents with the index of each header, looked up once a document."""
    return decode_result_set(documents).withColumns({f"at {c}": place(c, F.col("headers")) for c in names})


def _stats(names: Sequence[str]) -> list[Column]:
    return [stat(F.col(f"at {c}"), F.col("row"), schemas.TEAM_STATS[c].dataType.simpleString()).alias(c) for c in names]


def base_stats(documents: DataFrame, keys: Sequence[str] = TEAM_KEYS) -> DataFrame:
    """Record and offence columns per team, from the first row of its base document.

    ``has_stats`` is false for a readable document without rows.
    """
    names = w.RECORD_COLUMNS + w.OFFENCE_COLUMNS
    rows = _with_places(documents, names).withColumn("row", F.get("rowSet", F.lit(0)))
    return rows.select(*keys, *_stats(names), F.col("row").isNotNull().alias("has_stats"))


def opponent_stats(documents: DataFrame, keys: Sequence[str] = TEAM_KEYS) -> DataFrame:
    """Opponent columns per team whose document has a row; 0 for an absent header."""
    rows = _with_places(documents, w.OPPONENT_COLUMNS).withColumn("row", F.get("rowSet", F.lit(0)))
    return rows.filter(F.col("row").isNotNull()).select(*keys, *(
        stat_or_default(F.col(f"at {c}"), F.col("row"), 0).alias(c) for c in w.OPPONENT_COLUMNS
    ))


LOG_COLUMNS = (
    ("Game_ID", "game_id", "long"),
    ("GAME_DATE", "game_date_text", "string"),
    ("WL", "wl", "string"),
    ("PTS", "pts", "double"),
    ("PLUS_MINUS", "plus_minus", "double"),
)


def game_log(documents: DataFrame, keys: Sequence[str] = TEAM_KEYS) -> DataFrame:
    """One row per game of each game-log document; ``log_position`` is its place there."""
    found = _with_places(documents, [header for header, _, _ in LOG_COLUMNS])
    places = [f"at {header}" for header, _, _ in LOG_COLUMNS]
    rows = found.select(*keys, *(F.col(c) for c in places), F.posexplode("rowSet").alias("log_position", "row"))
    return rows.select(*keys, "log_position", *(
        stat(F.col(f"at {header}"), F.col("row"), type_).alias(name) for header, name, type_ in LOG_COLUMNS))


def assemble(base: DataFrame, opponent: DataFrame, rest: DataFrame,
             keys: Sequence[str] = TEAM_KEYS) -> DataFrame:
    """Base ⟕ opponent ⟕ rest splits.

    A team without a readable base document is lost; missing opponent or rest
    data leave nulls.  A team with nothing at all is dropped.
    """
    joined = (
        base.join(opponent.withColumn("has_opponent", F.lit(True)), [*keys], "left")
        .join(rest.withColumn("has_rest", F.lit(True)), [*keys], "left")
    )
    known = F.col("has_stats") | F.col("has_opponent").isNotNull() | F.col("has_rest").isNotNull()
    return joined.filter(known).drop("has_stats", "has_opponent", "has_rest")


def conform(team_stats: DataFrame, strict: bool = True, keys: Sequence[str] = ()) -> DataFrame:
    """Only the published columns, in order.

    ``strict`` adds the absent ones as typed nulls so the schema never varies;
    otherwise they are left out.
    """
    present = set(team_stats.columns)
    columns = []
    for field in schemas.TEAM_STATS:
        if field.name in present:
            columns.append(F.col(field.name).cast(field.dataType).alias(field.name))
        elif strict:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
    return team_stats.select(*keys, *columns)


def union_stats(*frames: DataFrame) -> DataFrame:
    """Append frames with differing columns; what a frame lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


PREVIEW_COLUMNS = ("TEAM_NAME", "W_PCT", "PTS", "OPP_PTS", "PLUS_MINUS", "REST_0_W_PCT", "REST_2_W_PCT")
# A column that is shown only with another one.
_SHOWN_WITH = {"PLUS_MINUS": "OPP_PTS", "REST_2_W_PCT": "REST_0_W_PCT"}


def preview(team_stats: DataFrame, n: int = 10, columns: Sequence[str] = PREVIEW_COLUMNS) -> DataFrame:
    """First ``n`` teams by name, with those of ``columns`` that are there."""
    present = set(team_stats.columns)
    shown = [c for c in columns if {c, _SHOWN_WITH.get(c, c)} <= present]
    return team_stats.orderBy("TEAM_NAME").limit(n).select(*shown)


def row_counts(**frames: DataFrame) -> DataFrame:
    """One row per named frame with its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionAll, counts)
