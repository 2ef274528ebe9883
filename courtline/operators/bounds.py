"""Broadcasting only what is small: rows that are known, times bytes a row that are assumed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest side that may be broadcast, as rows in a hash table.
BROADCAST_BYTES = 64 * 2**20
ROW_BYTES = 32
# What a field is assumed to need: texts are names and addresses, usually far shorter than this.
TEXT_BYTES = 256
FIELD_BYTES = 16


def row_bytes(df: DataFrame) -> int:
    """Bytes assumed for a row of ``df`` as a row of a hash table."""
    return ROW_BYTES + sum(
        TEXT_BYTES if isinstance(f.dataType, (T.StringType, T.BinaryType)) else FIELD_BYTES for f in df.schema)


def fits(df: DataFrame, row_bound: int | None, limit: int = BROADCAST_BYTES) -> bool:
    """Whether ``row_bound`` rows of ``df`` stay within ``limit`` bytes; without a bound, no."""
    return row_bound is not None and row_bound * row_bytes(df) <= limit


def small_side(dim: DataFrame, row_bound: int | None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a dimension for broadcast if its proven row bound, at the bytes assumed for a row, keeps it within ``limit``.

    Without a bound, or beyond it, the frame is returned as is: Spark then
    shuffles both sides and adaptive execution splits hot keys.
    """
    return F.broadcast(dim) if fits(dim, row_bound, limit) else dim
