"""Join helpers: broadcast a dimension only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A sanctions snapshot holds a few hundred vessel entities; anything up to this
# many rows is broadcast, anything larger goes through a shuffle join.
DEFAULT_BROADCAST_ROWS = 200_000


def bounded_rows(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads at most max_rows + 1)."""
    return df.limit(max_rows + 1).count() <= max_rows


def maybe_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` if its row count is proven small, else ``df`` unchanged.

    The check is one bounded job on the small side. Without the hint the
    planner still broadcasts on its own statistics or at runtime (AQE) when it
    can; with it, the broadcast is never applied to a table that grew.
    """
    return F.broadcast(df) if bounded_rows(df, max_rows) else df
