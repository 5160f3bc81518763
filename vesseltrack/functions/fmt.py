"""Display formats for report cells: a number, or an em dash when missing.

Fixed-point text follows Python's float formatting (round-half-even on the
exact binary value: 0.2915 -> '0.291'), which Java's formatter does not (it
rounds the shortest decimal string half-up: '0.292'). These run on the few
rows of a watchlist only, so an Arrow-batched pandas function is used.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: placeholder shown for a missing number.
MISSING = "—"


def fmt_int(c: Column) -> Column:
    """Integer text (fraction truncated toward zero) or the placeholder."""
    return F.coalesce(c.cast("double").cast("long").cast("string"), F.lit(MISSING))


def _fixed(digits: int):
    @F.pandas_udf("string")
    def fixed(s: pd.Series) -> pd.Series:
        return s.map(lambda v: MISSING if v is None or pd.isna(v) else f"{float(v):.{digits}f}")
    return fixed


_FIXED = {}


def fmt_float(c: Column, digits: int = 1) -> Column:
    """Fixed-point text with ``digits`` decimals (no grouping) or the placeholder."""
    from pyspark.sql import SparkSession

    from vesseltrack.session import ship_package

    active = SparkSession.getActiveSession()
    if active is not None:
        ship_package(active)
    if digits not in _FIXED:
        _FIXED[digits] = _fixed(digits)
    return _FIXED[digits](c.cast("double"))
