"""Elapsed-time helpers with the exact truncation and decimal rounding the rules use."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_hours(start: Column, end: Column) -> Column:
    """Complete hours between two timestamps (5 h 59 m 59 s -> 5), a bigint."""
    return F.timestamp_diff("HOUR", start, end)


def whole_seconds(start: Column, end: Column) -> Column:
    """Complete seconds between two timestamps (sub-second steps -> 0), a bigint."""
    return F.timestamp_diff("SECOND", start, end)


def elapsed_hours(start: Column, end: Column) -> Column:
    """Whole seconds / 3600.0 as decimal(27,6): hours rounded half-up to 6 places.

    The rounding is observable (1 s -> 0.000278 h), so it is kept on purpose.
    """
    return whole_seconds(start, end) / F.lit(Decimal("3600.0"))
