"""Gold detectors over a timeline: dark gaps (D5) and impossible speed."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vesseltrack.functions import elapsed_hours, haversine_nm, whole_hours, whole_seconds
from vesseltrack.operators.clean import in_window
from vesseltrack.schemas import DARK_GAP_COLUMNS, IMPOSSIBLE_SPEED_COLUMNS

# Fixed values of the two rules.
DARK_GAP_MIN_HOURS = 6
DARK_GAP_FULL_SCORE_HOURS = Decimal("24.0")   # decimal on purpose: the score is decimal(27,6)
MAX_PLAUSIBLE_KNOTS = 30
SPEED_SCORE_SPAN_KNOTS = Decimal("70.0")


def dark_gaps(tl: DataFrame, window=None, min_hours: int = DARK_GAP_MIN_HOURS,
              full_score_hours: Decimal = DARK_GAP_FULL_SCORE_HOURS) -> DataFrame:
    """Silences of at least ``min_hours`` complete hours between consecutive pings.

    The event belongs to the date of the reappearance ping; with a window only
    events whose reappearance is inside it are emitted (the lookback ping only
    provides context). Score = min(hours / 24.0, 1.0) as decimal(27,6).
    """
    hours = whole_hours(F.col("prev_ts"), F.col("base_date_time"))
    cond = F.col("prev_ts").isNotNull() & (hours >= min_hours)
    if window is not None:
        cond = cond & in_window(F.col("base_date_time"), window)
    out = tl.where(cond).select(
        "mmsi", "vessel_name",
        F.col("prev_ts").alias("gap_start"),
        F.col("base_date_time").alias("gap_end"),
        hours.alias("gap_hours"),
        F.col("prev_lat").alias("last_known_lat"),
        F.col("prev_lon").alias("last_known_lon"),
        F.col("latitude").alias("reappearance_lat"),
        F.col("longitude").alias("reappearance_lon"),
        F.to_date("base_date_time").alias("event_date"),
    )
    return (out.withColumn("anomaly_type", F.lit("dark_gap"))
               .withColumn("anomaly_score",
                           F.least(F.col("gap_hours") / F.lit(full_score_hours), F.lit(Decimal("1.0"))))
               .select(*DARK_GAP_COLUMNS))


def impossible_speed(tl: DataFrame, window=None, max_knots: float = MAX_PLAUSIBLE_KNOTS,
                     span_knots: Decimal = SPEED_SCORE_SPAN_KNOTS) -> DataFrame:
    """Consecutive pings whose implied speed exceeds ``max_knots``.

    Elapsed time is whole seconds / 3600.0 (decimal, 6 places); steps under one
    second are dropped. Score = min((knots - 30) / 70.0, 1.0).
    """
    secs = whole_seconds(F.col("prev_ts"), F.col("base_date_time"))
    with_speed = (tl.where(F.col("prev_ts").isNotNull() & (secs > 0))
                    .withColumn("distance_nm", haversine_nm(F.col("prev_lat"), F.col("prev_lon"),
                                                            F.col("latitude"), F.col("longitude")))
                    .withColumn("elapsed_hours", elapsed_hours(F.col("prev_ts"), F.col("base_date_time")))
                    .withColumn("implied_speed_knots", F.col("distance_nm") / F.col("elapsed_hours")))
    cond = F.col("implied_speed_knots") > max_knots
    if window is not None:
        cond = cond & in_window(F.col("base_date_time"), window)
    return (with_speed.where(cond).select(
        "mmsi", "vessel_name",
        F.col("prev_ts").alias("event_start"),
        F.col("base_date_time").alias("event_end"),
        F.col("prev_lat").alias("from_lat"),
        F.col("prev_lon").alias("from_lon"),
        F.col("latitude").alias("to_lat"),
        F.col("longitude").alias("to_lon"),
        "distance_nm", "implied_speed_knots",
        F.to_date("base_date_time").alias("event_date"),
        F.lit("impossible_speed").alias("anomaly_type"),
        F.least((F.col("implied_speed_knots") - max_knots) / F.lit(span_knots), F.lit(Decimal("1.0"))).alias("anomaly_score"),
    ).select(*IMPOSSIBLE_SPEED_COLUMNS))
