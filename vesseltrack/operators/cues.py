"""Gold anomaly cues: both event kinds in one shape, enriched with sanctions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vesseltrack.operators.clean import in_window
from vesseltrack.operators.joins import DEFAULT_BROADCAST_ROWS, maybe_broadcast
from vesseltrack.schemas import CUE_COLUMNS

EVENT_COLUMNS = ["mmsi", "vessel_name", "event_ts", "lat", "lon", "event_date",
                 "anomaly_type", "anomaly_score"]


def events_union(gaps: DataFrame, jumps: DataFrame, window=None) -> DataFrame:
    """Dark gaps and jumps as (event_ts, lat, lon) of their *first* ping.

    The decimal dark-gap score and the double speed score meet as double.
    """
    g = gaps.select("mmsi", "vessel_name", F.col("gap_start").alias("event_ts"),
                    F.col("last_known_lat").alias("lat"), F.col("last_known_lon").alias("lon"),
                    "event_date", "anomaly_type", F.col("anomaly_score").cast("double").alias("anomaly_score"))
    j = jumps.select("mmsi", "vessel_name", F.col("event_start").alias("event_ts"),
                     F.col("from_lat").alias("lat"), F.col("from_lon").alias("lon"),
                     "event_date", "anomaly_type", F.col("anomaly_score").cast("double").alias("anomaly_score"))
    if window is not None:
        g = g.where(in_window(F.col("event_date"), window))
        j = j.where(in_window(F.col("event_date"), window))
    return g.unionByName(j)


def anomaly_cues(gaps: DataFrame, jumps: DataFrame, sanctions: DataFrame, window=None,
                 broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Left join on MMSI; an event matching k entities yields k rows (fan-out kept).

    The sanctions side is a small snapshot: it is broadcast after a size check,
    so the event side is never shuffled for this join.
    """
    s = sanctions.select("mmsi", F.col("entity_name").alias("sanctions_match"),
                         "sanctions_list", "designation_date")
    s = maybe_broadcast(s, broadcast_rows)
    return events_union(gaps, jumps, window).join(s, "mmsi", "left").select(*CUE_COLUMNS)
