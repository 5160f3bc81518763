"""Registered query of the streaming detectors: a replay in disorder must end with the batch events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vesseltrack import oracle as O
from vesseltrack.session import pin_utc, scratch_path
from vesseltrack.sources.fixtures import ais_raw_from_events
from vesseltrack.streaming.watch import SLOT_SECONDS, live_events, watch

FILES, FILES_PER_BATCH, MIN_GROUPS = 12, 3, 64
LATENESS = "400 days"  # no ping of the replay is late, whatever the order
KEY_PINGS = 2000  # pings that a key of the state should hold in the end


def replay(spark: SparkSession, sf_dir: str) -> str:
    """Streams all pings from files that each hold pings of the whole time span; returns the folder of the log."""
    pin_utc(spark)
    raw = ais_raw_from_events(spark, sf_dir)
    landed, out = scratch_path(spark, "live-landed"), scratch_path(spark, "live")
    raw.repartition(FILES, F.xxhash64("mmsi", "base_date_time", "_ingestion_ts")).write.parquet(landed)
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", FILES_PER_BATCH).parquet(landed)
    slot = F.floor(F.unix_timestamp("base_date_time") / SLOT_SECONDS)
    n, slots = spark.read.parquet(landed).agg(F.count("base_date_time"), F.approx_count_distinct(slot)).first()
    watch(stream, out, checkpoint=scratch_path(spark, "live-checkpoint"), lateness=LATENESS,
          shards=max(1, -(-n // (max(slots, 1) * KEY_PINGS))), groups=max(MIN_GROUPS, -(-n // KEY_PINGS))).awaitTermination()
    return out


def _q_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vesseltrack.plans.registry import for_compare
    out = replay(spark, sf_dir)
    gaps = live_events(spark, out, "dark_gaps").select(
        "mmsi", "vessel_name", "anomaly_type", F.col("gap_start").alias("began"), F.col("gap_end").alias("ended"), "event_date",
        F.col("last_known_lat").alias("from_lat"), F.col("last_known_lon").alias("from_lon"), F.col("anomaly_score").cast("double").alias("anomaly_score"))
    jumps = live_events(spark, out, "impossible_speed").select(
        "mmsi", "vessel_name", "anomaly_type", F.col("event_start").alias("began"), F.col("event_end").alias("ended"), "event_date",
        "from_lat", "from_lon", "anomaly_score")
    return for_compare(gaps.unionByName(jumps), ("anomaly_score",))


QUERIES = {"live_detection": _q_live}

ORACLE = {
    "live_detection": O.gold() + """
SELECT mmsi, vessel_name, anomaly_type, gap_start AS began, gap_end AS ended, event_date, last_known_lat AS from_lat, last_known_lon AS from_lon,
  round(anomaly_score, 6) AS anomaly_score FROM dark_gaps
UNION ALL SELECT mmsi, vessel_name, anomaly_type, event_start, event_end, event_date, from_lat, from_lon, round(anomaly_score, 6) FROM impossible_speed""",
}
