"""Declared schemas. Nothing is inferred: an inferred MMSI would become a number
and lose its leading zeros, which breaks the sanctions join."""

from __future__ import annotations

from pyspark.sql import types as T

# One daily position file, columns in file order (longitude before latitude).
AIS_SCHEMA = T.StructType([
    T.StructField("mmsi", T.StringType()),
    T.StructField("base_date_time", T.TimestampType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("sog", T.DoubleType()),
    T.StructField("cog", T.DoubleType()),
    T.StructField("heading", T.IntegerType()),
    T.StructField("vessel_name", T.StringType()),
    T.StructField("imo", T.StringType()),
    T.StructField("call_sign", T.StringType()),
    T.StructField("vessel_type", T.IntegerType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("length", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("draft", T.DoubleType()),
    T.StructField("cargo", T.IntegerType()),
    T.StructField("transceiver", T.StringType()),
])

AIS_COLUMNS = [f.name for f in AIS_SCHEMA.fields]
LINEAGE_COLUMNS = ["_ingestion_ts", "_source_file"]
BRONZE_AIS_COLUMNS = AIS_COLUMNS + LINEAGE_COLUMNS
CLEAN_COLUMNS = BRONZE_AIS_COLUMNS + ["quality_flag", "event_date"]

# Sanctions bulk file: one entity per JSON line.
ENTITY_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("schema", T.StringType()),
    T.StructField("properties", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
    T.StructField("datasets", T.ArrayType(T.StringType())),
])

SANCTIONS_SCHEMA = T.StructType([
    T.StructField("entity_id", T.StringType()),
    T.StructField("entity_name", T.StringType()),
    T.StructField("mmsi", T.StringType()),
    T.StructField("imo_number", T.StringType()),
    T.StructField("flag", T.StringType()),
    T.StructField("sanctions_list", T.StringType()),
    T.StructField("designation_date", T.StringType()),
])
SANCTIONS_COLUMNS = [f.name for f in SANCTIONS_SCHEMA.fields]

DARK_GAP_COLUMNS = [
    "mmsi", "vessel_name", "gap_start", "gap_end", "gap_hours",
    "last_known_lat", "last_known_lon", "reappearance_lat", "reappearance_lon",
    "event_date", "anomaly_type", "anomaly_score",
]

IMPOSSIBLE_SPEED_COLUMNS = [
    "mmsi", "vessel_name", "event_start", "event_end", "from_lat", "from_lon",
    "to_lat", "to_lon", "distance_nm", "implied_speed_knots", "event_date",
    "anomaly_type", "anomaly_score",
]

CUE_COLUMNS = [
    "mmsi", "vessel_name", "event_ts", "lat", "lon", "event_date", "anomaly_type",
    "anomaly_score", "sanctions_match", "sanctions_list", "designation_date",
]

FEATURE_COLUMNS = [
    "mmsi", "vessel_name", "n_dark_gaps", "avg_gap_hours", "max_gap_hours",
    "n_impossible_speed", "max_implied_speed", "max_jump_nm", "total_anomalies",
    "max_anomaly_score", "is_sanctioned", "sanctions_mmsi_only_hit",
]

# Model inputs; total_anomalies is left out on purpose (it is the sum of two of them).
MODEL_FEATURES = [
    "n_dark_gaps", "avg_gap_hours", "max_gap_hours", "n_impossible_speed",
    "max_implied_speed", "max_jump_nm", "max_anomaly_score", "is_sanctioned",
]

RISK_COLUMNS = ["mmsi", "vessel_name", *MODEL_FEATURES, "total_anomalies",
                "risk_score", "is_outlier", "_scored_at"]

WINDOW_STATE_SCHEMA = T.StructType([
    T.StructField("last_end", T.DateType()),
    T.StructField("_updated_at", T.TimestampType()),
])
