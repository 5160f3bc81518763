"""Data-quality checks (Q1-Q5): every rule of a table in one aggregation.

A rule is (name, column, kind, arg). Kinds: ``not_null``; ``accepted``
(non-null values outside ``arg``); ``is_null`` (values that should be null);
``expr`` (rows where the SQL condition ``arg`` is false or null - a bound
that holds by definition); ``unique`` (keys occurring more than once, nulls
ignored, one grouped pass per key). The result is a small long table:
rule, column_name, failures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vesseltrack.operators.clean import in_window

# The schema tests of each table.
RULES = {
    "ais_raw": [
        ("not_null", c, None) for c in
        ["mmsi", "base_date_time", "latitude", "longitude", "_ingestion_ts", "_source_file"]
    ],
    "sanctions": [("not_null", "entity_id", None), ("unique", "entity_id", None),
                  ("not_null", "_ingestion_ts", None)],
    "ais_clean": [("not_null", c, None) for c in
                  ["mmsi", "base_date_time", "latitude", "longitude", "sog", "event_date"]]
                 + [("is_null", "quality_flag", None)],
    "ais_dark_gaps": [("not_null", c, None) for c in
                      ["mmsi", "gap_start", "gap_end", "gap_hours", "anomaly_type", "anomaly_score",
                       "event_date"]]
                     + [("accepted", "anomaly_type", ["dark_gap"]),
                        ("expr", "gap_hours", "gap_hours >= 6"),
                        ("expr", "anomaly_score", "anomaly_score between 0 and 1")],
    "ais_impossible_speed": [("not_null", c, None) for c in
                             ["mmsi", "event_start", "event_end", "implied_speed_knots", "anomaly_type",
                              "anomaly_score", "event_date"]]
                            + [("accepted", "anomaly_type", ["impossible_speed"]),
                               ("expr", "implied_speed_knots", "implied_speed_knots > 30"),
                               ("expr", "anomaly_score", "anomaly_score <= 1")],
    "ais_anomaly_cues": [("not_null", c, None) for c in
                         ["mmsi", "event_ts", "anomaly_type", "anomaly_score", "event_date"]]
                        + [("accepted", "anomaly_type", ["dark_gap", "impossible_speed"])],
    "vessel_features": [("not_null", "mmsi", None), ("unique", "mmsi", None),
                        ("not_null", "total_anomalies", None), ("not_null", "is_sanctioned", None),
                        ("accepted", "is_sanctioned", [0, 1]),
                        ("expr", "total_anomalies", "total_anomalies >= 1")],
}


def _failing(kind: str, column: str, arg):
    c = F.col(column)
    if kind == "not_null":
        return c.isNull()
    if kind == "is_null":
        return c.isNotNull()
    if kind == "accepted":
        return c.isNotNull() & ~c.isin(list(arg))
    if kind == "expr":
        return ~F.coalesce(F.expr(arg), F.lit(False))
    raise ValueError(kind)


def run_checks(df: DataFrame, rules, window=None, date_col: str = "event_date") -> DataFrame:
    """Failures per rule. With ``window`` only that date range is read (Q4)."""
    if window is not None:
        df = df.where(in_window(F.col(date_col), window))
    spark: SparkSession = df.sparkSession
    simple = [(k, c, a) for k, c, a in rules if k != "unique"]
    parts = []
    if simple:
        row = df.agg(*[F.count_if(_failing(k, c, a)).alias(f"r{i}") for i, (k, c, a) in enumerate(simple)])
        stack = ", ".join(f"'{k}', '{c}', r{i}" for i, (k, c, _) in enumerate(simple))
        parts.append(row.selectExpr(f"stack({len(simple)}, {stack}) as (rule, column_name, failures)"))
    for k, c, _ in rules:
        if k == "unique":
            dup = (df.where(F.col(c).isNotNull()).groupBy(c).count().where(F.col("count") > 1)
                     .agg(F.count(F.lit(1)).alias("failures")))
            parts.append(dup.select(F.lit("unique").alias("rule"), F.lit(c).alias("column_name"), "failures"))
    if not parts:
        return spark.createDataFrame([], "rule string, column_name string, failures bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
