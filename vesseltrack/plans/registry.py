"""Registered queries over the driver's test tables, with their DuckDB twins.

Each query reads the given tables through the adapters in
``vesseltrack.sources.fixtures`` and runs a library operator over all rows.
``for_compare`` only normalises the result for a cross-engine value check:
timestamps as timestamp_ntz (DuckDB's TIMESTAMP), decimals as double, and
trigonometry-derived doubles rounded to 6 places in both engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vesseltrack import oracle as O
from vesseltrack.operators.clean import clean, dedup_latest, quality_flag
from vesseltrack.operators.cues import anomaly_cues
from vesseltrack.operators.detect import dark_gaps, impossible_speed
from vesseltrack.operators.features import (
    features_from_partials, gap_profile, jump_profile, sanctions_match, vessel_day_partials, vessel_features,
    vessel_names, vessels_any,
)
from vesseltrack.operators.timeline import TIMELINE_COLUMNS, daily_last_ping, prior_ping, timeline
from vesseltrack.session import materialize, pin_utc
from vesseltrack.sources.fixtures import ais_raw_from_events, sanctions_from_supplier

WINDOW = O.WINDOW


def for_compare(df: DataFrame, rounded: tuple[str, ...] = ()) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        if f.name in rounded:
            c = F.round(c.cast("double"), 6)
        cols.append(c.alias(f.name))
    return df.select(*cols)


class Inputs:
    """Lazily built inputs of one query over one test-data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, window=None, hot: bool = False):
        pin_utc(spark)
        self.spark, self.sf_dir, self.window, self.hot = spark, sf_dir, window, hot

    def raw(self):
        return ais_raw_from_events(self.spark, self.sf_dir, hot=self.hot)

    def sanctions(self):
        return sanctions_from_supplier(self.spark, self.sf_dir)

    def clean(self):
        return clean(self.raw())

    def silver(self):
        """The cleaned pings materialised once (Parquet in the shared checkpoint folder).

        Stands in for the silver table the pipeline reads: the timeline's
        hot-group check, its context aggregate and both detectors then read
        stored rows instead of recomputing the dedup shuffle.
        """
        if not hasattr(self, "_silver"):
            self._silver = materialize(self.clean(), "silver")
        return self._silver

    def timeline(self):
        # one timeline (and one hot-group check) shared by both detectors
        if not hasattr(self, "_timeline"):
            self._timeline = timeline(self.silver(), self.window)
        return self._timeline

    def gaps(self):
        return dark_gaps(self.timeline(), self.window)

    def jumps(self):
        return impossible_speed(self.timeline(), self.window)


SPEED_ROUNDED = ("distance_nm", "implied_speed_knots", "anomaly_score")
FEATURE_ROUNDED = ("avg_gap_hours", "max_implied_speed", "max_jump_nm", "max_anomaly_score")


def _q_raw(spark, d):
    return for_compare(Inputs(spark, d).raw())


def _q_quality_flags(spark, d):
    flagged = quality_flag(dedup_latest(Inputs(spark, d).raw()))
    return for_compare(flagged.where(F.col("quality_flag").isNotNull())
                       .select("mmsi", "base_date_time", "latitude", "longitude", "sog", "quality_flag"))


def _q_clean(spark, d):
    return for_compare(Inputs(spark, d).clean())


def _q_clean_window(spark, d):
    return for_compare(clean(Inputs(spark, d).raw(), WINDOW))


def _q_prior_ping(spark, d):
    return for_compare(prior_ping(Inputs(spark, d).clean(), WINDOW[0]))


def _q_dedup(spark, d):
    return for_compare(dedup_latest(Inputs(spark, d).raw()))


def _q_last_ping(spark, d):
    return for_compare(daily_last_ping(Inputs(spark, d).clean()))


def _q_prior_from_lookback(spark, d):
    return for_compare(prior_ping(daily_last_ping(Inputs(spark, d).clean()), WINDOW[0]))


def _q_timeline(spark, d):
    return for_compare(Inputs(spark, d).timeline().select(*TIMELINE_COLUMNS))


def _q_dark_gaps(spark, d, window=None):
    return for_compare(Inputs(spark, d, window).gaps())


def _q_speed(spark, d, window=None):
    return for_compare(Inputs(spark, d, window).jumps(), SPEED_ROUNDED)


def _q_cues(spark, d, window=None):
    i = Inputs(spark, d, window)
    return for_compare(anomaly_cues(i.gaps(), i.jumps(), i.sanctions(), window), ("anomaly_score",))


def _q_names(spark, d):
    i = Inputs(spark, d)
    return for_compare(vessel_names(i.gaps(), i.jumps()))


def _q_vessels_any(spark, d):
    i = Inputs(spark, d)
    return for_compare(vessels_any(i.gaps(), i.jumps()))


def _q_gap_profile(spark, d):
    return for_compare(gap_profile(Inputs(spark, d).gaps()), ("avg_gap_hours", "max_dark_score"))


def _q_jump_profile(spark, d):
    return for_compare(jump_profile(Inputs(spark, d).jumps()),
                       ("max_implied_speed", "max_jump_nm", "max_speed_score"))


def _q_sanctions_match(spark, d):
    i = Inputs(spark, d)
    return for_compare(sanctions_match(vessel_names(i.gaps(), i.jumps()), i.sanctions()))


def _q_features(spark, d):
    i = Inputs(spark, d)
    return for_compare(vessel_features(i.gaps(), i.jumps(), i.sanctions()), FEATURE_ROUNDED)


def _q_timeline_split_stress(spark, d):
    """The timeline with the per-group row bound at 1: every vessel-hour holding
    more than one ping takes the fine-bucket path with two-level context rows."""
    i = Inputs(spark, d)
    return for_compare(timeline(i.silver(), max_group_rows=1).select(*TIMELINE_COLUMNS))


def _q_gaps_hot_vessel(spark, d):
    """Dark gaps when one placeholder MMSI carries a third of all pings."""
    return for_compare(Inputs(spark, d, hot=True).gaps())


def _q_day_partials(spark, d):
    i = Inputs(spark, d)
    return for_compare(vessel_day_partials(i.gaps(), i.jumps()),
                       ("max_dark_score", "max_implied_speed", "max_jump_nm", "max_speed_score"))


def _q_features_partials(spark, d):
    i = Inputs(spark, d)
    parts = vessel_day_partials(i.gaps(), i.jumps())
    return for_compare(features_from_partials(parts, i.sanctions()), FEATURE_ROUNDED)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ais_raw_scan": _q_raw,
    "quality_flags": _q_quality_flags,
    "ais_clean": _q_clean,
    "ais_clean_window": _q_clean_window,
    "prior_ping": _q_prior_ping,
    "ais_dedup": _q_dedup,
    "last_ping_daily": _q_last_ping,
    "prior_ping_lookback": _q_prior_from_lookback,
    "timeline": _q_timeline,
    "dark_gaps": _q_dark_gaps,
    "impossible_speed": _q_speed,
    "anomaly_cues": _q_cues,
    "dark_gaps_window": lambda s, d: _q_dark_gaps(s, d, WINDOW),
    "impossible_speed_window": lambda s, d: _q_speed(s, d, WINDOW),
    "anomaly_cues_window": lambda s, d: _q_cues(s, d, WINDOW),
    "vessel_names": _q_names,
    "vessels_any": _q_vessels_any,
    "gap_profile": _q_gap_profile,
    "jump_profile": _q_jump_profile,
    "sanctions_match": _q_sanctions_match,
    "vessel_features": _q_features,
    "vessel_features_partials": _q_features_partials,
    "vessel_day_partials": _q_day_partials,
    "timeline_split_stress": _q_timeline_split_stress,
    "dark_gaps_hot_vessel": _q_gaps_hot_vessel,
}

_RAW = O.with_ctes(O.AIS_RAW)
_CLEAN = O.with_ctes(O.AIS_RAW, O.clean_ctes())
_CLEAN_W = O.with_ctes(O.AIS_RAW, O.clean_ctes(WINDOW))
_CLEAN_COLS = ("mmsi, base_date_time, longitude, latitude, sog, cog, heading, vessel_name, imo, call_sign, "
               "vessel_type, status, length, width, draft, cargo, transceiver, _ingestion_ts, _source_file")

ORACLE: dict[str, str] = {
    "ais_raw_scan": _RAW + f"SELECT {_CLEAN_COLS} FROM ais_raw",
    "quality_flags": _CLEAN + "SELECT mmsi, base_date_time, latitude, longitude, sog, quality_flag "
                              "FROM flagged WHERE quality_flag IS NOT NULL",
    "ais_clean": _CLEAN + f"SELECT {_CLEAN_COLS}, quality_flag, event_date FROM ais_clean",
    "ais_clean_window": _CLEAN_W + f"SELECT {_CLEAN_COLS}, quality_flag, event_date FROM ais_clean",
    "prior_ping": O.with_ctes(O.AIS_RAW, O.clean_ctes(), O.timeline_ctes(WINDOW)) + "SELECT * FROM prior_ping",
    "ais_dedup": _CLEAN + f"SELECT {_CLEAN_COLS} FROM dedup",
    "last_ping_daily": _CLEAN + (", lp AS (SELECT *, row_number() OVER (PARTITION BY mmsi, event_date "
                                 "ORDER BY base_date_time DESC) AS rn FROM ais_clean WHERE base_date_time IS NOT NULL) "
                                 "SELECT event_date, mmsi, vessel_name, base_date_time, latitude, longitude "
                                 "FROM lp WHERE rn = 1"),
    "prior_ping_lookback": O.with_ctes(O.AIS_RAW, O.clean_ctes(), O.timeline_ctes(WINDOW)) + "SELECT * FROM prior_ping",
    "timeline": O.with_ctes(O.AIS_RAW, O.clean_ctes(), O.timeline_ctes())
                + "SELECT mmsi, vessel_name, base_date_time, latitude, longitude, prev_ts, prev_lat, prev_lon FROM timeline",
    "dark_gaps": O.gold() + O.DARK_GAP_SELECT,
    "impossible_speed": O.gold() + O.SPEED_SELECT,
    "anomaly_cues": O.gold(cues=True) + O.CUE_SELECT,
    "dark_gaps_window": O.gold(WINDOW) + O.DARK_GAP_SELECT,
    "impossible_speed_window": O.gold(WINDOW) + O.SPEED_SELECT,
    "anomaly_cues_window": O.gold(WINDOW, cues=True) + O.CUE_SELECT,
    "vessel_names": O.gold(features=True) + "SELECT mmsi, vessel_name FROM profile",
    "vessels_any": O.gold(features=True) + "SELECT mmsi FROM profile WHERE n_dark_gaps + n_impossible_speed > 0",
    "gap_profile": O.gold(features=True) + "SELECT mmsi, n_dark_gaps, " + O.r6("avg_gap_hours")
                   + ", max_gap_hours, " + O.r6("max_dark_score") + " FROM profile WHERE n_dark_gaps > 0",
    "jump_profile": O.gold(features=True) + "SELECT mmsi, n_impossible_speed, "
                    + O.r6("max_implied_speed", "max_jump_nm", "max_speed_score") + " FROM profile WHERE n_impossible_speed > 0",
    "sanctions_match": O.gold(features=True) + "SELECT mmsi, is_sanctioned, sanctions_mmsi_only_hit FROM listed "
                       "WHERE sanctions_mmsi_only_hit = 1",
    "vessel_features": O.gold(features=True) + O.FEATURE_SELECT,
    "vessel_features_partials": O.gold(features=True) + O.FEATURE_SELECT,
    "dark_gaps_hot_vessel": O.gold(hot=True) + O.DARK_GAP_SELECT,
    "vessel_day_partials": O.gold() + """, ev AS (
  SELECT mmsi, event_date, vessel_name, TRUE AS g, FALSE AS j, gap_hours, anomaly_score AS gscore,
         CAST(NULL AS DOUBLE) AS spd, CAST(NULL AS DOUBLE) AS dist, CAST(NULL AS DOUBLE) AS jscore
  FROM dark_gaps
  UNION ALL
  SELECT mmsi, event_date, vessel_name, FALSE, distance_nm BETWEEN 2 AND 500 AND implied_speed_knots > 50,
         NULL, NULL, implied_speed_knots, distance_nm, anomaly_score
  FROM impossible_speed)
SELECT mmsi, event_date, max(vessel_name) AS vessel_name,
  count(*) FILTER (WHERE g) AS n_dark_gaps, CAST(sum(gap_hours) AS BIGINT) AS sum_gap_hours,
  max(gap_hours) AS max_gap_hours, round(max(gscore), 6) AS max_dark_score,
  count(*) FILTER (WHERE j) AS n_impossible_speed,
  round(max(spd) FILTER (WHERE j), 6) AS max_implied_speed,
  round(max(dist) FILTER (WHERE j), 6) AS max_jump_nm,
  round(max(jscore) FILTER (WHERE j), 6) AS max_speed_score
FROM ev GROUP BY mmsi, event_date""",
}


def _merge() -> None:
    from vesseltrack.plans import registry_control, registry_extensions, registry_landing, registry_live, registry_model, registry_situations
    for mod in (registry_control, registry_extensions, registry_landing, registry_live, registry_model, registry_situations):
        QUERIES.update(mod.QUERIES)
        ORACLE.update(mod.ORACLE)


_merge()

ORACLE["timeline_split_stress"] = ORACLE["timeline"]
ORACLE["snapshot_overwrite"] = ORACLE["sanctions_flatten"]
