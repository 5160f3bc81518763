"""Registered queries of the further checks and reports (operators/extensions.py) with their DuckDB twins."""

from __future__ import annotations

from vesseltrack import oracle as O
from vesseltrack.operators import extensions as X
from vesseltrack.operators.features import vessel_features


def _silver(op):
    def query(spark, d):
        from vesseltrack.plans.registry import Inputs, for_compare
        return for_compare(op(Inputs(spark, d).clean()))
    return query


def _events(op):
    def query(spark, d):
        from vesseltrack.plans.registry import Inputs, for_compare
        return for_compare(op(Inputs(spark, d)))
    return query


FEATURES = ["mmsi", "vessel_name", "is_sanctioned", "total_anomalies", "n_dark_gaps"]

QUERIES = {
    "ext_anchored_but_moving": _silver(X.anchored_but_moving),
    "ext_identity_risk": _silver(X.identity_risk),
    "ext_tanker_class_b": _silver(X.tanker_on_class_b),
    "ext_odd_dimensions": _silver(X.odd_dimensions),
    "ext_heading_off_course": _silver(X.heading_off_course),
    "ext_cargo_against_type": _silver(X.cargo_against_type),
    "ext_area_silence": _events(lambda i: X.area_silence(i.gaps(), size=2.0)),
    "ext_crowding": _silver(lambda s: X.crowding(s, size=2.0, unit="hour", min_vessels=2)),
    "ext_sanctions_by_imo": _events(lambda i: X.sanctions_by_imo(i.clean(), i.sanctions())),
    "ext_two_tier_ranking": _events(lambda i: X.two_tier_ranking(
        vessel_features(i.gaps(), i.jumps(), i.sanctions()), "total_anomalies").select(*FEATURES)),
    "ext_draught_changes": _silver(X.draught_changes),
    "ext_heat_map": _events(lambda i: X.heat_map(i.gaps(), i.jumps())),
    "ext_disappearance_timeline": _events(lambda i: X.disappearance_timeline(i.gaps())),
    "ext_type_priority": _events(lambda i: X.type_priority(i.gaps(), i.silver())),
}

_CLEAN = O.with_ctes(O.AIS_RAW, O.clean_ctes())
_GOLD = O.gold()


def _cell(lat: str, lon: str, size: float) -> str:
    return f"CAST(floor({lat} / {size}) AS INTEGER) AS cell_lat, CAST(floor({lon} / {size}) AS INTEGER) AS cell_lon"


def _imo(c: str) -> str:
    return f"nullif(ltrim(regexp_replace({c}, '[^0-9]', '', 'g'), '0'), '')"


ORACLE = {
    "ext_anchored_but_moving": _CLEAN + "SELECT mmsi, base_date_time, status, sog FROM ais_clean WHERE status = 1 AND sog > 5 AND NOT isnan(sog)",
    "ext_identity_risk": _CLEAN + """SELECT mmsi, count(*) AS pings, sum(CAST(imo IS NULL OR trim(imo) = '' OR trim(imo) = 'IMO0000000' AS INT)) AS without_imo
FROM ais_clean GROUP BY mmsi HAVING without_imo > 0""",
    "ext_tanker_class_b": _CLEAN + "SELECT mmsi, base_date_time, vessel_type, transceiver FROM ais_clean "
                                   "WHERE vessel_type // 10 = 8 AND transceiver = 'B'",
    "ext_odd_dimensions": _CLEAN + "SELECT mmsi, base_date_time, length, width FROM ais_clean WHERE length - 20 * width > 0",
    "ext_heading_off_course": _CLEAN + """, d AS (SELECT *, least(abs(heading - cog), 360 - abs(heading - cog)) AS apart FROM ais_clean)
SELECT mmsi, base_date_time, heading, cog, round(apart, 6) AS divergence FROM d WHERE sog >= 3 AND heading <> 511 AND apart > 45""",
    "ext_cargo_against_type": _CLEAN + "SELECT mmsi, base_date_time, vessel_type, cargo FROM ais_clean WHERE cargo // 10 <> vessel_type // 10",
    "ext_area_silence": _GOLD + f"""SELECT {_cell('last_known_lat', 'last_known_lon', 2.0)}, date_trunc('hour', gap_start) AS hour,
  count(DISTINCT mmsi) AS vessels FROM dark_gaps GROUP BY ALL HAVING vessels >= 2""",
    "ext_crowding": _CLEAN + f"""SELECT {_cell('latitude', 'longitude', 2.0)}, date_trunc('hour', base_date_time) AS at,
  count(DISTINCT mmsi) AS vessels FROM ais_clean GROUP BY ALL HAVING vessels >= 2""",
    "ext_sanctions_by_imo": O.with_ctes(O.AIS_RAW, O.SANCTIONS, O.clean_ctes()) + f"""
SELECT DISTINCT {_imo('imo')} AS imo_key, c.mmsi, entity_id, entity_name FROM ais_clean c JOIN sanctions s ON {_imo('c.imo')} = {_imo('s.imo_number')}""",
    "ext_two_tier_ranking": O.gold(features=True) + "SELECT mmsi, vessel_name, is_sanctioned, total_anomalies, n_dark_gaps FROM vessel_features "
                            "ORDER BY is_sanctioned DESC, total_anomalies DESC, mmsi LIMIT 20",
    "ext_draught_changes": _CLEAN + """, daily AS (
  SELECT DISTINCT ON (mmsi, event_date) mmsi, event_date, draft FROM ais_clean
  WHERE draft IS NOT NULL AND base_date_time IS NOT NULL ORDER BY mmsi, event_date, base_date_time DESC)
SELECT a.mmsi, a.event_date, a.draft, b.draft AS prev_draft, b.event_date AS prev_date
FROM daily a ASOF JOIN daily b ON a.mmsi = b.mmsi AND a.event_date > b.event_date WHERE abs(a.draft - b.draft) >= 2""",
    "ext_heat_map": _GOLD + f"""SELECT cell_lat, cell_lon, count(*) FILTER (kind = 'g') AS dark_gaps, count(*) FILTER (kind = 'j') AS impossible_speeds FROM (
  SELECT {_cell('last_known_lat', 'last_known_lon', 1.0)}, 'g' AS kind FROM dark_gaps
  UNION ALL SELECT {_cell('from_lat', 'from_lon', 1.0)}, 'j' FROM impossible_speed) GROUP BY ALL""",
    "ext_disappearance_timeline": _GOLD + """SELECT CAST(gap_start AS DATE) AS day, count(*) AS dark_gaps, count(DISTINCT mmsi) AS vessels,
  CAST(sum(gap_hours) AS BIGINT) AS hours FROM dark_gaps GROUP BY ALL""",
    "ext_type_priority": _GOLD + """, kinds AS (SELECT mmsi, max(vessel_type) AS vessel_type FROM ais_clean GROUP BY mmsi)
SELECT g.mmsi, event_date, anomaly_type, k.vessel_type, round(anomaly_score * CASE k.vessel_type // 10 WHEN 8 THEN 1.0 WHEN 7 THEN 0.8 WHEN 3 THEN 0.6 WHEN 6 THEN 0.5
  ELSE 0.3 END, 6) AS priority FROM dark_gaps g LEFT JOIN kinds k ON g.mmsi = k.mmsi""",
}
