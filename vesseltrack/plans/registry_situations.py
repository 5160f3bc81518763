"""Registered queries of situations and checked codes, with their DuckDB twins.

The adapter's pings are far apart in space and time, so the queries use wide
limits (miles, hours); the operators' defaults are those of real positions.
"""

from __future__ import annotations

from vesseltrack import oracle as O
from vesseltrack.operators import extensions as X
from vesseltrack.operators import situations as S

CROWD = {"nm": 30.0, "unit": "day", "min_vessels": 3}
CALLS = {"max_speed": 40.0, "radius_nm": 500.0, "min_hours": 1.0, "max_silence_hours": 100.0}
LEVELS = 6


def _query(op, rounded: tuple[str, ...] = ()):
    def query(spark, d):
        from vesseltrack.plans.registry import Inputs, for_compare
        return for_compare(op(Inputs(spark, d)), rounded)
    return query


QUERIES = {
    "ext_outages": _query(lambda i: S.outages(i.gaps(), size=2.0)),
    "ext_crowds": _query(lambda i: S.crowds(i.clean(), **CROWD), ("lat",)),
    "ext_crowds_moved_grid": _query(lambda i: S.crowds(i.clean(), origin=0.123, **CROWD), ("lat",)),
    "ext_port_calls": _query(lambda i: S.port_calls(i.silver(), **CALLS)),
    "ext_draught_between_calls": _query(lambda i: S.draught_between_calls(i.silver(), **CALLS), ("change",)),
    "ext_zones": _query(lambda i: S.zones(i.gaps(), i.jumps(), LEVELS)),
    "ext_identity_check": _query(lambda i: X.identity_check(i.clean())),
    "ext_sanctions_by_checked_imo": _query(lambda i: X.sanctions_by_checked_imo(i.clean(), i.sanctions())),
    "ext_cargo_conflicts": _query(lambda i: X.cargo_conflicts(i.clean())),
}

_CLEAN = O.with_ctes(O.AIS_RAW, O.clean_ctes())
_GOLD = O.gold()


def _nm(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (f"3440.065 * 2 * asin(sqrt(least(1.0, pow(sin(radians({lat2} - {lat1}) / 2), 2) "
            f"+ cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))")


# vessels reach one another over pairs; a group is named by the least vessel that its members reach
_CROWDS = _CLEAN + f""", seen AS (
  SELECT date_trunc('{CROWD["unit"]}', base_date_time) AS "at", mmsi, arg_max({{'lat': latitude, 'lon': longitude}}, base_date_time) AS p
  FROM ais_clean WHERE base_date_time IS NOT NULL AND mmsi IS NOT NULL GROUP BY ALL),
pair AS (SELECT a."at", a.mmsi, b.mmsi AS other FROM seen a JOIN seen b ON a."at" = b."at" AND {_nm('a.p.lat', 'a.p.lon', 'b.p.lat', 'b.p.lon')} <= {CROWD["nm"]}),
part AS (WITH RECURSIVE reach AS (
  SELECT "at", mmsi, other FROM pair
  UNION SELECT r."at", r.mmsi, p.other FROM reach r JOIN pair p ON p."at" = r."at" AND p.mmsi = r.other)
  SELECT "at", mmsi, min(other) AS part FROM reach GROUP BY ALL)
SELECT "at", min(s.mmsi) AS first_mmsi, count(*) AS vessels, min(p.lat) AS south, max(p.lat) AS north, round(avg(p.lat), 6) AS lat
FROM part JOIN seen s USING ("at", mmsi) GROUP BY "at", part HAVING count(*) >= {CROWD["min_vessels"]}"""

_CALLS = _CLEAN + f""", ping AS (
  SELECT mmsi, base_date_time AS "at", latitude, longitude, draft, coalesce(sog <= {CALLS["max_speed"]}, false) AS slow,
    lag(base_date_time) OVER w AS prev_at, lag(latitude) OVER w AS prev_lat, lag(longitude) OVER w AS prev_lon,
    lag(coalesce(sog <= {CALLS["max_speed"]}, false)) OVER w AS prev_slow
  FROM ais_clean WHERE base_date_time IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL
  WINDOW w AS (PARTITION BY mmsi ORDER BY base_date_time)),
marked AS (
  SELECT *, sum(CASE WHEN prev_slow AND {_nm('prev_lat', 'prev_lon', 'latitude', 'longitude')} <= {CALLS["radius_nm"]}
                      AND "at" - prev_at <= INTERVAL {int(CALLS["max_silence_hours"])} HOUR THEN 0 ELSE 1 END) OVER (PARTITION BY mmsi ORDER BY "at") AS run
  FROM ping WHERE slow),
calls AS (
  SELECT mmsi, min("at") AS arrived, max("at") AS "left", count(*) AS pings, arg_min(latitude, "at") AS lat, arg_min(longitude, "at") AS lon,
    arg_min(draft, "at") FILTER (draft IS NOT NULL) AS draft_in, arg_max(draft, "at") FILTER (draft IS NOT NULL) AS draft_out
  FROM marked GROUP BY mmsi, run HAVING max("at") - min("at") >= INTERVAL {int(CALLS["min_hours"])} HOUR)
"""

_IMO_DIGITS = "regexp_extract(upper(trim({0})), '^(IMO)?\\s*([0-9]{{7}})$', 2)"


def _imo(c: str) -> str:
    d = _IMO_DIGITS.format(c)
    total = f"list_sum(list_transform(range(1, 7), lambda i: (8 - i) * CAST(substr({d}, i, 1) AS INT)))"
    return f"CASE WHEN {d} <> '' AND {d} <> '0000000' THEN CASE WHEN {total} % 10 = CAST(substr({d}, 7, 1) AS INT) THEN {d} END END"


_NO_IMO = "(imo IS NULL OR trim(imo) IN ('', 'IMO0000000'))"
_IN_USE = "{0} BETWEEN 20 AND 99"
_KIND = "CASE WHEN {0} // 10 IN (3, 5) THEN {0} ELSE {0} // 10 * 10 END"
_HAZARD = "CASE WHEN {0} // 10 NOT IN (3, 5) AND {0} % 10 BETWEEN 1 AND 4 THEN {0} % 10 END"

ORACLE = {
    # every instant at which a gap starts or ends, and the gaps that hold it; neighbours with enough of them are one period
    "ext_outages": _GOLD + """, g AS (
  SELECT CAST(floor(last_known_lat / 2.0) AS INTEGER) AS cell_lat, CAST(floor(last_known_lon / 2.0) AS INTEGER) AS cell_lon, gap_start, gap_end
  FROM dark_gaps WHERE last_known_lat IS NOT NULL AND last_known_lon IS NOT NULL),
t AS (SELECT cell_lat, cell_lon, gap_start AS "at" FROM g UNION SELECT cell_lat, cell_lon, gap_end FROM g),
n AS (SELECT t.cell_lat, t.cell_lon, t."at", count(g.gap_start) AS dark FROM t LEFT JOIN g
      ON g.cell_lat = t.cell_lat AND g.cell_lon = t.cell_lon AND t."at" >= g.gap_start AND t."at" < g.gap_end GROUP BY ALL),
s AS (SELECT *, lead("at") OVER w AS until, lag(dark, 1, 0) OVER w >= 2 AS before FROM n WINDOW w AS (PARTITION BY cell_lat, cell_lon ORDER BY "at")),
p AS (SELECT *, count(*) FILTER (NOT before) OVER (PARTITION BY cell_lat, cell_lon ORDER BY "at") AS nth FROM s WHERE dark >= 2)
SELECT cell_lat, cell_lon, min("at") AS began, max(until) AS ended, max(dark) AS peak FROM p GROUP BY cell_lat, cell_lon, nth""",
    "ext_crowds": _CROWDS,
    "ext_crowds_moved_grid": _CROWDS,
    "ext_port_calls": _CALLS + 'SELECT mmsi, arrived, "left", pings, lat, lon, draft_in, draft_out FROM calls',
    "ext_draught_between_calls": _CALLS + """SELECT b.mmsi, a."left", b.arrived, a.lat AS from_lat, a.lon AS from_lon, b.lat AS to_lat, b.lon AS to_lon,
  a.draft_out, b.draft_in, round(b.draft_in - a.draft_out, 6) AS change FROM calls b ASOF JOIN calls a ON a.mmsi = b.mmsi AND b.arrived > a.arrived""",
    "ext_zones": _GOLD + f""", e AS (
  SELECT last_known_lat AS lat, last_known_lon AS lon, gap_hours AS h, 1 AS g FROM dark_gaps WHERE last_known_lat IS NOT NULL AND last_known_lon IS NOT NULL
  UNION ALL SELECT from_lat, from_lon, 0, 0 FROM impossible_speed WHERE from_lat IS NOT NULL AND from_lon IS NOT NULL)
SELECT CAST(k AS INTEGER) AS level, CAST(least(floor((sin(radians(lat)) + 1) / 2 * pow(2, k)), pow(2, k) - 1) AS BIGINT) AS "row",
  CAST(least(floor((lon + 180) / 360 * pow(2, k)), pow(2, k) - 1) AS BIGINT) AS "column",
  CAST(sum(g) AS BIGINT) AS dark_gaps, CAST(sum(h) AS BIGINT) AS dark_hours, CAST(sum(1 - g) AS BIGINT) AS impossible_speeds
FROM e, range({LEVELS + 1}) l(k) GROUP BY ALL""",
    "ext_identity_check": _CLEAN + f""", c AS (SELECT mmsi, {_NO_IMO} AS none, {_imo('imo')} AS number FROM ais_clean)
SELECT mmsi, count(*) AS pings, count(*) FILTER (none) AS without_imo, count(*) FILTER (NOT none AND number IS NULL) AS false_imo,
  count(DISTINCT number) AS numbers_used FROM c GROUP BY mmsi HAVING without_imo + false_imo > 0 OR numbers_used > 1""",
    "ext_sanctions_by_checked_imo": O.with_ctes(O.AIS_RAW, O.SANCTIONS, O.clean_ctes()) + f""", v AS (SELECT DISTINCT mmsi, {_imo('imo')} AS imo FROM ais_clean)
SELECT v.mmsi, v.imo, entity_id, entity_name FROM v JOIN (SELECT *, {_imo('imo_number')} AS number FROM sanctions) s ON s.number = v.imo""",
    "ext_cargo_conflicts": _CLEAN + f"""SELECT * FROM (
  SELECT mmsi, base_date_time, vessel_type, cargo, CASE
    WHEN NOT ({_IN_USE.format('vessel_type')} AND {_IN_USE.format('cargo')}) THEN 'unknown code'
    WHEN {_KIND.format('vessel_type')} <> {_KIND.format('cargo')} THEN 'other kind'
    WHEN {_HAZARD.format('vessel_type')} <> {_HAZARD.format('cargo')} THEN 'other hazard' END AS verdict
  FROM ais_clean WHERE cargo IS NOT NULL AND vessel_type IS NOT NULL) WHERE verdict IS NOT NULL""",
}
