"""Registered queries for model inputs, quality checks, scores and report rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from vesseltrack import oracle as O
from vesseltrack.operators.features import vessel_features
from vesseltrack.operators.iforest import (
    CAPS, CONTAMINATION, N_TREES, SAMPLE_SIZE, SEED, model_column, model_inputs, risk_scores, standardise,
)
from vesseltrack.operators.quality import RULES, run_checks
from vesseltrack.operators.quantile import exact_quantiles
from vesseltrack.operators.report import report_lines, report_table, scoring_summary, top_k, top_scored, watchlist
from vesseltrack.schemas import MODEL_FEATURES
from vesseltrack.session import materialize


def _features(spark, d):
    from vesseltrack.plans.registry import Inputs
    i = Inputs(spark, d)
    return vessel_features(i.gaps(), i.jumps(), i.sanctions()), i


def _model_frame(x, rounded: bool):
    cols = [F.col(model_column(c)).alias(c) for c in MODEL_FEATURES]
    if rounded:
        cols = [F.round(F.col(model_column(c)), 6).alias(c) for c in MODEL_FEATURES]
    return x.select("mmsi", *cols)


def _q_capped(spark, d):
    f, _ = _features(spark, d)
    return _model_frame(model_inputs(f), rounded=True)


def _q_scaled(spark, d):
    f, _ = _features(spark, d)
    return _model_frame(standardise(model_inputs(f)), rounded=True)


def _q_check_not_null(spark, d):
    from vesseltrack.plans.registry import Inputs
    i = Inputs(spark, d)
    rules = [r for r in RULES["ais_clean"] if r[0] == "not_null"]
    return run_checks(i.clean(), rules)


def _q_check_unique(spark, d):
    f, i = _features(spark, d)
    return run_checks(f, [("unique", "mmsi", None)]).unionByName(
        run_checks(i.sanctions(), [("unique", "entity_id", None)]))


def _q_check_accepted(spark, d):
    f, i = _features(spark, d)
    gaps_rules = [r for r in RULES["ais_dark_gaps"] if r[0] in ("accepted", "expr")]
    feat_rules = [r for r in RULES["vessel_features"] if r[0] in ("accepted", "expr")]
    clean_rules = [r for r in RULES["ais_clean"] if r[0] == "is_null"]
    return (run_checks(i.gaps(), gaps_rules)
            .unionByName(run_checks(f, feat_rules))
            .unionByName(run_checks(i.clean(), clean_rules)))


TOP_COLUMNS = ["mmsi", "vessel_name", "max_anomaly_score", "n_dark_gaps", "max_gap_hours",
               "n_impossible_speed", "max_implied_speed", "total_anomalies", "is_sanctioned"]


def _top_features(spark, d):
    f, _ = _features(spark, d)
    return top_k(f.where(F.col("max_anomaly_score") >= 0.7).select(*TOP_COLUMNS), "max_anomaly_score", 20)


def _q_top_vessels(spark, d):
    return _top_features(spark, d).select(
        *[F.round(c, 6).alias(c) if c in ("max_anomaly_score", "max_implied_speed") else F.col(c)
          for c in TOP_COLUMNS])


def _q_top_lines(spark, d):
    return report_lines(_top_features(spark, d), "max_anomaly_score")


def _q_top_cells(spark, d):
    return report_table(_top_features(spark, d), "max_anomaly_score")


def _scores(spark, d):
    f, _ = _features(spark, d)
    return risk_scores(spark, f)


SCORE_ROUNDED = ("risk_score", "avg_gap_hours", "max_implied_speed", "max_jump_nm", "max_anomaly_score")


def _q_risk_scores(spark, d):
    from vesseltrack.plans.registry import for_compare
    return for_compare(_scores(spark, d), SCORE_ROUNDED)


def _q_watchlist(spark, d):
    from vesseltrack.plans.registry import for_compare
    return for_compare(watchlist(_scores(spark, d)), ("risk_score", "max_implied_speed"))


def _q_report_lines(spark, d):
    return report_lines(watchlist(_scores(spark, d)))


def _q_check_window(spark, d):
    from vesseltrack.plans.registry import WINDOW, Inputs
    i = Inputs(spark, d)
    rules = [r for r in RULES["ais_clean"]]
    return run_checks(i.clean(), rules, window=WINDOW)


def _q_p95(spark, d):
    """Exact 95th percentile (linear) of every capped model input, from executors."""
    f, _ = _features(spark, d)
    x = materialize(model_inputs(f), "p95-inputs")
    found = exact_quantiles(x, [model_column(c) for c in MODEL_FEATURES], 0.95)  # all columns in both scans
    rows = [(c, found[model_column(c)]) for c in MODEL_FEATURES]
    return spark.createDataFrame(rows, "feature string, p95 double").select(
        "feature", F.round("p95", 6).alias("p95"))


def _q_score_summary(spark, d):
    from vesseltrack.plans.registry import for_compare
    return for_compare(scoring_summary(_scores(spark, d)), ("flagged_share",))


def _q_top_scored(spark, d):
    from vesseltrack.plans.registry import for_compare
    return for_compare(top_scored(_scores(spark, d)), ("risk_score",))


QUERIES = {
    "score_summary": _q_score_summary,
    "top_scored": _q_top_scored,
    "check_window": _q_check_window,
    "features_p95": _q_p95,
    "features_capped": _q_capped,
    "features_scaled": _q_scaled,
    "check_not_null": _q_check_not_null,
    "check_unique": _q_check_unique,
    "check_accepted": _q_check_accepted,
    "top_vessels": _q_top_vessels,
    "top_vessel_lines": _q_top_lines,
    "top_vessel_cells": _q_top_cells,
    "risk_scores": _q_risk_scores,
    "watchlist": _q_watchlist,
    "report_lines": _q_report_lines,
}


def _capped_sql(c: str) -> str:
    x = f"CAST(coalesce({c}, 0) AS DOUBLE)"
    return f"least({x}, {CAPS[c]})" if c in CAPS else x


_CAPPED = ("capped AS (SELECT mmsi, "
           + ", ".join(f"{_capped_sql(c)} AS {c}" for c in MODEL_FEATURES)
           + " FROM vessel_features)")

_SCALED_COLS = ", ".join(
    f"round(({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () > 0 "
    f"THEN stddev_pop({c}) OVER () ELSE 1 END, 6) AS {c}" for c in MODEL_FEATURES)

_FEAT = O.gold(features=True)


def _count_rule(rule: str, col: str, cond: str, table: str) -> str:
    return (f"SELECT '{rule}' AS rule, '{col}' AS column_name, "
            f"count(*) FILTER (WHERE {cond}) AS failures FROM {table}")


_NOT_NULL = " UNION ALL ".join(
    _count_rule("not_null", c, f"{c} IS NULL", "ais_clean")
    for c in ["mmsi", "base_date_time", "latitude", "longitude", "sog", "event_date"])

_UNIQUE = (
    "SELECT 'unique' AS rule, 'mmsi' AS column_name, count(*) AS failures FROM "
    "(SELECT mmsi FROM vessel_features WHERE mmsi IS NOT NULL GROUP BY mmsi HAVING count(*) > 1) "
    "UNION ALL SELECT 'unique', 'entity_id', count(*) FROM "
    "(SELECT entity_id FROM sanctions WHERE entity_id IS NOT NULL GROUP BY entity_id HAVING count(*) > 1)")

_ACCEPTED = " UNION ALL ".join([
    _count_rule("accepted", "anomaly_type", "anomaly_type IS NOT NULL AND anomaly_type NOT IN ('dark_gap')",
                "dark_gaps"),
    _count_rule("expr", "gap_hours", "NOT coalesce(gap_hours >= 6, false)", "dark_gaps"),
    _count_rule("expr", "anomaly_score", "NOT coalesce(anomaly_score BETWEEN 0 AND 1, false)", "dark_gaps"),
    _count_rule("accepted", "is_sanctioned", "is_sanctioned IS NOT NULL AND is_sanctioned NOT IN (0, 1)",
                "vessel_features"),
    _count_rule("expr", "total_anomalies", "NOT coalesce(total_anomalies >= 1, false)", "vessel_features"),
    _count_rule("is_null", "quality_flag", "quality_flag IS NOT NULL", "ais_clean"),
])

_TOP = """
, top AS (
  SELECT mmsi, vessel_name, max_anomaly_score, n_dark_gaps, max_gap_hours, n_impossible_speed,
         max_implied_speed, total_anomalies, is_sanctioned
  FROM vessel_features WHERE max_anomaly_score >= 0.7
  ORDER BY max_anomaly_score DESC, mmsi ASC LIMIT 20
)
"""
_NAME = "CASE WHEN coalesce(vessel_name, '') = '' THEN '—' ELSE vessel_name END"


def _fixed_sql(c: str, d: int) -> str:
    return f"coalesce(printf('%.{d}f', CAST({c} AS DOUBLE)), '—')"


def _int_sql(c: str) -> str:
    return f"coalesce(CAST(CAST(trunc(CAST({c} AS DOUBLE)) AS BIGINT) AS VARCHAR), '—')"


def _forest_sql(seed: int = SEED, trees: int = N_TREES, sample: int = SAMPLE_SIZE, share: float = CONTAMINATION) -> str:
    """The forest grown and walked by a recursive query.

    Every vessel walks down every tree; only those drawn for the tree (``picked``)
    decide its splits. The draws are those of the operator, by definition of the
    model: ranks (a + t b) mod p, and digests of seed, node and tree. Splits are
    taken on the capped inputs as they are: scaling a column moves its thresholds
    along, so the path lengths stay.
    """
    digest = "md5(concat_ws(':', {0}))"

    def number(text: str, part: int) -> str:
        return f"('0x' || substr({digest.format(text)}, {1 + 13 * part}, 13))::BIGINT"

    xs = ", ".join(f"CAST({c} AS DOUBLE)" for c in MODEL_FEATURES)
    spread = ", ".join(f"{f}(x[{i + 1}]) FILTER (picked) OVER w AS {f}{i + 1}" for i in range(len(MODEL_FEATURES)) for f in ("min", "max"))
    lows, highs = (", ".join(f"{f}{i + 1}" for i in range(len(MODEL_FEATURES))) for f in ("min", "max"))
    mean_path = "CASE WHEN {0} > 2 THEN 2 * (ln({0} - 1.0) + 0.5772156649015329) - 2 * ({0} - 1.0) / {0} WHEN {0} = 2 THEN 1.0 ELSE 0.0 END"
    return _FEAT + ", " + _CAPPED + f""",
sizes AS (SELECT count(*) AS rows, least(count(*), {sample}) AS need FROM capped),
deepest AS (SELECT greatest(1, CAST(ceil(log2(greatest(need, 2))) AS INT)) AS depth FROM sizes),
ranked AS (
  SELECT mmsi, [{xs}] AS x, t.t AS tree, row_number() OVER (
    PARTITION BY t.t ORDER BY ({number(f"{seed}, mmsi", 0)} % 4503599627370449 + t.t * ({number(f"{seed}, mmsi", 1)} % 4503599627370449)) % 4503599627370449, mmsi) AS nth
  FROM capped, range({trees}) t(t)),
walk AS (WITH RECURSIVE step AS (
  SELECT mmsi, x, tree, nth <= need AS picked, 1 AS node, 0 AS depth, CAST(NULL AS DOUBLE) AS path FROM ranked, sizes
  UNION ALL
  SELECT mmsi, x, tree, picked, CASE WHEN f IS NULL THEN node WHEN x[f] <= cut THEN 2 * node ELSE 2 * node + 1 END, depth + 1,
         CASE WHEN f IS NULL THEN depth + {mean_path.format('n')} END
  FROM (
    SELECT *, CASE WHEN lows[f] + share * (highs[f] - lows[f]) >= highs[f] THEN lows[f] ELSE lows[f] + share * (highs[f] - lows[f]) END AS cut
    FROM (
      SELECT *, CASE WHEN depth < most AND n > 1 THEN open[1 + CAST(floor({number(f"{seed}, node, tree", 0)} / 4503599627370496.0 * len(open)) AS INT)] END AS f,
             {number(f"{seed}, node, tree", 1)} / 4503599627370496.0 AS share
      FROM (
        SELECT *, list_filter(range(1, {len(MODEL_FEATURES) + 1}), lambda i: highs[i] > lows[i]) AS open
        FROM (
          SELECT *, [{lows}] AS lows, [{highs}] AS highs FROM (
            SELECT mmsi, x, tree, picked, node, step.depth, deepest.depth AS most, count(*) FILTER (picked) OVER w AS n, {spread}
            FROM step, deepest WHERE path IS NULL WINDOW w AS (PARTITION BY tree, node)))))))
  SELECT * FROM step),
raw AS (SELECT mmsi, pow(2, -(sum(path) / {trees}) / CASE WHEN any_value(need) > 1 THEN {mean_path.format('any_value(need)')} ELSE 1 END) AS raw
        FROM walk, sizes WHERE path IS NOT NULL GROUP BY mmsi),
ends AS (SELECT min(raw) AS lo, max(raw) AS hi, quantile_cont(raw, {1 - share}) AS cut FROM raw),
scores AS (
  SELECT f.*, CASE WHEN hi > lo THEN (raw - lo) / (hi - lo) ELSE 0 END AS risk_score, raw > cut AS is_outlier
  FROM vessel_features f JOIN raw USING (mmsi), ends),
watchlist AS (SELECT * FROM scores WHERE is_outlier AND risk_score >= 0.7 ORDER BY risk_score DESC, mmsi LIMIT 20)
"""


_SCORES = _forest_sql()

_WIN_NOT_NULL = " UNION ALL ".join(
    _count_rule("not_null", c, f"{c} IS NULL", "win")
    for c in ["mmsi", "base_date_time", "latitude", "longitude", "sog", "event_date"]) + " UNION ALL " + \
    _count_rule("is_null", "quality_flag", "quality_flag IS NOT NULL", "win")

ORACLE = {
    "risk_scores": _SCORES + "SELECT mmsi, vessel_name, total_anomalies, is_outlier, "
                   + ", ".join(f"round({c}, 6) AS {c}" if c in SCORE_ROUNDED else c for c in (*MODEL_FEATURES, "risk_score")) + " FROM scores",
    "watchlist": _SCORES + "SELECT mmsi, vessel_name, round(risk_score, 6) AS risk_score, n_dark_gaps, max_gap_hours, n_impossible_speed, "
                 "round(max_implied_speed, 6) AS max_implied_speed, total_anomalies, is_sanctioned FROM watchlist",
    "report_lines": _SCORES + (
        "SELECT CAST(row_number() OVER (ORDER BY risk_score DESC, mmsi) AS INTEGER) AS rank, "
        f"{_NAME} || ' | ' || mmsi || ' | risk ' || printf('%.3f', risk_score) || ' | ' || CAST(total_anomalies AS VARCHAR) || ' anomalies' "
        "|| CASE WHEN is_sanctioned = 1 THEN ' | SANCTIONED' ELSE '' END AS line FROM watchlist"),
    "score_summary": _SCORES + "SELECT count(*) AS vessels, count(*) FILTER (is_outlier) AS flagged, "
                     "round(avg(CAST(is_outlier AS INT)), 6) AS flagged_share FROM scores",
    "top_scored": _SCORES + "SELECT mmsi, vessel_name, round(risk_score, 6) AS risk_score, total_anomalies, is_sanctioned FROM scores "
                  "ORDER BY scores.risk_score DESC, mmsi LIMIT 10",
    "check_window": O.with_ctes(O.AIS_RAW, O.clean_ctes()) + ", win AS (SELECT * FROM ais_clean WHERE event_date "
                    f"BETWEEN DATE '{O.WINDOW[0]}' AND DATE '{O.WINDOW[1]}') " + _WIN_NOT_NULL,
    "features_p95": _FEAT + ", " + _CAPPED + " " + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(quantile_cont({c}, 0.95), 6) AS p95 FROM capped" for c in MODEL_FEATURES),
    "features_capped": _FEAT + ", " + _CAPPED + " SELECT mmsi, "
                       + ", ".join(f"round({c}, 6) AS {c}" for c in MODEL_FEATURES) + " FROM capped",
    "features_scaled": _FEAT + ", " + _CAPPED + f" SELECT mmsi, {_SCALED_COLS} FROM capped",
    "check_not_null": O.with_ctes(O.AIS_RAW, O.clean_ctes()) + _NOT_NULL,
    "check_unique": _FEAT + _UNIQUE,
    "check_accepted": _FEAT + _ACCEPTED,
    "top_vessels": _FEAT + _TOP + "SELECT mmsi, vessel_name, round(max_anomaly_score, 6) AS max_anomaly_score, "
                   "n_dark_gaps, max_gap_hours, n_impossible_speed, round(max_implied_speed, 6) AS max_implied_speed, "
                   "total_anomalies, is_sanctioned FROM top",
    "top_vessel_lines": _FEAT + _TOP + (
        "SELECT CAST(row_number() OVER (ORDER BY max_anomaly_score DESC, mmsi ASC) AS INTEGER) AS rank, "
        f"{_NAME} || ' | ' || mmsi || ' | risk ' || printf('%.3f', max_anomaly_score) || ' | ' "
        "|| CAST(total_anomalies AS VARCHAR) || ' anomalies' "
        "|| CASE WHEN is_sanctioned = 1 THEN ' | SANCTIONED' ELSE '' END AS line FROM top"),
    "top_vessel_cells": _FEAT + _TOP + (
        f"SELECT {_NAME} AS vessel, mmsi, {_fixed_sql('max_anomaly_score', 3)} AS risk, "
        f"{_int_sql('n_dark_gaps')} || ' · max ' || {_fixed_sql('max_gap_hours', 1)} || ' h' AS dark_gaps, "
        f"{_int_sql('n_impossible_speed')} || ' · max ' || {_fixed_sql('max_implied_speed', 1)} || ' kn' "
        "AS speed_jumps, "
        f"{_int_sql('total_anomalies')} AS total, "
        "CASE WHEN is_sanctioned = 1 THEN 'SANCTIONED' ELSE '—' END AS sanctions FROM top"),
}
