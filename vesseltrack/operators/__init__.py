"""DataFrame operators; each takes and returns lazy DataFrames."""

from vesseltrack.operators.clean import clean, dedup_latest, quality_flag
from vesseltrack.operators.cues import anomaly_cues
from vesseltrack.operators.detect import dark_gaps, impossible_speed
from vesseltrack.operators.features import (
    features_from_partials, gap_profile, jump_profile, sanctions_match, vessel_day_partials, vessel_features,
    vessel_names, vessels_any,
)
from vesseltrack.operators.iforest import risk_scores
from vesseltrack.operators.quality import RULES, run_checks
from vesseltrack.operators.quantile import exact_quantile
from vesseltrack.operators.report import report_lines, report_table, scoring_summary, top_scored, watchlist
from vesseltrack.operators.timeline import daily_last_ping, prior_ping, timeline

__all__ = [
    "clean", "dedup_latest", "quality_flag", "anomaly_cues", "dark_gaps", "impossible_speed",
    "features_from_partials", "gap_profile", "jump_profile", "sanctions_match", "vessel_day_partials",
    "vessel_features", "vessel_names", "vessels_any", "risk_scores", "RULES", "run_checks", "exact_quantile",
    "report_lines", "report_table", "scoring_summary", "top_scored", "watchlist", "daily_last_ping",
    "prior_ping", "timeline",
]
