"""Per-vessel behaviour features (D8) and corroborated sanctions matches.

Built for one shuffle of the event rows: dark gaps and plausible jumps are
unioned and aggregated by MMSI in a single pass (partial aggregation map-side,
so a hot MMSI costs one row per map task). Sanctions are reduced per MMSI to
their set of normalised names and broadcast after a size check; the match is
then a lookup, not a fan-out join followed by a second aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vesseltrack.functions import normalise_name, valid_mmsi
from vesseltrack.operators.joins import DEFAULT_BROADCAST_ROWS, maybe_broadcast
from vesseltrack.schemas import FEATURE_COLUMNS

# A "jump" counts as a feature only in this distance band and above this speed.
JUMP_MIN_NM = 2
JUMP_MAX_NM = 500
JUMP_MIN_KNOTS = 50


def plausible_jumps(jumps: DataFrame) -> DataFrame:
    """Jumps that are neither GPS jitter (< 2 nm), bad fixes (> 500 nm) nor fast ferries."""
    return jumps.where(F.col("distance_nm").between(JUMP_MIN_NM, JUMP_MAX_NM)
                       & (F.col("implied_speed_knots") > JUMP_MIN_KNOTS))


def gap_profile(gaps: DataFrame) -> DataFrame:
    """A1: count, mean and max gap hours and max score per vessel."""
    return gaps.groupBy("mmsi").agg(
        F.count(F.lit(1)).alias("n_dark_gaps"),
        F.avg("gap_hours").alias("avg_gap_hours"),
        F.max("gap_hours").alias("max_gap_hours"),
        F.max("anomaly_score").alias("max_dark_score"))


def jump_profile(jumps: DataFrame) -> DataFrame:
    """A2: plausible-jump count, max speed, max distance and max score per vessel."""
    return plausible_jumps(jumps).groupBy("mmsi").agg(
        F.count(F.lit(1)).alias("n_impossible_speed"),
        F.max("implied_speed_knots").alias("max_implied_speed"),
        F.max("distance_nm").alias("max_jump_nm"),
        F.max("anomaly_score").alias("max_speed_score"))


def vessel_names(gaps: DataFrame, jumps: DataFrame) -> DataFrame:
    """A3: display name = max(vessel_name) over all detail rows (jumps unfiltered)."""
    return (gaps.select("mmsi", "vessel_name").unionByName(jumps.select("mmsi", "vessel_name"))
                .groupBy("mmsi").agg(F.max("vessel_name").alias("vessel_name")))


def vessels_any(gaps: DataFrame, jumps: DataFrame) -> DataFrame:
    """U4: vessels with at least one dark gap or one plausible jump."""
    return gaps.select("mmsi").union(plausible_jumps(jumps).select("mmsi")).distinct()


def sanctions_by_mmsi(sanctions: DataFrame) -> DataFrame:
    """Sanctions reduced to one row per MMSI with the set of normalised entity names."""
    return (sanctions.where(F.col("mmsi").isNotNull())
                     .groupBy("mmsi")
                     .agg(F.collect_set(normalise_name(F.col("entity_name"))).alias("_names")))


def sanctions_match(names: DataFrame, sanctions: DataFrame,
                    broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Per vessel with an MMSI hit, whether any entity's name also agrees.

    is_sanctioned = 1 when MMSI and normalised name agree (a null name never
    agrees); sanctions_mmsi_only_hit = 1 for every MMSI hit.
    """
    s = maybe_broadcast(sanctions_by_mmsi(sanctions), broadcast_rows)
    hit = names.join(s, "mmsi", "inner")
    agrees = F.coalesce(F.array_contains(F.col("_names"), normalise_name(F.col("vessel_name"))), F.lit(False))
    return hit.select("mmsi", F.when(agrees, 1).otherwise(0).alias("is_sanctioned"),
                      F.lit(1).alias("sanctions_mmsi_only_hit"))


def _event_rows(gaps: DataFrame, jumps: DataFrame, keys=("mmsi",)) -> DataFrame:
    """Both event kinds in one shape: flags, the values each feature needs, and ``keys``."""
    plausible = F.col("distance_nm").between(JUMP_MIN_NM, JUMP_MAX_NM) & (F.col("implied_speed_knots") > JUMP_MIN_KNOTS)
    extra = [k for k in keys if k != "mmsi"]
    g = gaps.select(*extra, "mmsi", "vessel_name", F.lit(True).alias("_gap"), F.lit(False).alias("_jump"),
                    "gap_hours", F.col("anomaly_score").cast("double").alias("_gscore"),
                    F.lit(None).cast("double").alias("implied_speed_knots"),
                    F.lit(None).cast("double").alias("distance_nm"),
                    F.lit(None).cast("double").alias("_jscore"))
    j = jumps.select(*extra, "mmsi", "vessel_name", F.lit(False).alias("_gap"), plausible.alias("_jump"),
                     F.lit(None).cast("long").alias("gap_hours"), F.lit(None).cast("double").alias("_gscore"),
                     "implied_speed_knots", "distance_nm", F.col("anomaly_score").alias("_jscore"))
    return g.unionByName(j)


def _jump_only(c: str):
    return F.when(F.col("_jump"), F.col(c))


def vessel_features(gaps: DataFrame, jumps: DataFrame, sanctions: DataFrame,
                    broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """One row per well-formed vessel id with at least one anomaly."""
    prof = _event_rows(gaps, jumps).groupBy("mmsi").agg(
        F.max("vessel_name").alias("vessel_name"),
        F.count_if(F.col("_gap")).alias("n_dark_gaps"),
        F.avg("gap_hours").alias("avg_gap_hours"),
        F.max("gap_hours").alias("max_gap_hours"),
        F.max("_gscore").alias("_max_gscore"),
        F.count_if(F.col("_jump")).alias("n_impossible_speed"),
        F.max(_jump_only("implied_speed_knots")).alias("max_implied_speed"),
        F.max(_jump_only("distance_nm")).alias("max_jump_nm"),
        F.max(_jump_only("_jscore")).alias("_max_jscore"))
    return _finish(prof, sanctions, broadcast_rows)


def vessel_day_partials(gaps: DataFrame, jumps: DataFrame) -> DataFrame:
    """Per (vessel, event day) partial aggregates of every feature.

    Written per window next to the gold tables, so the feature table is
    rebuilt from one row per vessel-day instead of every event of history.
    Means travel as exact integer sums and counts.
    """
    return _event_rows(gaps, jumps, ("mmsi", "event_date")).groupBy("mmsi", "event_date").agg(
        F.max("vessel_name").alias("vessel_name"),
        F.count_if(F.col("_gap")).alias("n_dark_gaps"),
        F.sum("gap_hours").alias("sum_gap_hours"),
        F.max("gap_hours").alias("max_gap_hours"),
        F.max("_gscore").alias("max_dark_score"),
        F.count_if(F.col("_jump")).alias("n_impossible_speed"),
        F.max(_jump_only("implied_speed_knots")).alias("max_implied_speed"),
        F.max(_jump_only("distance_nm")).alias("max_jump_nm"),
        F.max(_jump_only("_jscore")).alias("max_speed_score"))


def features_from_partials(partials: DataFrame, sanctions: DataFrame,
                           broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """D8 from :func:`vessel_day_partials`: the same rows as :func:`vessel_features`."""
    n_gaps = F.sum("n_dark_gaps")
    prof = partials.groupBy("mmsi").agg(
        F.max("vessel_name").alias("vessel_name"),
        n_gaps.alias("n_dark_gaps"),
        # avg over no gaps is null, as avg(gap_hours) over none
        F.when(n_gaps > 0, F.sum("sum_gap_hours").cast("double") / n_gaps).alias("avg_gap_hours"),
        F.max("max_gap_hours").alias("max_gap_hours"),
        F.max("max_dark_score").alias("_max_gscore"),
        F.sum("n_impossible_speed").alias("n_impossible_speed"),
        F.max("max_implied_speed").alias("max_implied_speed"),
        F.max("max_jump_nm").alias("max_jump_nm"),
        F.max("max_speed_score").alias("_max_jscore"))
    return _finish(prof, sanctions, broadcast_rows)


def _finish(prof: DataFrame, sanctions: DataFrame, broadcast_rows: int) -> DataFrame:
    # vessels with only implausible jumps are not "anomalous vessels"
    prof = (prof.where((F.col("n_dark_gaps") > 0) | (F.col("n_impossible_speed") > 0))
                .where(valid_mmsi(F.col("mmsi"))))
    s = maybe_broadcast(sanctions_by_mmsi(sanctions), broadcast_rows)
    out = prof.join(s, "mmsi", "left")
    agrees = F.array_contains(F.col("_names"), normalise_name(F.col("vessel_name")))
    return out.select(
        "mmsi", "vessel_name",
        "n_dark_gaps",
        F.coalesce("avg_gap_hours", F.lit(0.0)).alias("avg_gap_hours"),
        F.coalesce("max_gap_hours", F.lit(0).cast("long")).alias("max_gap_hours"),
        "n_impossible_speed",
        F.coalesce("max_implied_speed", F.lit(0.0)).alias("max_implied_speed"),
        F.coalesce("max_jump_nm", F.lit(0.0)).alias("max_jump_nm"),
        (F.col("n_dark_gaps") + F.col("n_impossible_speed")).alias("total_anomalies"),
        F.greatest(F.coalesce("_max_gscore", F.lit(0.0)), F.coalesce("_max_jscore", F.lit(0.0))).alias("max_anomaly_score"),
        F.when(F.col("_names").isNotNull() & F.coalesce(agrees, F.lit(False)), 1).otherwise(0).alias("is_sanctioned"),
        F.when(F.col("_names").isNotNull(), 1).otherwise(0).alias("sanctions_mmsi_only_hit"),
    ).select(*FEATURE_COLUMNS)
