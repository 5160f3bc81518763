"""Sanctions edge rows, clean idempotence (P4), empty windows, scoring summary."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vesseltrack.operators.clean import clean
from vesseltrack.operators.cues import anomaly_cues
from vesseltrack.operators.detect import dark_gaps, impossible_speed
from vesseltrack.operators.features import vessel_features
from vesseltrack.operators.report import scoring_summary
from vesseltrack.operators.timeline import timeline
from vesseltrack.schemas import (
    AIS_SCHEMA, CLEAN_COLUMNS, CUE_COLUMNS, DARK_GAP_COLUMNS, FEATURE_COLUMNS, IMPOSSIBLE_SPEED_COLUMNS,
    SANCTIONS_COLUMNS,
)
from vesseltrack.sources.fixtures import ais_raw_from_events


def _raw(spark, rows):
    df = spark.createDataFrame(
        [(m, datetime.fromisoformat(t), lon, lat, 1.0, n, datetime(2024, 2, 1), "f.csv") for m, t, lat, lon, n in rows],
        "mmsi string, base_date_time timestamp, longitude double, latitude double, sog double, vessel_name string, "
        "_ingestion_ts timestamp, _source_file string")
    cols = [F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in AIS_SCHEMA.fields]
    return df.select(*cols, "_ingestion_ts", "_source_file")


@pytest.fixture(scope="module")
def gold(spark):
    rows = []
    for m, name in [("211000004", "DELTA-1"), ("211000010", "KILO"), ("211000011", "ЛЕНА"),
                    ("211000012", "MIKE"), ("211000013", None)]:
        rows += [(m, "2024-01-01 00:00:00", 40.0, -70.0, name), (m, "2024-01-01 07:00:00", 40.0, -70.0, name)]
    tl = timeline(clean(_raw(spark, rows)))
    sanctions = spark.createDataFrame([
        ("e1", "delta 1", "211000004"),      # case/punctuation only -> confirmed
        ("e2", "OTHER", "211000010"),        # other name -> MMSI-only hit
        ("e3", "ОЛЬГА", "211000011"),        # no Latin alphanumerics on both sides -> '' = '' -> match
        ("e4", "MIKE", None),                # null mmsi -> never joins
        ("e5", "MIKE A", "211000012"),       # two entities on one mmsi -> cue fan-out of 2
        ("e6", "MIKE B", "211000012"),
        ("e7", "ANY", "211000013"),          # null vessel name -> never confirmed
    ], "entity_id string, entity_name string, mmsi string").select(
        "entity_id", "entity_name", "mmsi", *[F.lit(None).cast("string").alias(c) for c in SANCTIONS_COLUMNS[3:]])
    return dark_gaps(tl), impossible_speed(tl), sanctions


def test_sanctions_edges(gold):
    g, j, s = gold
    f = {r["mmsi"]: (r["is_sanctioned"], r["sanctions_mmsi_only_hit"]) for r in vessel_features(g, j, s).collect()}
    assert f == {"211000004": (1, 1), "211000010": (0, 1), "211000011": (1, 1), "211000012": (0, 1),
                 "211000013": (0, 1)}


def test_cue_fanout(gold):
    g, j, s = gold
    cues = anomaly_cues(g, j, s)
    per = {r["mmsi"]: r["count"] for r in cues.groupBy("mmsi").count().collect()}
    assert per["211000012"] == 2 and per["211000004"] == 1
    assert cues.where("mmsi = '211000012'").select("sanctions_match").distinct().count() == 2


def test_clean_is_idempotent(spark):
    once = clean(ais_raw_from_events(spark, SF_SMALL))
    twice = clean(once.select(*CLEAN_COLUMNS[:-2]))
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0  # P4


def test_empty_window_has_schemas(spark):
    w = ("2023-01-01", "2023-01-07")
    c = clean(ais_raw_from_events(spark, SF_SMALL), w)
    assert c.count() == 0 and c.columns == CLEAN_COLUMNS
    g = dark_gaps(timeline(c, w), w)
    j = impossible_speed(timeline(c, w), w)
    assert g.count() == 0 and g.columns == DARK_GAP_COLUMNS
    assert j.count() == 0 and j.columns == IMPOSSIBLE_SPEED_COLUMNS
    s = spark.createDataFrame([], ", ".join(f"{x} string" for x in SANCTIONS_COLUMNS))
    assert anomaly_cues(g, j, s, w).columns == CUE_COLUMNS
    assert vessel_features(g, j, s).columns == FEATURE_COLUMNS


def test_scoring_summary(spark):
    df = spark.createDataFrame([(True,), (False,), (False,), (False,)], "is_outlier boolean")
    r = scoring_summary(df).first()
    assert (r["vessels"], r["flagged"], r["flagged_share"]) == (4, 1, 0.25)
