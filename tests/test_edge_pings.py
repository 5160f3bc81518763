"""Hand-written edge pings with expected events (FIXTURES §3)."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from vesseltrack.operators.clean import clean
from vesseltrack.operators.detect import dark_gaps, impossible_speed
from vesseltrack.operators.timeline import timeline, timeline_plain
from vesseltrack.schemas import AIS_SCHEMA

ROWS = [  # mmsi, ts, lat, lon, sog, seq, name
    ("211000001", "2024-01-01 00:00:00", 40, -70, 1, 1, "ALPHA"),
    ("211000001", "2024-01-01 06:00:00", 40, -70, 1, 1, "ALPHA"),
    ("211000001", "2024-01-01 11:59:59", 40, -70, 1, 1, "ALPHA"),
    ("211000002", "2024-01-01 00:00:00", 40, -70, 1, 1, "BRAVO"),
    ("211000002", "2024-01-02 00:00:00", 40, -70, None, 1, "BRAVO"),
    ("211000003", "2024-01-01 00:00:00", 40, -70, 1, 1, "CHARLIE"),
    ("211000003", "2024-01-01 00:00:00", 91, -70, 1, 2, "CHARLIE"),
    ("211000003", "2024-01-01 08:00:00", 40, -70, 1, 1, "CHARLIE"),
    ("211000004", "2024-01-01 00:00:00", 40, -70, 1, 1, "DELTA-1"),
    ("211000004", "2024-01-01 00:00:01", 41, -70, 1, 1, "DELTA-1"),
    ("211000005", "2024-01-01 00:00:00", 0, 179.9, 1, 1, "ECHO"),
    ("211000005", "2024-01-01 00:10:00", 0, -179.9, 1, 1, "ECHO"),
    ("991000006", "2024-01-01 00:00:00", 10, 10, 1, 1, "BUOY"),
    ("991000006", "2024-01-01 09:00:00", 10, 10, 102.2, 1, "BUOY"),
    ("211000007", "2024-01-07 22:00:00", 30, -80, 1, 1, "GOLF"),
    ("211000007", "2024-01-08 05:00:00", 30, -80, 1, 1, "GOLF"),
    ("211000008", "2024-01-01 00:00:00", None, -80, 1, 1, "HOTEL"),
    ("211000008", "2024-01-01 07:00:00", 30, -80, 102.3, 1, "HOTEL"),
    ("211000008", "2024-01-01 10:00:00", 30, -80, 3, 1, "HOTEL"),
]


@pytest.fixture(scope="module")
def raw(spark):
    data = []
    for mmsi, ts, lat, lon, sog, seq, name in ROWS:
        data.append((mmsi, datetime.fromisoformat(ts), float(lon), None if lat is None else float(lat),
                     None if sog is None else float(sog), name, datetime(2024, 2, seq), "f.csv"))
    df = spark.createDataFrame(
        data, "mmsi string, base_date_time timestamp, longitude double, latitude double, sog double, "
              "vessel_name string, _ingestion_ts timestamp, _source_file string")
    cols = [F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in AIS_SCHEMA.fields]
    return df.select(*cols, "_ingestion_ts", "_source_file")


def test_clean_counts(raw):
    assert raw.count() == 19
    assert clean(raw).count() == 16
    # newest copy invalid -> the older valid copy is gone too
    assert clean(raw).where("mmsi = '211000003'").count() == 1


def test_dark_gaps(raw):
    got = {(r["mmsi"], r["gap_hours"], r["anomaly_score"], r["last_known_lat"])
           for r in dark_gaps(timeline(clean(raw))).collect()}
    assert got == {
        ("211000001", 6, Decimal("0.250000"), 40.0),
        ("211000002", 24, Decimal("1.000000"), 40.0),
        ("211000007", 7, Decimal("0.291667"), 30.0),
        ("211000008", 10, Decimal("0.416667"), None),
        ("991000006", 9, Decimal("0.375000"), 10.0),
    }


def test_dark_gap_schema(raw):
    d = dict(dark_gaps(timeline(clean(raw))).dtypes)
    assert d["anomaly_score"] == "decimal(27,6)" and d["gap_hours"] == "bigint"


def test_impossible_speed(raw):
    got = {r["mmsi"]: (round(r["distance_nm"], 6), round(r["implied_speed_knots"], 6), round(r["anomaly_score"], 6))
           for r in impossible_speed(timeline(clean(raw))).collect()}
    assert got == {
        "211000004": (60.040461, 215972.880333, 1.0),
        "211000005": (12.008092, 72.048409, 0.600692),
    }


def test_window_gap_uses_lookback(raw):
    w = ("2024-01-08", "2024-01-14")
    got = [r["mmsi"] for r in dark_gaps(timeline(clean(raw), w), w).collect()]
    assert got == ["211000007"]


@pytest.mark.parametrize("bucket", [1, 60, 3600, 86400 * 7])
def test_split_timeline_equals_plain(raw, bucket):
    c = clean(raw)
    a = timeline(c, bucket_seconds=bucket)
    b = timeline_plain(c)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
