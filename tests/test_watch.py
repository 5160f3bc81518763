"""Streaming detection: parity with the batch detectors in any order, restarts, alerts, state."""

import glob
import os
import random
from datetime import datetime, timedelta

import pytest

from vesseltrack.operators.clean import clean
from vesseltrack.operators.timeline import timeline
from vesseltrack.schemas import AIS_SCHEMA
from vesseltrack.streaming.watch import DETECTORS, live_events, watch

START = datetime(2024, 1, 1)
SCHEMA = AIS_SCHEMA.simpleString()[7:-1].replace(":", " ").replace(",", ", ") + ", _ingestion_ts timestamp, _source_file string"


def ping(mmsi, minutes, lat=10.0, lon=20.0, copy=0, sog=5.0):
    return (mmsi, None if minutes is None else START + timedelta(minutes=minutes), lon, lat, sog, None, None, f"V{mmsi}", None, None, 80, 0,
            100, 10, 5.0, 80, "A", START + timedelta(days=copy), f"f{copy}")


def pings(seed):
    rng, rows = random.Random(seed), []
    for mmsi in ("200000001", "300000002", None, "hot"):
        at = 0
        for _ in range(80 if mmsi == "hot" else 25):
            at += rng.choice((1, 20, 45)) if mmsi == "hot" else rng.choice((0, 5, 59, 200, 360, 400, 2000))
            rows.append(ping(mmsi, at, rng.choice((10.0, 10.5, 60.0, None, 95.0)), rng.choice((20.0, 21.0))))
            if rng.random() < 0.3:  # another copy of the ping, perhaps invalid
                rows.append(ping(mmsi, at, rng.choice((11.0, 95.0, None)), 20.0, copy=rng.choice((0, 1)), sog=rng.choice((5.0, 200.0, None))))
    rows.append(ping("200000001", None))
    return rows


def write(spark, rows, folder):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def run(spark, tmp, files=2, **options):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files).parquet(f"{tmp}/in")
    options.setdefault("lateness", "400 days")
    q = watch(stream, f"{tmp}/out", checkpoint=f"{tmp}/check", **options)
    q.awaitTermination(300)
    assert q.exception() is None
    return q


def same_as_batch(spark, rows, out):
    steps = timeline(clean(spark.createDataFrame(rows, SCHEMA)))
    for name, detect in DETECTORS.items():
        got = sorted(map(repr, live_events(spark, out, name).collect()))
        assert got == sorted(map(repr, detect(steps).collect())), name
        assert len(got) > 3


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_gives_the_batch_events(spark, tmp_path, seed):
    rows = pings(seed)
    mixed = random.Random(seed).sample(rows, len(rows))
    for k in range(5):
        write(spark, mixed[k::5], tmp_path / "in")
    run(spark, tmp_path)
    same_as_batch(spark, rows, f"{tmp_path}/out")
    withdrawn = spark.read.parquet(f"{tmp_path}/out/dark_gaps").where("change = -1").count()
    assert withdrawn > 0  # late pings did break earlier gaps


def test_restart_and_repeated_batch_leave_no_doubles(spark, tmp_path):
    rows = pings(3)
    half = len(rows) // 2
    write(spark, rows[half:], tmp_path / "in")
    run(spark, tmp_path)
    write(spark, rows[:half], tmp_path / "in")
    run(spark, tmp_path)  # goes on from the stored state
    same_as_batch(spark, rows, f"{tmp_path}/out")
    # a crash after the last batch was written but before it was committed: it runs again
    last = max((p for p in os.listdir(tmp_path / "check/commits") if p.isdigit()), key=int)
    for f in glob.glob(f"{tmp_path}/check/commits/*{last}*") + glob.glob(f"{tmp_path}/check/commits/.{last}*"):
        os.remove(f)
    run(spark, tmp_path)
    same_as_batch(spark, rows, f"{tmp_path}/out")


def test_alert_when_a_gap_opens_and_state_is_cleared(spark, tmp_path):
    write(spark, [ping("200000001", 0), ping("300000002", 0)], tmp_path / "in")
    run(spark, tmp_path, lateness="10 minutes")
    # the second vessel goes on for a day, the first is silent: its timer fires
    for hour in (3, 6, 9, 24):
        write(spark, [ping("300000002", 60 * hour)], tmp_path / "in")
        run(spark, tmp_path, lateness="10 minutes")
    write(spark, [ping("300000002", 60 * 30), ping("200000001", 60 * 30)], tmp_path / "in")
    run(spark, tmp_path, lateness="10 minutes")
    alerts = spark.read.parquet(f"{tmp_path}/out/gap_open").collect()
    first = [a for a in alerts if a.mmsi == "200000001"]
    assert [a.last_seen for a in first] == [START] and first[0].at == START + timedelta(hours=6)
    assert len(alerts) == 1  # the other vessel's own ping moved the time on: its silence was over when it was seen
    gaps = live_events(spark, f"{tmp_path}/out", "dark_gaps").collect()
    assert {(g.mmsi, g.gap_hours) for g in gaps} == {("200000001", 30), ("300000002", 15), ("300000002", 6)}
    slots = spark.read.format("statestore").option("stateVarName", "pings").option("operatorId", 1).load(f"{tmp_path}/check").count()
    assert slots <= 3  # the slots below the watermark are gone


def test_late_copy_that_is_invalid_removes_the_ping(spark, tmp_path):
    rows = [ping("200000001", 0), ping("200000001", 600), ping("200000001", 1200)]
    write(spark, rows, tmp_path / "in")
    run(spark, tmp_path)
    assert live_events(spark, f"{tmp_path}/out", "dark_gaps").count() == 2
    newer = [ping("200000001", 600, lat=95.0, copy=1)]
    write(spark, newer, tmp_path / "in")
    run(spark, tmp_path)
    got = live_events(spark, f"{tmp_path}/out", "dark_gaps").collect()
    assert [(g.gap_hours, g.gap_end) for g in got] == [(20, START + timedelta(minutes=1200))]


def test_state_has_a_key_for_many_vessels(spark, tmp_path):
    rows = [ping(str(200000000 + v), 400 * v % 1400 + 500 * k, rows_lat) for v in range(60) for k, rows_lat in enumerate((10.0, 10.5, 60.0))]
    for k in range(2):
        write(spark, rows[k::2], tmp_path / "in")
    run(spark, tmp_path, files=1, shards=2, groups=4)
    same_as_batch(spark, rows, f"{tmp_path}/out")
    state = spark.read.format("statestore").option("stateVarName", "edges").option("operatorId", 0)
    assert state.load(f"{tmp_path}/check").count() <= 4  # calls of the operators, which cost the time, are per key


def test_alerts_of_vessels_that_share_a_key(spark, tmp_path):
    for minute, vessels in ((0, "12"), (60, "3"), (1200, "4"), (1201, "4"), (2400, "4"), (2401, "4")):
        write(spark, [ping(f"20000000{v}", minute) for v in vessels], tmp_path / "in")
        run(spark, tmp_path, lateness="10 minutes", shards=1, groups=1)
    alerts = spark.read.parquet(f"{tmp_path}/out/gap_open").collect()
    assert {a.mmsi for a in alerts} >= {"200000001", "200000002", "200000003"}
    assert len([a for a in alerts if a.mmsi != "200000004"]) == 3  # each silence once
    assert {a.at - a.last_seen for a in alerts} == {timedelta(hours=6)}
