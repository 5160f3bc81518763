"""Outages, crowds, port calls, zones and checked codes against plain Python."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vesseltrack.operators import extensions as X
from vesseltrack.operators import runs as R
from vesseltrack.operators import situations as S

START = datetime(2024, 1, 1)


def at(hours):
    return START + timedelta(hours=hours)


def test_previous_and_running_sum_equal_a_walk(spark):
    rng = random.Random(1)
    rows = []
    for key in ("a", "b", None):
        hours = sorted(rng.sample(range(2000), 120)) if key == "a" else sorted(rng.sample(range(2000), 15))
        rows += [(key, at(h), rng.randrange(-3, 4), rng.choice((None, 1.5, 2.5))) for h in hours]
    df = spark.createDataFrame(rows, "k string, t timestamp, v int, x double")
    want, last, total = {}, {}, {}
    for k, t, v, x in rows:
        total[k] = total.get(k, 0) + v
        want[k, t] = (last.get(k), total[k])
        last[k] = (t, x)
    for seconds in (3600, 86_400, 10 ** 9):
        got = R.with_running_sum(R.with_previous(df, ["k"], "t", ["t", "x"], seconds), ["k"], "t", "v", "total", seconds).collect()
        assert {(r.k, r.t): (tuple(r.prev) if r.prev else None, r.total) for r in got} == want


def gap(mmsi, begin, end, lat=10.5, lon=20.5):
    return (mmsi, at(begin), at(end), lat, lon)


GAPS = "mmsi string, gap_start timestamp, gap_end timestamp, last_known_lat double, last_known_lon double"


def test_outage_over_hour_and_day_borders_is_one(spark):
    rows = [gap("a", 23.9, 60), gap("b", 24.1, 50), gap("c", 49, 100), gap("d", 100, 120), gap("e", 110, 130, lat=12.5), gap("f", 1, 8, lat=None)]
    got = S.outages(spark.createDataFrame(rows, GAPS)).collect()
    assert [(r.cell_lat, r.cell_lon, r.began, r.ended, r.peak) for r in got] == [(10, 20, at(24.1), at(60), 3)]
    assert S.outages(spark.createDataFrame(rows, GAPS).limit(0)).count() == 0


def test_outages_equal_a_sweep(spark):
    rng = random.Random(4)
    rows = [gap(str(i), b := rng.randrange(300), b + rng.randrange(1, 40), lat=rng.choice((0.5, 1.5)), lon=rng.choice((-0.5, 0.5, None))) for i in range(150)]
    for least in (1, 2, 5):
        want = set()
        for cell in {(math.floor(r[3]), math.floor(r[4])) for r in rows if r[4] is not None}:
            mine = [r for r in rows if r[4] is not None and (math.floor(r[3]), math.floor(r[4])) == cell]
            began, peak = None, 0
            for h in range(400):
                dark = sum(r[1] <= at(h) < r[2] for r in mine)
                if dark >= least:
                    began, peak = at(h) if began is None else began, max(peak, dark)
                elif began is not None:
                    want.add((*cell, began, at(h), peak))
                    began, peak = None, 0
        got = S.outages(spark.createDataFrame(rows, GAPS), min_vessels=least).collect()
        assert {(r.cell_lat, r.cell_lon, r.began, r.ended, r.peak) for r in got} == want and len(got) == len(want)


def nm(a, b):
    (p, q), (r, s) = a, b
    h = math.sin(math.radians(r - p) / 2) ** 2 + math.cos(math.radians(p)) * math.cos(math.radians(r)) * math.sin(math.radians(s - q) / 2) ** 2
    return 3440.065 * 2 * math.asin(math.sqrt(min(1.0, h)))


def plain_crowds(places, far, least):
    """{mmsi: (lat, lon)} to the set of groups as frozensets."""
    left, groups = set(places), set()
    while left:
        group, work = set(), [left.pop()]
        while work:
            m = work.pop()
            group.add(m)
            near = {x for x in left if nm(places[m], places[x]) <= far}
            left -= near
            work += near
        if len(group) >= least:
            groups.add(frozenset(group))
    return groups


@pytest.mark.parametrize("center", [(10.0, 20.0), (0.0, 179.99), (89.6, 0.0), (-89.9, 100.0), (60.0, -180.0)])
def test_crowds_are_connected_groups_whatever_the_grid(spark, center):
    rng = random.Random(str(center))
    spread = 0.12 / max(0.02, math.cos(math.radians(center[0])))
    places = {}
    for i in range(60):
        lat = max(-90.0, min(90.0, center[0] + rng.uniform(-0.12, 0.12)))
        lon = (center[1] + rng.uniform(-spread, spread) + 180) % 360 - 180
        places[f"{i:03d}"] = (lat, lon)
    for i in range(60, 66):
        places[f"{i:03d}"] = places["000"]  # at the very same place
    rows = [(m, at(0.2), lat, lon) for m, (lat, lon) in places.items()] + [(m, at(0.1), 1.0, 1.0) for m in places]
    rows += [(None, at(0.2), *center), ("x", None, *center), ("y", at(0.2), None, 1.0), ("z", at(5), *center)]
    silver = spark.createDataFrame(rows, "mmsi string, base_date_time timestamp, latitude double, longitude double")
    want = {(min(g), len(g)) for g in plain_crowds(places, 1.0, 3)}
    assert want
    for origin in (0.0, 0.0071, 1.3):
        got = S.crowds(silver, nm=1.0, unit="hour", min_vessels=3, origin=origin).collect()
        assert {(r.first_mmsi, r.vessels) for r in got} == want


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    got = {r.node: r.part for r in S.components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


PINGS = "mmsi string, base_date_time timestamp, latitude double, longitude double, sog double, draft double, event_date date"


def pings(rows):
    return [(m, at(h), lat, lon, sog, draft, at(h).date()) for m, h, lat, lon, sog, draft in rows]


def test_port_calls_over_midnight_and_between_days(spark):
    rows = [("a", h, 10.0, 20.0, 0.1, None if h < 22 else 9.0) for h in range(20, 30)]  # a stay over midnight
    rows += [("a", h, 10.0 + (h - 30) * 0.2, 20.0, 12.0, 9.0) for h in range(31, 60)]
    rows += [("a", h, 16.0, 20.0, 0.2, 5.0) for h in range(60, 90, 2)]
    rows += [("a", 92, 16.2, 20.0, 0.2, 7.0), ("a", 93, 16.2, 20.0, 0.2, 7.0)]  # moved 12 miles: another place, too short
    rows += [("a", 94.5, 16.2, 20.0, 0.0, 4.0)]
    rows += [("b", 5, 1.0, 1.0, 0.0, 3.0), ("b", 6, 1.0, 1.0, None, 3.0), ("b", 9, 1.0, 1.0, 0.0, 3.0)]  # unknown speed ends a stay
    silver = spark.createDataFrame(pings(rows), PINGS)
    calls = [(r.mmsi, r.arrived, r.left, r.pings, r.draft_in, r.draft_out) for r in S.port_calls(silver).orderBy("mmsi", "arrived").collect()]
    assert calls == [("a", at(20), at(29), 10, 9.0, 9.0), ("a", at(60), at(88), 15, 5.0, 5.0), ("a", at(92), at(94.5), 3, 7.0, 4.0)]
    pairs = [(r.left, r.arrived, r.change) for r in S.draught_between_calls(silver).orderBy("arrived").collect()]
    assert pairs == [(at(29), at(60), -4.0), (at(88), at(92), 2.0)]


def test_zones_sum_to_the_level_above_and_have_equal_areas(spark):
    rng = random.Random(3)
    gaps = spark.createDataFrame([(rng.uniform(-90, 90), rng.uniform(-180, 180), rng.randrange(6, 50)) for _ in range(300)] + [(90.0, 180.0, 7), (None, 1.0, 9)],
                                 "last_known_lat double, last_known_lon double, gap_hours long")
    jumps = spark.createDataFrame([(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(100)], "from_lat double, from_lon double")
    got = S.zones(gaps, jumps, 5).collect()
    by_level = {k: {(r.row, r.column): (r.dark_gaps, r.dark_hours, r.impossible_speeds) for r in got if r.level == k} for k in range(6)}
    assert by_level[0] == {(0, 0): (301, sum(r.gap_hours for r in gaps.where("last_known_lat is not null").collect()), 100)}
    for k in range(1, 6):
        up = {}
        for (row, column), v in by_level[k].items():
            assert 0 <= row < 2 ** k and 0 <= column < 2 ** k
            key = (row // 2, column // 2)
            up[key] = tuple(a + b for a, b in zip(up.get(key, (0, 0, 0)), v))
        assert up == by_level[k - 1]
    # points spread evenly over the sphere fall evenly into the cells
    even = spark.range(20_000).selectExpr("degrees(asin(rand(1) * 2 - 1)) as from_lat", "rand(2) * 360 - 180 as from_lon")
    counts = [r.impossible_speeds for r in S.zones(gaps.limit(0), even, 3).where("level = 3").collect()]
    assert len(counts) == 64 and sum((c - 312.5) ** 2 / 312.5 for c in counts) < 110


def test_imo_numbers(spark):
    rows = [("IMO9738246", "9738246"), (" imo 9074729 ", "9074729"), ("9074729", "9074729"), ("IMO9074720", None), ("IMO0000000", None),
            ("IMO907472", None), ("IMO90747290", None), ("", None), (None, None), ("IMO90747X9", None)]
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(rows)], "mmsi long, imo string")
    got = {r.mmsi: r.n for r in df.select("mmsi", X.imo_number(F.col("imo")).alias("n")).collect()}
    assert got == {i: w for i, (_, w) in enumerate(rows)}
    check = {r.mmsi: (r.without_imo, r.false_imo, r.numbers_used) for r in X.identity_check(df.withColumn("mmsi", F.col("mmsi").cast("string"))).collect()}
    assert check["3"] == (0, 1, 0) and check["4"] == (1, 0, 0) and check["8"] == (1, 0, 0) and "0" not in check
    listed = spark.createDataFrame([("E1", "N", "IMO9738246"), ("E2", "M", "9074720")], "entity_id string, entity_name string, imo_number string")
    hits = X.sanctions_by_checked_imo(df, listed).collect()
    assert [(r.mmsi, r.entity_id) for r in hits] == [(0, "E1")]  # the false number on both sides joins nothing


def test_cargo_codes_with_one_tens_digit_can_conflict(spark):
    rows = [(80, 80, None), (80, 84, None), (81, 82, "other hazard"), (81, 81, None), (89, 81, None), (31, 30, "other kind"), (37, 37, None),
            (70, 80, "other kind"), (80, 199, "unknown code"), (5, 80, "unknown code"), (None, 80, None), (80, None, None)]
    silver = spark.createDataFrame([(str(i), START, a, b) for i, (a, b, _) in enumerate(rows)], "mmsi string, base_date_time timestamp, vessel_type int, cargo int")
    got = {int(r.mmsi): r.verdict for r in X.cargo_conflicts(silver).collect()}
    assert got == {i: v for i, (_, _, v) in enumerate(rows) if v}
