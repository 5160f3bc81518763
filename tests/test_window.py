"""Window arithmetic over file listings and state tables."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from vesseltrack.functions.filenames import date_from_filename
from vesseltrack.plans.window import (
    SCHEDULE_END, SCHEDULE_START, ProcessingWindow, next_window_frame, resolve_window, window_mode, window_state_frame,
)


def day(name):
    """The day of a well-formed daily name, for short test data."""
    return f"ais-{name}.csv.zst"


@pytest.mark.parametrize("name,found", [
    (day("2024-02-29"), date(2024, 2, 29)),      # leap day
    (day("2023-02-29"), None),                   # no such day
    (day("2025-04-30"), date(2025, 4, 30)),
    (day("2025-04-31"), None),
    (day("1999-12-31"), date(1999, 12, 31)),
    (day("2024-13-01"), None),
    (day("24-01-01"), None),                     # short year
    ("ais-20240101.csv.zst", None),              # no separators
    ("AIS_2024_06_07_extra.csv", date(2024, 6, 7)),  # the rule looks at positions only
    ("ais-२०२४-०१-०१.csv", None),                 # digits of another script
    ("positions.csv", None),
    (None, None),
])
def test_dates_of_names(spark, name, found):
    got = spark.createDataFrame([(name,)], "f string").select(date_from_filename(F.col("f"))).first()[0]
    assert got == found


@pytest.mark.parametrize("names,kw,window", [
    ([], {}, (SCHEDULE_START, date(2024, 1, 7))),
    ([], {"default_start": date(2023, 11, 28), "window_days": 5}, (date(2023, 11, 28), date(2023, 12, 2))),
    ([], {"default_start": None}, None),
    ([day("2024-02-26"), day("2024-02-27")], {"window_days": 3}, (date(2024, 2, 28), date(2024, 3, 1))),   # over the leap day
    ([day("2024-06-01"), day("2024-06-20")], {}, (date(2024, 6, 21), date(2024, 6, 27))),                 # a gap in the listing
    ([day("2024-12-30")], {}, (date(2024, 12, 31), date(2025, 1, 6))),                                    # over the year's end
    ([day("2024-12-30")], {"end_date": SCHEDULE_END}, (date(2024, 12, 31), date(2024, 12, 31))),
    ([day("2025-03-09")], {"end_date": SCHEDULE_END}, None),
    ([day("2025-03-09")], {}, (date(2025, 3, 10), date(2025, 3, 16))),                                    # no end by default
    (["junk", day("2024-05-32"), day("2024-05-05"), "x" + day("2024-09-09")], {}, (date(2024, 5, 6), date(2024, 5, 12))),
])
def test_window_after_a_listing(spark, names, kw, window):
    files = spark.createDataFrame([(n,) for n in names], "_source_file string")
    row = next_window_frame(files, **kw).first()
    assert (None if row is None else tuple(row)) == window


@pytest.mark.parametrize("last,kw,row", [
    (None, {}, (SCHEDULE_START, date(2024, 1, 7), True)),
    (date(2024, 3, 31), {}, (date(2024, 4, 1), date(2024, 4, 7), True)),
    (date(2024, 12, 31), {}, (date(2025, 1, 1), date(2025, 1, 7), True)),
    (date(2024, 12, 31), {"end_date": SCHEDULE_END}, (None, None, False)),
    (date(2024, 12, 29), {"end_date": SCHEDULE_END}, (date(2024, 12, 30), date(2024, 12, 31), True)),
])
def test_window_after_a_state(spark, last, kw, row):
    state = spark.createDataFrame([(last,)] if last else [], "last_end date")
    assert tuple(window_state_frame(state, **kw).first()) == row


def test_next_transform_window():
    assert resolve_window(last_end=date(2024, 2, 24)) == ProcessingWindow(date(2024, 2, 25), date(2024, 3, 2))
    # never past the newest loaded day, nor past a set end
    assert resolve_window(last_end=date(2024, 2, 24), newest=date(2024, 2, 25)) == ProcessingWindow(date(2024, 2, 25), date(2024, 2, 25))
    assert resolve_window(last_end=date(2024, 2, 24), newest=date(2024, 2, 24)) is None
    assert resolve_window(last_end=date(2024, 12, 31), end_date=SCHEDULE_END) is None
    assert resolve_window(default_start=None) is None


def test_override_needs_both_ends_and_keeps_the_watermark():
    w = resolve_window("2024-05-01", " 2024-05-03", last_end=date(2024, 12, 31), end_date=SCHEDULE_END)
    assert w == ProcessingWindow(date(2024, 5, 1), date(2024, 5, 3), advance=False) and len(w.days()) == 3
    assert resolve_window(start="2024-05-01", last_end=date(2024, 1, 7)).start == date(2024, 1, 8)
    assert resolve_window(end="2024-05-03", last_end=date(2024, 1, 7)).start == date(2024, 1, 8)


def test_modes():
    w = ProcessingWindow(date(2024, 1, 1), date(2024, 1, 7))
    assert [window_mode(x, there, full) for x in (w, None) for there in (True, False) for full in (True, False)] == [
        "build", "replace", "build", "build", "full", "noop", "full", "full"]
