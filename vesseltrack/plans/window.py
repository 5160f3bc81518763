"""Processing-window control.

Two windows move through time: the ingest window (the days after the newest
loaded file) and the transform window (the days after the committed watermark,
never past the newest loaded day). Both are a handful of dates; the listing
they start from is a DataFrame, reduced to one row before anything reaches the
driver. The end of the schedule is open unless a caller sets one.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vesseltrack.functions.filenames import date_from_filename

# Fixed values of the original schedule: its first and last day, its window length.
SCHEDULE_START = date(2024, 1, 1)
SCHEDULE_END = date(2024, 12, 31)
WINDOW_DAYS = 7


@dataclass(frozen=True)
class ProcessingWindow:
    start: date
    end: date
    advance: bool = True  # commit the watermark after success

    def as_tuple(self) -> tuple[date, date]:
        return self.start, self.end

    def days(self) -> list[date]:
        return [self.start + timedelta(days=i) for i in range((self.end - self.start).days + 1)]


def _following(last: Column, window_days: int, end_date: date | None, default_start: date | None) -> tuple[Column, Column]:
    """Start and end columns of the window after a day; null where none is left."""
    start = F.coalesce(F.date_add(last, 1), F.lit(default_start).cast("date"))
    end = F.date_add(start, window_days - 1)
    if end_date is None:
        return start, end
    left = start <= F.lit(end_date)
    return F.when(left, start), F.when(left, F.least(end, F.lit(end_date)))


def next_window_frame(files: DataFrame, column: str = "_source_file", window_days: int = WINDOW_DAYS,
                      end_date: date | None = None, default_start: date | None = SCHEDULE_START) -> DataFrame:
    """One row (window_start, window_end) after the newest dated name, or no row when complete.

    Names that do not encode a date are ignored.
    """
    newest = files.select(F.max(date_from_filename(F.col(column))).alias("newest"))
    start, end = _following(F.col("newest"), window_days, end_date, default_start)
    return newest.select(start.alias("window_start"), end.alias("window_end")).where("window_start is not null")


def window_state_frame(state: DataFrame, window_days: int = WINDOW_DAYS, end_date: date | None = None,
                       default_start: date | None = SCHEDULE_START) -> DataFrame:
    """W3 over a state table (``last_end``): one row (window_start, window_end, advance)."""
    start, end = _following(F.max("last_end"), window_days, end_date, default_start)
    return state.select(start.alias("window_start"), end.alias("window_end"), start.isNotNull().alias("advance"))


def resolve_window(start: str | date | None = None, end: str | date | None = None, last_end: date | None = None,
                   window_days: int = WINDOW_DAYS, end_date: date | None = None, default_start: date | None = SCHEDULE_START,
                   newest: date | None = None) -> ProcessingWindow | None:
    """The window of the next transform run.

    An explicit start *and* end is used verbatim and never moves the
    watermark; only one of the two counts as none. Otherwise the window
    follows the committed ``last_end`` and ends with ``newest``, the newest
    loaded day, at the latest: days that have not landed are never passed over.
    None means nothing to do.
    """
    if start and end:
        return ProcessingWindow(_as_date(start), _as_date(end), advance=False)
    first = default_start if last_end is None else last_end + timedelta(days=1)
    if first is None:
        return None
    stop = min([first + timedelta(days=window_days - 1), *(d for d in (end_date, newest) if d is not None)])
    return ProcessingWindow(first, stop) if first <= stop else None


def window_mode(window: ProcessingWindow | None, table_exists: bool, full_refresh: bool = False) -> str:
    """What a model run does.

    'replace'  - replace the window's days in an existing table;
    'build'    - first build / full refresh restricted to the window;
    'full'     - first build / full refresh over all history;
    'noop'     - no window and an existing table: nothing to do.
    """
    if window is not None:
        return "replace" if table_exists and not full_refresh else "build"
    return "noop" if table_exists and not full_refresh else "full"


def _as_date(x) -> date:
    return x if isinstance(x, date) else date.fromisoformat(str(x).strip())
