"""End-to-end jobs (D1, D2, D10, M8, R1): ingest, one transform window, scoring, alert rows.

Every stage is a lazy DataFrame; the only driver-side values are window dates,
a handful of file names of one ingest window, and small fitted models.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vesseltrack.functions.filenames import date_from_filename
from vesseltrack.operators.clean import clean
from vesseltrack.operators.cues import anomaly_cues
from vesseltrack.operators.detect import dark_gaps, impossible_speed
from vesseltrack.operators.features import features_from_partials, vessel_day_partials
from vesseltrack.operators.iforest import risk_scores
from vesseltrack.operators.report import watchlist
from vesseltrack.operators.timeline import daily_last_ping, timeline
from vesseltrack.plans import bronze, store
from vesseltrack.plans.window import WINDOW_DAYS, ProcessingWindow, next_window_frame, resolve_window, window_mode
from vesseltrack.session import Scratch, ensure_checkpoint_dir, materialize, pin_utc
from vesseltrack.sources.ais import read_ais, with_lineage
from vesseltrack.sources.catalog import ingested_files, read_watermark
from vesseltrack.sources.sanctions import read_sanctions


@dataclass(frozen=True)
class Tables:
    """Table names of one deployment (``sandbox`` prefixes every database)."""
    sandbox: str | None = None
    names: dict = field(default_factory=lambda: {
        "ais_raw": ("bronze", "ais_raw"),
        "files": ("bronze", "ais_files"),
        "sanctions": ("bronze", "sanctions"),
        "ais_clean": ("silver", "ais_clean"),
        "last_ping": ("silver", "ais_last_ping_daily"),
        "window_state": ("silver", "window_state"),
        "days_built": ("silver", "days_built"),
        "dark_gaps": ("gold", "ais_dark_gaps"),
        "impossible_speed": ("gold", "ais_impossible_speed"),
        "anomaly_cues": ("gold", "ais_anomaly_cues"),
        "vessel_day": ("gold", "vessel_day_partials"),
        "vessel_features": ("gold", "vessel_features"),
        "risk_scores": ("gold", "vessel_risk_scores"),
    })

    def __getitem__(self, key: str) -> str:
        layer, name = self.names[key]
        return store.table_name(layer, name, self.sandbox)


# ------------------------------------------------------------------ ingest


def list_landed(spark: SparkSession, landing_dir: str, pattern: str = "*.csv.zst") -> DataFrame:
    """Files in the landing folder as (path, file, file_date); contents are not read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(landing_dir)
                  .select("path"))
    name = F.regexp_extract(F.col("path"), r"([^/]+)$", 1)
    return files.select("path", name.alias("file"), date_from_filename(name).alias("file_date"))


def ingest_ais(spark: SparkSession, landing_dir: str, tables: Tables = Tables(),
               window_days: int = WINDOW_DAYS, end_date: date | None = None,
               default_start: date | None = None, pattern: str = "*.csv.zst",
               per_file: dict | None = None, skipped: dict | None = None, spread: int = 8) -> int:
    """Load the next batch of landed daily files into bronze; returns rows written.

    Pending files are the landed ones not in the load log (anti-join of the
    listing, J5). The batch is the pending files up to the end of the next
    ingest window (W2: the days after the newest loaded file), so a file that
    landed late for an earlier day is picked up too. When nothing is pending
    inside that window but later files have landed (missing days), the batch
    moves to the window starting at the earliest pending day instead of
    waiting forever. Re-loading a file replaces its rows (K2). Pass a dict as
    ``per_file`` for per-file row counts (K9), and one as ``skipped`` to learn
    how many landed files are never loaded: ``undated`` names, and days after
    ``end_date`` where a caller sets one.
    """
    pin_utc(spark)
    done = ingested_files(spark, tables["files"])
    landed = list_landed(spark, landing_dir, pattern).join(done.withColumnRenamed("_source_file", "file"), "file", "left_anti")
    late = F.col("file_date") > F.lit(end_date) if end_date else F.lit(False)
    pending = landed.where(F.col("file_date").isNotNull() & ~late)
    win = next_window_frame(done, "_source_file", window_days, end_date, default_start).first()
    bound = F.lit(win["window_end"] if win is not None else None).cast("date")
    # one row: how many pending files fall in the window, the earliest pending day, what is left out
    probe = landed.agg(
        F.count_if((F.col("file_date") <= bound) & ~late).alias("in_window"),
        F.min(F.when(~late, F.col("file_date"))).alias("earliest"),
        F.count_if(F.col("file_date").isNull()).alias("undated"), F.count_if(late).alias("after_end")).first()
    if skipped is not None:
        skipped.update(undated=probe["undated"], after_end=probe["after_end"])
    if probe["earliest"] is None:
        return 0
    stop = win["window_end"] if probe["in_window"] else probe["earliest"] + timedelta(days=window_days - 1)
    # at most the files of one window (plus late ones) reach the driver
    picks = [(r["path"], r["file"]) for r in pending.where(F.col("file_date") <= F.lit(stop)).orderBy("file").collect()]
    rows = with_lineage(read_ais(spark, [p for p, _ in picks], spread=spread))
    return bronze.load_files(spark, rows, [f for _, f in picks], tables["ais_raw"], tables["files"], per_file)


def ingest_sanctions(spark: SparkSession, path: str, tables: Tables = Tables()) -> int:
    """Snapshot-overwrite the sanctions table from an entity NDJSON file."""
    df = with_lineage(read_sanctions(spark, path))
    return store.overwrite_table(spark, df, tables["sanctions"])


# ------------------------------------------------------------- transform


def run_window(spark: SparkSession, start=None, end=None, tables: Tables = Tables(),
               full_refresh: bool = False, bucket_seconds: int | None = None,
               window_days: int = WINDOW_DAYS, end_date: date | None = None,
               default_start: date | None = None, fail_before_commit=None) -> ProcessingWindow | None:
    """One transform window through silver and gold, then the watermark.

    Window resolution (W3/W4/W6): explicit start+end replace that window and
    leave the watermark. Otherwise *dirty* days come first: days up to the
    watermark whose files were loaded (late, or again) after the day was built;
    a window of them is rebuilt, with the later days on which one of its
    vessels is seen next, and the watermark stays. When none is left, the
    window after the watermark follows, ending with the newest loaded day at
    the latest, so the watermark never passes days that have not landed. With
    ``full_refresh`` and no window, everything is rebuilt from bronze. The
    watermark and the built days are written only after every table of the
    window (W5), so a failure anywhere makes the next run redo the same window.

    Reprocessing a past window explicitly can make the first event of each
    vessel after it stale; use :func:`reprocess` with ``cascade=True``.
    """
    pin_utc(spark)
    ensure_checkpoint_dir(spark)
    loads = bronze.last_load(spark, tables["files"])  # loads after this one make their days dirty again
    first, newest = bronze.file_days(spark, tables["files"])
    last = read_watermark(spark, tables["window_state"])
    follow = []
    if full_refresh and not (start and end):
        win = None
    elif not (start and end) and last is not None and (win := _dirty_window(spark, tables, last, window_days)) is not None:
        follow = [win]
    else:
        win = resolve_window(start, end, last, window_days, end_date, default_start or first, newest)
        if win is None:
            return None
    mode = window_mode(win, spark.catalog.tableExists(tables["ais_clean"]), full_refresh)
    if mode == "noop":
        return None
    span = None if win is None else win.as_tuple()
    seen = _vessels_seen(spark, tables, span) if follow else None
    _build_silver(spark, tables, span, mode)
    _build_events(spark, tables, span, mode, bucket_seconds)
    if follow:
        for again in _next_days(spark, tables, span, seen):
            _build_events(spark, tables, again, "replace", bucket_seconds)
    # features: a rebuild from the partials table (one row per vessel-day) instead
    # of from every event of history
    features = features_from_partials(spark.table(tables["vessel_day"]), spark.table(tables["sanctions"]))
    store.overwrite_table(spark, features, tables["vessel_features"])
    if fail_before_commit is not None:  # test hook: a failure after the writes
        fail_before_commit()
    days = win.days() if win is not None else [r[0] for r in spark.table(tables["ais_clean"]).select("event_date").distinct().collect()]
    bronze.mark_built(spark, days, loads, tables["days_built"])
    if win is not None:
        store.commit_watermark(spark, tables["window_state"], win)
    return win


def _dirty_window(spark: SparkSession, tables: Tables, last: date, window_days: int) -> ProcessingWindow | None:
    """The earliest dirty days that fit in one window; None when there are none."""
    dirty = bronze.dirty_days(spark, tables["files"], tables["days_built"], last)
    start = dirty.agg(F.min("event_date")).first()[0]
    if start is None:
        return None
    stop = dirty.where(F.col("event_date") < F.lit(start + timedelta(days=window_days))).agg(F.max("event_date")).first()[0]
    return ProcessingWindow(start, stop, advance=False)


# Order of rows inside the files of a day; tables of pings and events by vessel, cues by falling score
SORTED_BY = {"ais_clean": ["mmsi", "base_date_time"], "anomaly_cues": ["-anomaly_score", "mmsi"]}


def _write(spark: SparkSession, tables: Tables, df: DataFrame, key: str, span, mode: str) -> None:
    cluster = SORTED_BY.get(key, ["mmsi"])
    if mode == "replace":
        store.replace_window(spark, df, tables[key], *span, cluster_by=cluster)
    else:  # first build or full refresh: the table becomes exactly this result
        store.overwrite_table(spark, df, tables[key], partition_by="event_date", cluster_by=cluster)


def _build_silver(spark: SparkSession, tables: Tables, span, mode: str) -> None:
    raw = spark.table(tables["ais_raw"])
    if span is not None and "_event_date" in raw.columns:  # a partition filter: the window's days only are read
        raw = raw.where(F.col("_event_date").between(*map(F.lit, span)))
    _write(spark, tables, clean(raw.drop("_event_date"), span), "ais_clean", span, mode)
    silver = spark.table(tables["ais_clean"])
    # the window's days of the vessel-day lookback table (read by later windows)
    if mode == "replace" and not spark.catalog.tableExists(tables["last_ping"]):
        # silver predates the lookback table: build it once from all of silver
        store.overwrite_table(spark, daily_last_ping(silver), tables["last_ping"], partition_by="event_date")
    else:
        window_silver = silver if span is None else silver.where(F.col("event_date").between(*span))
        _write(spark, tables, daily_last_ping(window_silver), "last_ping", span, mode)


def _build_events(spark: SparkSession, tables: Tables, span, mode: str, bucket_seconds: int | None) -> None:
    silver, sanctions = spark.table(tables["ais_clean"]), spark.table(tables["sanctions"])
    kw = {} if bucket_seconds is None else {"bucket_seconds": bucket_seconds}
    # one timeline feeds both detectors; a scratch table, so it is computed once
    # and its files are removed as soon as both detectors are written
    with Scratch(spark) as scratch:
        tl = scratch.keep(timeline(silver, span, lookback=spark.table(tables["last_ping"]), **kw), "timeline")
        _write(spark, tables, dark_gaps(tl, span), "dark_gaps", span, mode)
        _write(spark, tables, impossible_speed(tl, span), "impossible_speed", span, mode)
    gaps_t, jumps_t = spark.table(tables["dark_gaps"]), spark.table(tables["impossible_speed"])
    _write(spark, tables, anomaly_cues(gaps_t, jumps_t, sanctions, span), "anomaly_cues", span, mode)
    # per-(vessel, day) partials of this window
    if mode == "replace" and not spark.catalog.tableExists(tables["vessel_day"]):
        store.overwrite_table(spark, vessel_day_partials(gaps_t, jumps_t), tables["vessel_day"], partition_by="event_date")
    else:
        in_span = (lambda df: df) if span is None else (lambda df: df.where(F.col("event_date").between(*span)))
        _write(spark, tables, vessel_day_partials(in_span(gaps_t), in_span(jumps_t)), "vessel_day", span, mode)


def _vessels_seen(spark: SparkSession, tables: Tables, span) -> DataFrame:
    """Vessels of a window's days before they are rebuilt (written down: the table is about to change)."""
    last_ping = spark.table(tables["last_ping"])
    return materialize(last_ping.where(F.col("event_date").between(*span)).select("mmsi").distinct(), "vessels-seen")


def _next_days(spark: SparkSession, tables: Tables, span, seen: DataFrame) -> list[tuple[date, date]]:
    """Runs of later days on which a vessel of the window, before or after its rebuild, is seen next.

    The first event of such a vessel after the window starts from a ping that may have changed.
    """
    last_ping = spark.table(tables["last_ping"])
    vessels = last_ping.where(F.col("event_date").between(*span)).select("mmsi").union(seen).distinct()
    later = last_ping.where(F.col("event_date") > F.lit(span[1])).select("mmsi", "event_date")
    days = sorted(r[0] for r in later.join(vessels, "mmsi").groupBy("mmsi").agg(F.min("event_date").alias("d"))
                  .select("d").distinct().collect())  # days, not vessels
    runs: list[list[date]] = []
    for d in days:
        if runs and d - runs[-1][1] == timedelta(days=1):
            runs[-1][1] = d
        else:
            runs.append([d, d])
    return [tuple(r) for r in runs]


def reprocess(spark: SparkSession, start, end, tables: Tables = Tables(), cascade: bool = False,
              window_days: int = WINDOW_DAYS) -> list[ProcessingWindow]:
    """Rerun an explicit window; with ``cascade`` also every later window up to the watermark."""
    done = [run_window(spark, start, end, tables)]
    if cascade:
        last = read_watermark(spark, tables["window_state"])
        nxt = date.fromisoformat(str(end)) + timedelta(days=1)
        while last is not None and nxt <= last:
            stop = min(nxt + timedelta(days=window_days - 1), last)
            done.append(run_window(spark, nxt, stop, tables))
            nxt = stop + timedelta(days=1)
    return [w for w in done if w is not None]


# ------------------------------------------------------------ checks


def check_tables(spark: SparkSession, tables: Tables = Tables(), window=None) -> DataFrame:
    """Q1-Q5 over every table that has rules: (table, rule, column_name, failures).

    Each table's rules run in one aggregation; with a window the date-partitioned
    tables are read for that window only (partition pruning), so the checks can
    run after every windowed job instead of as a separate full scan.
    """
    from vesseltrack.operators.quality import RULES, run_checks

    windowed = {"ais_clean", "dark_gaps", "impossible_speed", "anomaly_cues"}
    out = None
    for key, (_, name) in tables.names.items():
        rules = RULES.get(name) or RULES.get(key)
        if rules is None or not spark.catalog.tableExists(tables[key]):
            continue
        res = run_checks(spark.table(tables[key]), rules, window if key in windowed else None)
        res = res.select(F.lit(tables[key]).alias("table"), "rule", "column_name", "failures")
        out = res if out is None else out.unionByName(res)
    if out is None:
        return spark.createDataFrame([], "table string, rule string, column_name string, failures bigint")
    return out


# ------------------------------------------------------------ scoring


def score_vessels(spark: SparkSession, tables: Tables = Tables(), seed: int = 42) -> int:
    """M8: score every vessel of the feature table; an empty table leaves old scores."""
    with Scratch(spark) as scratch:
        scores = risk_scores(spark, spark.table(tables["vessel_features"]), seed=seed, scratch=scratch)
        if scores is None:
            return 0
        out = scores.withColumn("_scored_at", F.current_timestamp())
        return store.overwrite_table(spark, out, tables["risk_scores"])


def alert_rows(spark: SparkSession, tables: Tables = Tables(), threshold: float = 0.7, n: int = 20) -> DataFrame:
    """The watchlist an alert would carry (empty = nothing to send)."""
    return watchlist(spark.table(tables["risk_scores"]), threshold, n)
