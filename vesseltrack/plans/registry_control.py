"""Registered queries for window control, file listings, entity JSON and table writes."""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vesseltrack import oracle as O
from vesseltrack.functions.filenames import date_from_filename
from vesseltrack.operators.clean import clean
from vesseltrack.operators.detect import dark_gaps
from vesseltrack.operators.timeline import TIMELINE_INPUT, timeline
from vesseltrack.plans import store
from vesseltrack.plans.window import SCHEDULE_END, next_window_frame, window_state_frame
from vesseltrack.session import materialize, pin_utc, scratch_path
from vesseltrack.sources.fixtures import ais_raw_from_events, entity_lines_from_supplier, load
from vesseltrack.sources.sanctions import parse_entity_lines

# Fixed values of these checks: files up to this date count as already ingested.
INGESTED_BEFORE = date(2024, 1, 15)


def landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file listing derived from the events: one daily name per event date, plus
    malformed names (compact dates for 'error' events, a shifted prefix for 'click')."""
    pin_utc(spark)
    ev = load(spark, sf_dir, "events")
    day = F.to_date(F.col("ts").cast("timestamp"))
    good = F.concat(F.lit("ais-"), day.cast("string"), F.lit(".csv.zst"))
    names = F.when(F.col("event_type") == "error",
                   F.array(good, F.concat(F.lit("ais-"), F.date_format(day, "yyyyMMdd"), F.lit(".csv"))))
    names = names.when(F.col("event_type") == "click", F.array(good, F.concat(F.lit("x"), good)))
    names = names.otherwise(F.array(good))
    return ev.select(F.explode(names).alias("file")).distinct()


def _q_file_dates(spark, d):
    files = landed_files(spark, d)
    return files.select("file", date_from_filename(F.col("file")).alias("file_date"))


def _ingested(files: DataFrame) -> DataFrame:
    return files.where(date_from_filename(F.col("file")) < F.lit(INGESTED_BEFORE))


def _q_next_window(spark, d):
    return next_window_frame(_ingested(landed_files(spark, d)), "file", end_date=SCHEDULE_END)


def _q_new_files(spark, d):
    files = landed_files(spark, d)
    done = _ingested(files)
    win = next_window_frame(done, "file", end_date=SCHEDULE_END).first()  # one row: the window's two dates
    landed = files.withColumn("file_date", date_from_filename(F.col("file")))
    if win is None:
        return landed.where(F.lit(False))
    in_window = landed.where(F.col("file_date").between(win["window_start"], win["window_end"]))
    return in_window.join(done, "file", "left_anti")


def _q_window_state(spark, d):
    c = clean(ais_raw_from_events(spark, d))
    state = c.agg(F.max("event_date").alias("last_end"))
    return window_state_frame(state, end_date=SCHEDULE_END)


def _q_sanctions_flatten(spark, d):
    return parse_entity_lines(entity_lines_from_supplier(spark, d))


def _q_json_props(spark, d):
    ev = load(spark, d, "events")
    return ev.select("event_id", F.from_json("props", "k int").getField("k").alias("k"))


def _weeks(days) -> list[tuple[date, date]]:
    """Seven-day windows from the first day to the last one."""
    first, last = days
    return [(first + timedelta(days=i), min(first + timedelta(days=i + 6), last)) for i in range(0, (last - first).days + 1, 7)]


def _q_replace_roundtrip(spark, d):
    """Dark gaps written window by window, one window rerun, the last 19 days replaced by nothing.

    Final state: every gap of the days before (windows union = full build,
    a rerun adds no duplicates, a day that loses all rows ends empty).
    """
    pin_utc(spark)
    db = f"vt_roundtrip_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch_path(spark, db)}'")
    table = f"{db}.ais_dark_gaps"
    # cleaned once: every window reads this copy
    silver = materialize(clean(ais_raw_from_events(spark, d)).select("event_date", *TIMELINE_INPUT), "roundtrip-silver")
    weeks = _weeks(silver.agg(F.min("event_date"), F.max("event_date")).first())
    for w in [*weeks, weeks[1 % len(weeks)]]:  # one window is run again
        store.replace_window(spark, dark_gaps(timeline(silver, w), w), table, *w)
    last = weeks[-1][1]
    gone = (max(last - timedelta(days=18), weeks[0][0]), last)  # these days lose all their rows
    store.replace_window(spark, dark_gaps(timeline(silver, gone), gone).where(F.lit(False)), table, *gone)
    from vesseltrack.plans.registry import for_compare
    return for_compare(spark.table(table).select(*[c for c in spark.table(table).columns]))


def _by_file(spark: SparkSession, raw: DataFrame) -> DataFrame:
    """The pings in a folder per file, as files land: a batch reads its own files only."""
    path = scratch_path(spark, "bronze-landed")
    raw.write.partitionBy("_source_file").parquet(path)
    return spark.read.schema(raw.schema).parquet(path).select(*raw.columns)


def _q_bronze_reingest(spark, d):
    """Bronze loaded file by file in weekly batches, with the first week's files loaded again.

    Final state: every adapter row exactly once (a re-ingest replaces a file's rows).
    """
    pin_utc(spark)
    db = f"vt_bronze_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch_path(spark, db)}'")
    table = f"{db}.ais_raw"
    raw = _by_file(spark, ais_raw_from_events(spark, d))
    day = date_from_filename(F.col("_source_file"))
    weeks = _weeks(raw.select(F.min(day), F.max(day)).first())
    for a, b in [*weeks, weeks[0]]:  # the first week is loaded again
        batch = raw.where(day.between(F.lit(a), F.lit(b)))
        files = [r["_source_file"] for r in batch.select("_source_file").distinct().collect()]  # <= days
        store.replace_files(spark, batch, table, files)
    from vesseltrack.plans.registry import for_compare
    return for_compare(spark.table(table))


def _land_csv(spark, d) -> str:
    """The adapter's pings written as daily-style CSV (header, 'yyyy-MM-dd HH:mm:ss') into scratch."""
    from vesseltrack.schemas import AIS_COLUMNS
    raw = ais_raw_from_events(spark, d)
    out = raw.select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if c == "base_date_time" else F.col(c)
                       for c in AIS_COLUMNS])
    path = scratch_path(spark, "landed-csv")
    out.write.option("header", True).csv(path)
    return path


def _q_csv_scan(spark, d):
    """Declared-schema CSV scan of landed files (all columns read as text, then typed)."""
    from vesseltrack.sources.ais import read_ais
    from vesseltrack.plans.registry import for_compare
    return for_compare(read_ais(spark, _land_csv(spark, d), source_file=False))


def _q_stream_scan(spark, d):
    """The same files through the Structured Streaming ingest (available-now trigger) into a table."""
    from vesseltrack.plans.registry import for_compare
    from vesseltrack.schemas import AIS_COLUMNS
    from vesseltrack.streaming import ingest_stream
    src = _land_csv(spark, d)
    db = f"vt_stream_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch_path(spark, db)}'")
    q = ingest_stream(spark, src, f"{db}.ais_raw", f"{db}.ais_files", checkpoint=scratch_path(spark, "stream-ckpt"),
                      max_files_per_trigger=4, pattern="*.csv")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return for_compare(spark.table(f"{db}.ais_raw").select(*AIS_COLUMNS))


def _q_sanctions_file(spark, d):
    """The entity lines written as an NDJSON file and read back by the file reader."""
    from vesseltrack.sources.sanctions import read_sanctions
    path = scratch_path(spark, "entities")
    entity_lines_from_supplier(spark, d).write.text(path)
    return read_sanctions(spark, path)


QUERIES = {
    "sanctions_file_scan": _q_sanctions_file,
    "ais_csv_scan": _q_csv_scan,
    "ais_stream_scan": _q_stream_scan,
    "bronze_reingest": _q_bronze_reingest,
    "file_dates": _q_file_dates,
    "next_window": _q_next_window,
    "new_files_anti": _q_new_files,
    "window_state": _q_window_state,
    "sanctions_flatten": _q_sanctions_flatten,
    "json_props": _q_json_props,
    "replace_window_roundtrip": _q_replace_roundtrip,
}

_FILES = """
files AS (
  SELECT DISTINCT file FROM (
    SELECT 'ais-' || CAST(CAST(ts AS DATE) AS VARCHAR) || '.csv.zst' AS file FROM events
    UNION ALL
    SELECT 'ais-' || strftime(CAST(ts AS DATE), '%Y%m%d') || '.csv' FROM events WHERE event_type = 'error'
    UNION ALL
    SELECT 'xais-' || CAST(CAST(ts AS DATE) AS VARCHAR) || '.csv.zst' FROM events WHERE event_type = 'click')
),
dated AS (
  SELECT file,
    CASE WHEN regexp_full_match(substr(file, 5, 4) || substr(file, 10, 2) || substr(file, 13, 2), '[0-9]{8}')
              AND substr(file, 5, 4) <> '0000'
         THEN CAST(try_strptime(substr(file, 5, 4) || substr(file, 10, 2) || substr(file, 13, 2), '%Y%m%d') AS DATE)
    END AS file_date
  FROM files
),
done AS (SELECT * FROM dated WHERE file_date < DATE '2024-01-15'),
win AS (
  SELECT coalesce(max(file_date) + 1, DATE '2024-01-01') AS window_start,
         least(coalesce(max(file_date) + 1, DATE '2024-01-01') + 6, DATE '2024-12-31') AS window_end
  FROM done
)"""

_AIS_SECONDS = O.with_ctes(O.AIS_RAW) + (
    "SELECT mmsi, date_trunc('second', base_date_time) AS base_date_time, longitude, latitude, sog, cog, "
    "heading, vessel_name, imo, call_sign, vessel_type, status, length, width, draft, cargo, transceiver "
    "FROM ais_raw")

ORACLE = {
    "ais_csv_scan": _AIS_SECONDS,
    "ais_stream_scan": _AIS_SECONDS,
    "bronze_reingest": O.with_ctes(O.AIS_RAW) + (
        "SELECT mmsi, base_date_time, longitude, latitude, sog, cog, heading, vessel_name, imo, call_sign, "
        "vessel_type, status, length, width, draft, cargo, transceiver, _ingestion_ts, _source_file FROM ais_raw"),
    "file_dates": O.with_ctes(_FILES) + "SELECT file, file_date FROM dated",
    "next_window": O.with_ctes(_FILES) + "SELECT window_start, window_end FROM win "
                                         "WHERE window_start <= DATE '2024-12-31'",
    "new_files_anti": O.with_ctes(_FILES) + (
        "SELECT d.file, d.file_date FROM dated d "
        "WHERE d.file_date BETWEEN (SELECT window_start FROM win) AND (SELECT window_end FROM win) "
        "AND NOT EXISTS (SELECT 1 FROM done x WHERE x.file = d.file)"),
    "window_state": O.with_ctes(O.AIS_RAW, O.clean_ctes()) + """
, st AS (SELECT max(event_date) AS last_end FROM ais_clean),
nx AS (SELECT coalesce(last_end + 1, DATE '2024-01-01') AS s FROM st)
SELECT CASE WHEN s <= DATE '2024-12-31' THEN s END AS window_start,
       CASE WHEN s <= DATE '2024-12-31' THEN least(s + 6, DATE '2024-12-31') END AS window_end,
       s <= DATE '2024-12-31' AS advance
FROM nx""",
    "sanctions_flatten": f"""
SELECT 'ent-' || CAST(s_suppkey AS VARCHAR) AS entity_id,
       s_name AS entity_name,
       CASE WHEN s_suppkey % 7 = 0 OR s_suppkey % 9 = 0 THEN NULL ELSE {O._mmsi('s_suppkey')} END AS mmsi,
       'IMO' || CAST(9000000 + s_suppkey AS VARCHAR) AS imo_number,
       CAST(s_nationkey AS VARCHAR) AS flag,
       CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE 'us_ofac_sdn, list_' || CAST(s_suppkey % 3 AS VARCHAR) END
         AS sanctions_list,
       '2023-06-01' AS designation_date
FROM supplier WHERE s_suppkey % 4 <> 1""",
    "json_props": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "replace_window_roundtrip": O.gold() + O.DARK_GAP_SELECT + (
        " WHERE event_date < (SELECT greatest(max(event_date) - 18, min(event_date)) FROM ais_clean)"),
}

ORACLE["sanctions_file_scan"] = ORACLE["sanctions_flatten"]
