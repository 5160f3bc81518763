"""Registered queries over a whole deployment: daily .csv.zst files that land out of order,
ingested and run window by window to the end. Their tables must equal the full build."""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vesseltrack import oracle as O
from vesseltrack.operators.quality import RULES
from vesseltrack.plans import pipeline as P
from vesseltrack.plans import store
from vesseltrack.schemas import AIS_COLUMNS
from vesseltrack.session import pin_utc, scratch_path, ship_package
from vesseltrack.sources.catalog import ingested_files
from vesseltrack.sources.fixtures import ais_raw_from_events, entity_lines_from_supplier, sanctions_from_supplier

WINDOW = 20  # days

_PLAYED: dict[tuple, P.Tables] = {}


def landing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter pings as text lines of daily files (day, line)."""
    raw = ais_raw_from_events(spark, sf_dir)
    text = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if c == "base_date_time" else F.col(c) for c in AIS_COLUMNS]
    return raw.select(F.to_date("base_date_time").alias("day"), F.to_csv(F.struct(*text)).alias("line"))


def land(days: DataFrame, folder: str) -> None:
    """Write (day, line) rows as ``ais-DAY.csv.zst`` files; a null line makes a header-only file.

    A task streams its days' lines, sorted by day, through the compressor into
    one open file after the other, so a day of any size needs little memory. A
    task that runs again writes the same files again.
    """
    header = (",".join(AIS_COLUMNS) + "\n").encode()

    def write(batches):
        import pyarrow as pa
        import zstandard
        from pyarrow import fs
        where, base = fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)
        where.create_dir(base, recursive=True)
        day = packed = out = None
        files = 0
        for b in batches:
            for d, line in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if d != day:
                    if out is not None:
                        packed.close()
                    day, files = d, files + 1
                    out = where.open_output_stream(f"{base}/ais-{d}.csv.zst", compression=None)
                    packed = zstandard.ZstdCompressor().stream_writer(out)
                    packed.write(header)
                if line is not None:
                    packed.write(line.encode() + b"\n")
        if out is not None:
            packed.close()
        yield pa.RecordBatch.from_pydict({"files": pa.array([files], type=pa.int64())})

    ship_package(days.sparkSession)
    days.select("day", "line").repartition("day").sortWithinPartitions("day").mapInArrow(write, "files long").agg(F.sum("files")).first()


def land_entities(sanctions: DataFrame, path: str) -> None:
    """Sanctions rows as the entity lines that flatten to them."""
    def one(c):
        return F.when(F.col(c).isNotNull(), F.array(F.col(c).cast("string")))

    names = {"name": "entity_name", "mmsi": "mmsi", "imoNumber": "imo_number", "flag": "flag", "startDate": "designation_date"}
    known = F.map_filter(F.create_map(*[x for k, c in names.items() for x in (F.lit(k), one(c))]), lambda k, v: v.isNotNull())
    sanctions.select(F.to_json(F.struct(F.col("entity_id").alias("id"), F.lit("Vessel").alias("schema"), known.alias("properties"),
                                        F.split("sanctions_list", ", ").alias("datasets"))).alias("value")).write.text(path)


def _files_of(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the input's files: another input under the same path is another deployment."""
    found = []
    for name in ("events", "supplier"):
        for f in spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").inputFiles():
            fs, path = store._fs(spark, f)
            status = fs.getFileStatus(path)
            found.append((f, status.getLen(), status.getModificationTime()))
    return tuple(sorted(found))


def play(spark: SparkSession, sf_dir: str) -> P.Tables:
    """One deployment per session and input: files land in two batches, each run to the end.

    Withheld at first: a day inside a finished window, two more that land after
    their window has passed, and the last one; a header-only file for the day
    after the last ping lands with the second batch. In the end a window is run
    again by explicit dates (the watermark stays), and all vessels are scored.
    """
    pin_utc(spark)
    key = (spark.sparkContext.applicationId, _files_of(spark, sf_dir))
    if key in _PLAYED:
        return _PLAYED[key]
    tables = P.Tables(sandbox=f"vt_landed_{uuid.uuid4().hex[:10]}")
    for layer in ("bronze", "silver", "gold"):
        db = f"{tables.sandbox}_{layer}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch_path(spark, db)}'")
    landing, entities = scratch_path(spark, "landing"), scratch_path(spark, "entities")
    land_entities(sanctions_from_supplier(spark, sf_dir), entities)
    P.ingest_sanctions(spark, entities, tables)
    rows = landing_rows(spark, sf_dir)
    days = sorted(r[0] for r in rows.select("day").distinct().where("day is not null").collect())
    late, gap, after = days[2 % len(days)], days[len(days) // 2], days[len(days) // 2 + 1 if len(days) > 2 else -1]
    first = [d for d in days if d not in (late, gap, after, days[-1])]
    for batch in (first, [late, gap, after, days[-1]]):
        land(rows.where(F.col("day").isin(batch)), landing)
        if late in batch:
            empty = days[-1] + timedelta(days=1)
            land(spark.createDataFrame([(empty, None)], "day date, line string"), landing)
        while P.ingest_ais(spark, landing, tables, window_days=31, spread=2) or _pending(spark, landing, tables):
            pass
        while P.run_window(spark, tables=tables, window_days=WINDOW) is not None:
            pass
    P.run_window(spark, str(days[len(days) // 3]), str(days[min(len(days) - 1, len(days) // 3 + 4)]), tables=tables)
    P.score_vessels(spark, tables)
    _PLAYED[key] = tables
    return tables


def _pending(spark: SparkSession, landing: str, tables: P.Tables) -> bool:
    done = ingested_files(spark, tables["files"]).withColumnRenamed("_source_file", "file")
    return not P.list_landed(spark, landing).join(done, "file", "left_anti").isEmpty()


def _table(key: str, rounded=(), drop=()):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        from vesseltrack.plans.registry import for_compare
        return for_compare(spark.table(play(spark, sf_dir)[key]).drop(*drop), rounded)
    return query


def _q_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded files, header-only one included, from the load log."""
    return ingested_files(spark, play(spark, sf_dir)["files"])


def _q_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The committed watermark after the last window."""
    return spark.table(play(spark, sf_dir)["window_state"]).select("last_end")


def _q_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1-Q5: every rule of every table, over the deployment's own tables."""
    tables = play(spark, sf_dir)
    names = spark.createDataFrame([(tables[k], k) for k in tables.names], "table string, name string")
    return P.check_tables(spark, tables).join(F.broadcast(names), "table").select("name", "rule", "column_name", "failures")


def _q_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: a snapshot table overwritten with half of its rows, by a failing frame, then by all of them."""
    from vesseltrack.sources.sanctions import parse_entity_lines
    db = f"vt_snapshot_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch_path(spark, db)}'")
    table = f"{db}.sanctions"
    rows = parse_entity_lines(entity_lines_from_supplier(spark, sf_dir))
    store.overwrite_table(spark, rows.where("crc32(entity_id) % 2 = 0"), table)
    store.overwrite_table(spark, rows, table)
    try:
        broken = rows.withColumn("entity_id", F.raise_error(F.lit("failing frame")).cast("string"))
        store.overwrite_table(spark, broken, table)
    except Exception as e:  # the failing frame is the point
        if "failing frame" not in str(e):
            raise
    return spark.table(table)


SPEED_ROUNDED = ("distance_nm", "implied_speed_knots", "anomaly_score")
FEATURE_ROUNDED = ("avg_gap_hours", "max_implied_speed", "max_jump_nm", "max_anomaly_score")
QUERIES = {
    "landed_ais_clean": _table("ais_clean", drop=("_ingestion_ts",)),
    "landed_dark_gaps": _table("dark_gaps"),
    "landed_impossible_speed": _table("impossible_speed", SPEED_ROUNDED),
    "landed_vessel_features": _table("vessel_features", FEATURE_ROUNDED),
    "landed_files": _q_files,
    "landed_watermark": _q_state,
    "landed_sanctions": _table("sanctions", drop=("_ingestion_ts", "_source_file")),
    "landed_scores": _table("risk_scores", (*FEATURE_ROUNDED, "risk_score"), drop=("_scored_at",)),
    "landed_checks": _q_checks,
    "snapshot_overwrite": _q_snapshot,
}

# The files hold whole seconds, and all rows of a batch have one ingestion time.
_SECONDS = O.AIS_RAW.replace("ts AS base_date_time", "date_trunc('second', ts) AS base_date_time").replace(
    "CASE WHEN seq = 1 THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2024-02-02 00:00:00' END", "TIMESTAMP '2024-02-01 00:00:00'")
_LAST = "(SELECT max(CAST(ts AS DATE)) FROM events)"


def _checks_sql() -> str:
    """Failures of every rule, by DuckDB over its own tables. Lineage columns of the sanctions are set by the load and never null."""
    failing = {"not_null": "{c} IS NULL", "is_null": "{c} IS NOT NULL", "expr": "coalesce({a}, false) = false"}
    out = []
    for key, (_, name) in P.Tables().names.items():
        for kind, column, arg in RULES.get(name) or RULES.get(key) or ():
            head = f"SELECT '{key}' AS name, '{kind}' AS rule, '{column}' AS column_name, "
            if kind == "unique":
                out.append(f"{head}count(*) AS failures FROM (SELECT {column} FROM {key} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
            elif key == "sanctions" and column == "_ingestion_ts":
                out.append(head + "0 AS failures")
            elif kind == "accepted":
                out.append(f"{head}count(*) FILTER ({column} NOT IN ({', '.join(map(repr, arg))})) AS failures FROM {key}")
            else:
                out.append(f"{head}count(*) FILTER ({failing[kind].format(c=column, a=arg)}) AS failures FROM {key}")
    return " UNION ALL ".join(out)


def _oracle(ais_raw: str) -> dict[str, str]:
    from vesseltrack.plans.registry_model import ORACLE as MODEL

    def gold(select: str, **kw) -> str:
        return O.gold(**kw).replace(O.AIS_RAW.strip("\n"), ais_raw.strip("\n")) + select
    return {
        "landed_sanctions": O.with_ctes(O.SANCTIONS) + "SELECT * FROM sanctions",
        "landed_scores": MODEL["risk_scores"].replace(O.AIS_RAW.strip("\n"), ais_raw.strip("\n")),
        "landed_checks": gold(_checks_sql(), features=True, cues=True),
        "landed_ais_clean": O.with_ctes(ais_raw, O.clean_ctes()) + "SELECT * EXCLUDE (_ingestion_ts) FROM ais_clean",
        "landed_dark_gaps": gold(O.DARK_GAP_SELECT),
        "landed_impossible_speed": gold(O.SPEED_SELECT),
        "landed_vessel_features": gold(O.FEATURE_SELECT, features=True),
        "landed_files": f"SELECT DISTINCT 'ais-' || CAST(CAST(ts AS DATE) AS VARCHAR) || '.csv.zst' AS _source_file FROM events "
                        f"UNION SELECT 'ais-' || CAST({_LAST} + 1 AS VARCHAR) || '.csv.zst'",
        "landed_watermark": f"SELECT {_LAST} + 1 AS last_end",
    }


ORACLE = _oracle(_SECONDS)
