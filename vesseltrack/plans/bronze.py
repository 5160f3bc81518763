"""Loading landed files into bronze, and the log of what has been loaded.

Bronze is partitioned by ``_event_date`` (the UTC day of the ping; null where
the timestamp could not be read) and ``_source_file``: a window reads its own
days only, and a file's rows are replaced partition by partition. The log has a
row for each file and day of each load, so listing the loaded files never
touches bronze, a file without a readable row counts as loaded, and the days a
load has changed are known without looking for them.
"""

from __future__ import annotations

import time
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vesseltrack.functions.filenames import date_from_filename
from vesseltrack.plans import store

LAYOUT = ["_event_date", "_source_file"]
LOG_SCHEMA = "file string, event_date date, load_id bigint"
DAY_SCHEMA = "event_date date, load_id bigint"


def load_files(spark: SparkSession, rows: DataFrame, files: list[str], table: str, log: str,
               per_file: dict | None = None) -> int:
    """Replace the rows of ``files`` in bronze and log every day that gained or lost rows."""
    files = list(files)
    mine = set(files)
    before = loaded_days(spark, table, mine)
    dated = rows.withColumn("_event_date", F.to_date("base_date_time"))
    n = store.replace_files(spark, dated, table, files, LAYOUT, per_file)
    touched = before | loaded_days(spark, table, mine)
    load_id = max(time.time_ns() // 1000, last_load(spark, log) + 1)
    entries = [(f, None if d is None else date.fromisoformat(d), load_id) for d, f in touched]
    entries += [(f, None, load_id) for f in files]  # a file without readable rows is loaded too
    store.append_rows(spark, spark.createDataFrame(sorted(set(entries), key=str), LOG_SCHEMA), log)
    return n


def loaded_days(spark: SparkSession, table: str, files: set[str]) -> set[tuple]:
    """(day, file) partitions of some files, from the catalog."""
    if not spark.catalog.tableExists(table):
        return set()
    return {v for v in store.partition_values(spark, table, LAYOUT) if v[1] in files}


def read_log(spark: SparkSession, log: str) -> DataFrame:
    return spark.table(log) if spark.catalog.tableExists(log) else spark.createDataFrame([], LOG_SCHEMA)


def last_load(spark: SparkSession, log: str) -> int:
    return read_log(spark, log).agg(F.coalesce(F.max("load_id"), F.lit(0))).first()[0]


def file_days(spark: SparkSession, log: str) -> tuple[date | None, date | None]:
    """First and last day that loaded files are named after (days of their rows where no name has a date)."""
    r = read_log(spark, log).select(date_from_filename(F.col("file")).alias("d"), "event_date").agg(
        F.coalesce(F.min("d"), F.min("event_date")).alias("a"), F.coalesce(F.max("d"), F.max("event_date")).alias("b")).first()
    return r["a"], r["b"]


def mark_built(spark: SparkSession, days: list[date], load_id: int, table: str) -> None:
    """Silver and gold of these days reflect every load up to ``load_id``."""
    store.append_rows(spark, spark.createDataFrame([(d, load_id) for d in days], DAY_SCHEMA), table)


def dirty_days(spark: SparkSession, log: str, built: str, until: date) -> DataFrame:
    """Days up to ``until`` that a later load has changed since they were built."""
    state = spark.table(built) if spark.catalog.tableExists(built) else spark.createDataFrame([], DAY_SCHEMA)
    done = state.groupBy("event_date").agg(F.max("load_id").alias("built"))
    loads = read_log(spark, log).where(F.col("event_date") <= F.lit(until)).groupBy("event_date").agg(F.max("load_id").alias("loaded"))
    return loads.join(done, "event_date", "left").where("built is null or loaded > built").select("event_date")
