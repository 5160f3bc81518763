"""Near-real-time detection: both detectors over a stream of landed pings, with keyed state.

The stream keeps, per vessel, what is needed to find a ping's neighbours in time
and corrects itself when a late ping falls between two earlier ones. Its output
is a log of *steps* (a ping and its predecessor), each with ``change`` +1 when the
step appears and -1 when a late ping, or a newer copy of one of its pings, breaks
it. The detectors of the batch path read the steps; what a log holds in sum is
what the batch path finds over the same pings, whatever the order of arrival.

Two stateful operators, so that no vessel is one task:

* ``SlotSteps``, by vessel and time slot: the pings of a slot, deduplicated
  by the batch rules; emits the steps inside the slot, and the slot's *edge*
  (first and last ping) when it changed.
* ``VesselSteps``, by vessel: the edges by slot; emits the steps that cross
  slots. A timer six hours (``alert_hours``) after the vessel's newest ping raises
  a ``gap_open`` row if no newer ping has come by then.

A call per key with its state costs milliseconds, whatever the key holds, so a key
is not one vessel: the first operator's vessels are dealt into ``shards`` (a key is
a shard and a slot), the second's into ``groups``. A key's state is read and
written as a whole; choose both so that it holds about a thousand pings or edges.

``lateness`` is the watermark's delay: pings later than that are dropped by
Spark. State older than the watermark is cleared by timers (a slot) and on
update (a vessel's edges, all but the newest one below the watermark), so it is
bounded by the pings within ``lateness``.

Each micro-batch is written to a folder of its own number, replacing it, so a
batch that runs again after a crash leaves no doubles.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vesseltrack.operators.clean import quality_flag
from vesseltrack.operators.detect import DARK_GAP_MIN_HOURS, dark_gaps, impossible_speed
from vesseltrack.schemas import AIS_COLUMNS
from vesseltrack.session import pin_utc, ship_package
from vesseltrack.streaming import vessel_state
from vesseltrack.streaming.ingest import stream_checkpoint
from vesseltrack.streaming.vessel_state import GAP_OPEN, OUTPUT, STEP, SlotSteps, VesselSteps

cloudpickle.register_pickle_by_value(vessel_state)

SLOT_SECONDS = 3600
SHARDS, GROUPS = 64, 1024
STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DETECTORS = {"dark_gaps": dark_gaps, "impossible_speed": impossible_speed}

# order of copies of one ping, as in the batch dedup: the greatest wins, nulls are least
COPY_ORDER = ["_ingestion_ts", "_source_file", *(c for c in AIS_COLUMNS if c not in ("mmsi", "base_date_time"))]


def _copy_columns(schema) -> list:
    """``COPY_ORDER`` as c0, c1, ... without NaN (the greatest value, so infinity stands for it)."""
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    out = []
    for i, c in enumerate(COPY_ORDER):
        x = F.col(c)
        x = F.unix_micros(x) if kinds[c] == "timestamp" else F.when(F.isnan(x), float("inf")).otherwise(x) if kinds[c] == "double" else x
        out.append(x.alias(f"c{i}"))
    return out


def _dealt(keys: int):
    """Number of a vessel's key, from 0."""
    return F.pmod(F.xxhash64("vessel"), F.lit(keys))


def step_changes(raw: DataFrame, lateness: str = "2 hours", slot_seconds: int = SLOT_SECONDS,
                 alert_hours: float = DARK_GAP_MIN_HOURS, shards: int = SHARDS, groups: int = GROUPS) -> DataFrame:
    """Streaming bronze rows to the log of steps, edges' crossings and ``gap_open`` rows.

    Pings without a time take part in no step; a null mmsi is a vessel of its own.
    """
    ship_package(raw.sparkSession)
    slot_us = slot_seconds * 1_000_000
    pings = (quality_flag(raw.where("base_date_time is not null").withWatermark("base_date_time", lateness))
             .select(F.coalesce(F.concat(F.lit("m"), "mmsi"), F.lit("")).alias("vessel"), F.expr(f"unix_micros(base_date_time) div {slot_us}").alias("slot"),
                     F.unix_micros("base_date_time").alias("ts"), F.col("quality_flag").isNull().alias("valid"),
                     F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), F.col("vessel_name").alias("name"),
                     *_copy_columns(raw.schema), "base_date_time").withColumn("shard", _dealt(shards)))
    inside = pings.groupBy("shard", "slot").transformWithStateInPandas(
        SlotSteps(slot_us, len(COPY_ORDER)), OUTPUT, "append", "eventTime", eventTimeColumnName="at")
    return inside.withColumn("group", _dealt(groups)).groupBy("group").transformWithStateInPandas(
        VesselSteps(int(alert_hours * 3600 * 1_000_000), slot_us), OUTPUT, "append", "eventTime")


def as_timeline(steps: DataFrame) -> DataFrame:
    """Steps in the columns of the batch timeline, with their change."""
    return steps.where(F.col("kind") == STEP).select(
        F.when(F.col("vessel") != "", F.substring("vessel", F.lit(2), F.length("vessel"))).alias("mmsi"), F.col("name").alias("vessel_name"),
        F.timestamp_micros("ts").alias("base_date_time"), F.col("lat").alias("latitude"), F.col("lon").alias("longitude"),
        F.timestamp_micros("prev_ts").alias("prev_ts"), "prev_lat", "prev_lon", "change")


def watch(raw: DataFrame, out: str, checkpoint: str | None = None, available_now: bool = True, **options) -> StreamingQuery:
    """Starts the stream: event changes to ``out/dark_gaps`` and ``out/impossible_speed``, alerts to ``out/gap_open``.

    ``raw``: a streaming frame of bronze rows. ``out`` is a folder on shared storage.
    """
    spark = raw.sparkSession
    pin_utc(spark)

    def write_batch(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        staged = f"{out}/steps/batch={number}"
        batch.write.mode("overwrite").parquet(staged)  # the stateful plan runs once; all that follows reads this copy
        rows = session.read.schema(OUTPUT).parquet(staged)
        for name, detect in DETECTORS.items():
            signed = [detect(as_timeline(rows).where(F.col("change") == c)).withColumn("change", F.lit(c)) for c in (1, -1)]
            signed[0].unionByName(signed[1]).write.mode("overwrite").parquet(f"{out}/{name}/batch={number}")
        alerts = rows.where(F.col("kind") == GAP_OPEN).select(
            F.expr("if(vessel = '', null, substring(vessel, 2))").alias("mmsi"), F.col("name").alias("vessel_name"),
            F.timestamp_micros("ts").alias("last_seen"), F.col("lat").alias("last_known_lat"), F.col("lon").alias("last_known_lon"), "at")
        alerts.write.mode("overwrite").parquet(f"{out}/{GAP_OPEN}/batch={number}")

    key, before = "spark.sql.streaming.stateStore.providerClass", spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set(key, STATE_PROVIDER)
    try:
        writer = step_changes(raw, **options).writeStream.foreachBatch(write_batch).option(
            "checkpointLocation", checkpoint or stream_checkpoint(spark, "watch"))
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
        return writer.start()
    finally:
        spark.conf.set(key, before)


def live_events(spark: SparkSession, out: str, name: str) -> DataFrame:
    """The events of ``name`` that stand: raised more often than withdrawn."""
    log = spark.read.option("mergeSchema", "false").parquet(f"{out}/{name}").drop("batch")
    columns = [c for c in log.columns if c != "change"]
    return log.groupBy(*columns).agg(F.sum("change").alias("change")).where("change > 0").drop("change")
