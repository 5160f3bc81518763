"""Incremental ingest of landed daily files with Structured Streaming.

The file source's own log remembers which files were processed (no listing
anti-join, no date arithmetic to find the next window, and a day that lands
late is still picked up). Each micro-batch holds at most
``max_files_per_trigger`` files and is written with the same reader options
(header check included), per-file replace and load log as the batch ingest, so
a retried batch replaces its files' rows instead of duplicating them: the sink
is idempotent and the stream exactly-once in effect. ``available_now`` processes what has landed and stops
(a scheduled run); without it the query keeps watching the folder.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from vesseltrack.plans import bronze
from vesseltrack.session import ensure_checkpoint_dir, pin_utc
from vesseltrack.sources.ais import source_file_name, typed_ais, with_csv_options, with_lineage


def stream_checkpoint(spark: SparkSession, name: str) -> str:
    """A stable per-stream folder under the shared checkpoint directory."""
    safe = re.sub(r"[^A-Za-z0-9_.-]", "_", name)
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/vt-streams/{safe}"


def ingest_stream(spark: SparkSession, landing_dir: str, table: str = "bronze.ais_raw",
                  log: str = "bronze.ais_files", checkpoint: str | None = None, max_files_per_trigger: int = 7,
                  available_now: bool = True, pattern: str = "*.csv.zst") -> StreamingQuery:
    """Start the stream: landed files -> typed rows + lineage -> ``table``."""
    pin_utc(spark)
    src = with_csv_options(spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
                           .option("pathGlobFilter", pattern)).csv(landing_dir)
    rows = typed_ais(src, source_file_name().alias("_source_file"))

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        # a retried batch replaces the same files' rows; at most maxFilesPerTrigger names
        names = [r[0] for r in batch.select("_source_file").distinct().collect()]
        if names:
            bronze.load_files(batch.sparkSession, with_lineage(batch), names, table, log)

    writer = (rows.writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint or stream_checkpoint(spark, f"ingest-{table}")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
