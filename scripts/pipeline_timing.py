"""End-to-end job timings over landed files built from the driver's tables.

    python scripts/pipeline_timing.py [sf_dir]

Writes daily .csv.zst files and an entity NDJSON file (from ``events`` /
``supplier``) to a fresh folder under the shared checkpoint directory, then
times: ingest (all windows), sanctions ingest, an empty-window run, every
transform window in order, scoring, and the alert rows. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid
from datetime import date

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from vesseltrack.plans import pipeline as P  # noqa: E402
from vesseltrack.schemas import AIS_COLUMNS  # noqa: E402
from vesseltrack.session import get_session, scratch_path  # noqa: E402
from vesseltrack.sources.fixtures import ais_raw_from_events, entity_lines_from_supplier  # noqa: E402

END = date(2024, 1, 31)


def land(spark, sf_dir: str, root: str) -> None:
    """One zstd CSV per day (header, 'yyyy-MM-dd HH:mm:ss'), each written by the task of its day."""
    raw = ais_raw_from_events(spark, sf_dir).where("_ingestion_ts = timestamp'2024-02-01 00:00:00'")
    cols = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if c == "base_date_time" else F.col(c).cast("string")
            for c in AIS_COLUMNS]
    out = raw.select(*cols, F.to_date("base_date_time").cast("string").alias("day"))
    # the files are written with Python's open(): this tool needs a local checkpoint folder
    if not root.startswith(("file:", "/")):
        raise SystemExit("pipeline_timing writes landing files locally; use a local spark.checkpoint.dir")
    local = root[len("file:"):] if root.startswith("file:") else root
    os.makedirs(f"{local}/landing", exist_ok=True)
    landing = f"{local}/landing"

    def write_day(pdf):
        import zstandard
        day = pdf["day"].iloc[0]
        text = pdf[AIS_COLUMNS].to_csv(index=False, na_rep="")
        with open(f"{landing}/ais-{day}.csv.zst", "wb") as f:
            f.write(zstandard.ZstdCompressor().compress(text.encode()))
        return pdf[["day"]].head(1).assign(rows=len(pdf))

    out.groupBy("day").applyInPandas(write_day, "day string, rows long").collect()  # one row per day
    entity_lines_from_supplier(spark, sf_dir).coalesce(1).write.text(f"{root}/entities")


def main(sf_dir: str) -> None:
    spark = get_session(app="vesseltrack-pipeline-timing")
    root = scratch_path(spark, "pipeline-timing")
    land(spark, sf_dir, root)
    tables = P.Tables(sandbox=f"tm{uuid.uuid4().hex[:8]}")
    T = time.perf_counter
    out = {"sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", "")}
    t = T()
    rows = 0
    for _ in range(6):
        rows += P.ingest_ais(spark, f"{root}/landing", tables, end_date=END)
    out["ingest_sec"], out["ingested_rows"] = round(T() - t, 2), rows
    t = T()
    P.ingest_sanctions(spark, f"{root}/entities", tables)
    out["sanctions_sec"] = round(T() - t, 2)
    t = T()
    P.run_window(spark, tables=tables, end_date=END)
    out["first_window_sec"] = round(T() - t, 2)
    t = T()
    P.run_window(spark, "2023-06-01", "2023-06-07", tables, end_date=END)
    out["empty_window_sec"] = round(T() - t, 2)
    times = []
    while True:
        t = T()
        w = P.run_window(spark, tables=tables, end_date=END)
        if w is None:
            break
        times.append(round(T() - t, 2))
    out["later_windows_sec"] = times
    t = T()
    out["scored"] = P.score_vessels(spark, tables)
    out["score_sec"] = round(T() - t, 2)
    t = T()
    out["alert_rows"] = P.alert_rows(spark, tables).count()
    out["alert_sec"] = round(T() - t, 2)
    print(json.dumps(out))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
