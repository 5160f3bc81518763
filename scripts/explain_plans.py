"""Write PLANS.md: the physical plans of the headline operators (formatted explain).

Run: python scripts/explain_plans.py [sf_dir]. Tables for the windowed plan are
written to a fresh warehouse under the shared checkpoint folder.
"""

from __future__ import annotations

import io
import os
import re
import sys
import uuid
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from vesseltrack.operators.clean import clean  # noqa: E402
from vesseltrack.operators.cues import anomaly_cues  # noqa: E402
from vesseltrack.operators.detect import dark_gaps, impossible_speed  # noqa: E402
from vesseltrack.operators.features import vessel_features  # noqa: E402
from vesseltrack.operators.situations import outages, port_calls, zones  # noqa: E402
from vesseltrack.operators.timeline import daily_last_ping, timeline  # noqa: E402
from vesseltrack.plans import bronze, store  # noqa: E402
from vesseltrack.session import get_session, scratch_path  # noqa: E402
from vesseltrack.sources.fixtures import ais_raw_from_events, sanctions_from_supplier  # noqa: E402


def tree(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    head = text.split("\n\n")[0]
    scans = re.findall(r"\(\d+\) Scan parquet.*?\n(?:.*\n)*?ReadSchema: .*", text)
    details = "\n".join(s for s in scans)
    return head + "\n\n" + details


def main(sf_dir: str) -> None:
    spark = get_session()
    db = f"plans_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, db)}'")
    raw = ais_raw_from_events(spark, sf_dir)
    sanc = sanctions_from_supplier(spark, sf_dir)
    c = clean(raw)
    store.overwrite_table(spark, c, f"{db}.ais_clean", partition_by="event_date")
    store.overwrite_table(spark, daily_last_ping(c), f"{db}.last_ping", partition_by="event_date")
    silver = spark.table(f"{db}.ais_clean")
    w = ("2024-01-08", "2024-01-14")
    tl_w = timeline(silver, w, lookback=spark.table(f"{db}.last_ping"))
    files = [r[0] for r in raw.select("_source_file").distinct().collect()]  # one per day
    bronze.load_files(spark, raw, files, f"{db}.ais_raw", f"{db}.ais_files")
    days = spark.table(f"{db}.ais_raw").where(F.col("_event_date").between(*(F.lit(d).cast("date") for d in w)))
    tl = timeline(silver)
    g, j = dark_gaps(tl), impossible_speed(tl)
    sections = [
        ("Clean (dedup with partial WindowGroupLimit, validation)", clean(raw)),
        ("Clean of one window from bronze (partition filter on the event day)", clean(days.drop("_event_date"), w)),
        ("Dark gaps, full build (split lag: hot-hour check, bucket tails, context window, main window)",
         g),
        ("Dark gaps for one window from partitioned silver + vessel-day lookback table", dark_gaps(tl_w, w)),
        ("Anomaly cues (sanctions broadcast after a size check)", anomaly_cues(g, j, sanc)),
        ("Vessel features (one union + one aggregation; sanctions name sets broadcast)",
         vessel_features(g, j, sanc)),
        ("Outages (gap ends summed per instant, running sums over day buckets)", outages(g)),
        ("Zones, all levels (finest cells first, then grouping sets over their prefixes)", zones(g, j)),
        ("Port calls (lag and running sum over day buckets)", port_calls(silver)),
    ]
    out = ["# PLANS", "", f"Physical plans (`explain('formatted')`) at {sf_dir}, generated by "
           "`scripts/explain_plans.py`. Each shows the operator tree and the parquet scans "
           "(pushed filters, partition filters, pruned read schema).", ""]
    for title, df in sections:
        out += [f"## {title}", "", "```", tree(df).rstrip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
