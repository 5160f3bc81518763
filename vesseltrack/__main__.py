"""Command line: the jobs of one deployment, one sub-command each.

    python -m vesseltrack ingest-ais LANDING_DIR [--end-date D]
    python -m vesseltrack ingest-sanctions ENTITIES_FILE
    python -m vesseltrack run-window [--start D --end D] [--full-refresh] [--end-date D]
    python -m vesseltrack score
    python -m vesseltrack alert [--threshold 0.7] [--top 20]
    python -m vesseltrack checks TABLE_KEY [--start D --end D]

``--sandbox NAME`` prefixes every database (NAME_bronze, NAME_silver, NAME_gold).
The session comes from ``spark-submit``/the environment when one is active.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import date


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="vesseltrack")
    ap.add_argument("--sandbox", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("ingest-ais")
    a.add_argument("landing_dir")
    a.add_argument("--window-days", type=int, default=7)
    a.add_argument("--end-date", type=date.fromisoformat, help="load no file of a later day (default: no end)")
    s = sub.add_parser("ingest-sanctions")
    s.add_argument("path")
    r = sub.add_parser("run-window")
    r.add_argument("--start")
    r.add_argument("--end")
    r.add_argument("--full-refresh", action="store_true")
    r.add_argument("--end-date", type=date.fromisoformat, help="last day of the schedule (default: no end)")
    sub.add_parser("score")
    al = sub.add_parser("alert")
    al.add_argument("--threshold", type=float, default=0.7)
    al.add_argument("--top", type=int, default=20)
    c = sub.add_parser("checks")
    c.add_argument("table_key")
    c.add_argument("--start")
    c.add_argument("--end")
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from vesseltrack.plans import pipeline as P
    from vesseltrack.session import get_session

    spark = SparkSession.getActiveSession() or get_session()
    tables = P.Tables(sandbox=args.sandbox)
    if args.cmd == "ingest-ais":
        per_file: dict = {}
        skipped: dict = {}
        rows = P.ingest_ais(spark, args.landing_dir, tables, window_days=args.window_days, end_date=args.end_date,
                            per_file=per_file, skipped=skipped)
        out = {"rows": rows, "files": per_file, "skipped": skipped}
    elif args.cmd == "ingest-sanctions":
        out = {"rows": P.ingest_sanctions(spark, args.path, tables)}
    elif args.cmd == "run-window":
        w = P.run_window(spark, args.start, args.end, tables, full_refresh=args.full_refresh, end_date=args.end_date)
        out = {"window": None if w is None else [w.start.isoformat(), w.end.isoformat()],
               "advanced": bool(w and w.advance)}
    elif args.cmd == "score":
        out = {"scored": P.score_vessels(spark, tables)}
    elif args.cmd == "alert":
        from vesseltrack.operators.report import report_lines
        lines = report_lines(P.alert_rows(spark, tables, args.threshold, args.top), n=args.top).orderBy("rank").collect()
        out = {"vessels": len(lines), "lines": [r["line"] for r in lines]}
    else:
        from vesseltrack.operators.quality import RULES, run_checks
        key = args.table_key
        rules = RULES.get(tables.names[key][1]) or RULES.get(key)
        if rules is None:
            ap.error(f"no rules for {key}")
        window = (args.start, args.end) if args.start and args.end else None
        res = run_checks(spark.table(tables[key]), rules, window)
        out = {"failures": {f"{r['rule']}:{r['column_name']}": r["failures"] for r in res.collect()}}
    print(json.dumps(out))
    return 0


if __name__ == "__main__":
    sys.exit(main())
