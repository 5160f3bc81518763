"""Spark vs DuckDB comparison in the shape of the driver's correctness gate.

Row count, sorted column names and an order-insensitive hash of the values
(doubles compared after rounding to 9 significant places to absorb printing).
Usable from pytest or as ``python tests/oracle_harness.py [sf_dir] [key ...]``.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

STRICT = os.environ.get("VT_LOOSE_FLOATS") is None

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v) if STRICT else repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def compare(spark, sf_dir: str, key: str, query, sql: str, con=None):
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    sh, sl = digest(s_rows, s_cols)
    dh, dl = digest(d_rows, d_cols)
    res = {
        "key": key, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
        "cols_match": sorted(s_cols) == sorted(d_cols), "hash_match": sh == dh,
        "spark_sec": round(t1 - t0, 2),
    }
    if sh != dh:
        a, b = set(sl), set(dl)
        res["only_spark"] = sorted(a - b)[:3]
        res["only_oracle"] = sorted(b - a)[:3]
        if sorted(s_cols) != sorted(d_cols):
            res["spark_cols"], res["oracle_cols"] = s_cols, d_cols
    return res


def main(argv):
    from vesseltrack.session import get_session
    import __spark_entry__ as E
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:] or list(E.queries())
    spark = get_session()
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        if k not in sqls:
            df = qs[k](spark, sf_dir)
            print({"key": k, "rows_only": df.count()})
            continue
        try:
            r = compare(spark, sf_dir, k, qs[k], sqls[k], con)
        except Exception as e:  # report and continue
            r = {"key": k, "error": repr(e)[:500]}
        ok = r.get("hash_match") and r.get("cols_match")
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(keys) - bad}/{len(keys)} match")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
