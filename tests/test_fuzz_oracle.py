"""Registered queries vs their DuckDB twins on small random tables with adversarial content.

The driver's tables have no exact (user, ts) duplicates, NaN values or null
timestamps; these do, so dedup tie-breaks, NaN validation and null ordering
are compared across engines too.
"""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as E
from tests.oracle_harness import compare, duck

KEYS = ["ais_raw_scan", "ais_dedup", "quality_flags", "ais_clean", "ais_clean_window", "prior_ping",
        "timeline", "dark_gaps", "impossible_speed", "anomaly_cues", "dark_gaps_window",
        "impossible_speed_window", "anomaly_cues_window", "last_ping_daily", "vessel_features",
        "vessel_features_partials", "sanctions_match", "check_not_null", "top_vessel_lines", "window_state",
        "timeline_split_stress", "dark_gaps_hot_vessel", "vessel_day_partials"]


def _tables(root, seed):
    rng = np.random.default_rng(seed)
    n = 900
    users = rng.integers(0, 12, n)
    base = np.datetime64("2024-01-01T00:00:00", "us")
    offs = rng.integers(0, 30 * 86400 * 10**6, n)
    # bursts of microsecond steps and exact (user, ts) duplicates with different data
    offs[::37] = offs[::37] // 10**6 * 10**6
    dup = rng.choice(n, 60, replace=False)
    offs[dup[:30]] = offs[dup[30:]]
    users[dup[:30]] = users[dup[30:]]
    ts = base + offs.astype("timedelta64[us]")
    value = np.round(rng.exponential(30, n), 2)
    value[rng.choice(n, 15, replace=False)] = np.nan
    ts_col = pa.array(ts, type=pa.timestamp("us"))
    mask = np.zeros(n, dtype=bool)
    mask[rng.choice(n, 5, replace=False)] = True
    ts_col = pa.array([None if m else t for m, t in zip(mask, ts.tolist())], type=pa.timestamp("us"))
    etypes = rng.choice(["signup", "view", "click", "purchase", "error"], n)
    events = pa.table({
        "event_id": pa.array(rng.permutation(n).astype("int64")),
        "ts": ts_col,
        "user_id": pa.array(users.astype("int64")),
        "event_type": pa.array(etypes),
        "value": pa.array(value, from_pandas=False),
        "props": pa.array([f'{{"k": {int(k)}}}' for k in rng.integers(0, 99, n)]),
    })
    pq.write_table(events, f"{root}/events.parquet")
    names = ["Supplier#%03d" % i for i in range(12)]
    names[3], names[5] = "Ольга", "  vessel-5 "
    supplier = pa.table({
        "s_suppkey": pa.array(np.arange(12, dtype="int64")),
        "s_name": pa.array(names),
        "s_nationkey": pa.array(rng.integers(0, 25, 12).astype("int32")),
        "s_acctbal": pa.array(np.round(rng.normal(5000, 100, 12), 2)),
    })
    pq.write_table(supplier, f"{root}/supplier.parquet")


@pytest.fixture(scope="module", params=[11, 29])
def fuzz_dir(request, tmp_path_factory):
    root = tmp_path_factory.mktemp(f"fuzz{request.param}")
    _tables(str(root), request.param)
    return str(root)


@pytest.mark.parametrize("key", KEYS)
def test_fuzz_matches_oracle(spark, fuzz_dir, key):
    r = compare(spark, fuzz_dir, key, E.queries()[key], E.oracle_sql()[key], duck(fuzz_dir))
    assert r["cols_match"] and r["spark_rows"] == r["oracle_rows"] and r["hash_match"], r
