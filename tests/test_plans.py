"""Plan shapes that the scale design relies on."""

import io
import uuid
from contextlib import redirect_stdout

import pytest

from tests.conftest import SF_SMALL
from vesseltrack.operators.clean import clean
from vesseltrack.operators.cues import anomaly_cues
from vesseltrack.operators.detect import dark_gaps, impossible_speed
from vesseltrack.operators.features import vessel_features
from vesseltrack.operators.timeline import daily_last_ping, timeline
from vesseltrack.plans import store
from vesseltrack.sources.fixtures import ais_raw_from_events, sanctions_from_supplier


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def tables(spark):
    db = f"pl{uuid.uuid4().hex[:8]}"
    c = clean(ais_raw_from_events(spark, SF_SMALL))
    store.overwrite_table(spark, c, f"{db}.ais_clean", partition_by="event_date")
    store.overwrite_table(spark, daily_last_ping(c), f"{db}.last_ping", partition_by="event_date")
    return spark.table(f"{db}.ais_clean"), spark.table(f"{db}.last_ping")


def test_dedup_trims_before_shuffle(spark):
    p = plan(clean(ais_raw_from_events(spark, SF_SMALL)))
    assert "WindowGroupLimit" in p and "Partial" in p  # top-1 per group inside each map task


def test_window_reads_only_its_partitions(tables):
    silver, lookback = tables
    w = ("2024-01-08", "2024-01-14")
    p = plan(dark_gaps(timeline(silver, w, lookback=lookback), w))
    assert "(event_date#" in p and ">= 2024-01-08" in p and "<= 2024-01-14" in p
    # the window's days, and the versions that the view names, are partition filters
    filters = [line for line in p.splitlines() if line.startswith("PartitionFilters:")]
    assert filters and all("isnotnull(event_date" in f and "_version" in f for f in filters)
    assert any(">= 2024-01-08" in f and "<= 2024-01-14" in f for f in filters)
    # column pruning: the timeline reads five columns of silver, not all 21
    reads = [line for line in p.splitlines() if line.startswith("ReadSchema:")]
    assert reads and all("_source_file" not in r and "cog" not in r for r in reads)


def test_sanctions_broadcast_and_no_cross_join(spark):
    c = clean(ais_raw_from_events(spark, SF_SMALL))
    tl = timeline(c)
    g, j = dark_gaps(tl), impossible_speed(tl)
    s = sanctions_from_supplier(spark, SF_SMALL)
    for df in (anomaly_cues(g, j, s), vessel_features(g, j, s)):
        p = plan(df)
        assert "BroadcastHashJoin" in p and "BroadcastExchange" in p
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_features_aggregate_partially(spark):
    c = clean(ais_raw_from_events(spark, SF_SMALL))
    tl = timeline(c)
    p = plan(vessel_features(dark_gaps(tl), impossible_speed(tl), sanctions_from_supplier(spark, SF_SMALL)))
    # a partial aggregate sits below the exchange of every per-vessel aggregation
    assert p.count("SortAggregate") + p.count("HashAggregate") >= 4
