"""Per-vessel timelines: each ping next to its predecessor (D4), skew-safe.

A plain ``lag() over (partition by mmsi order by ts)`` puts every ping of one
MMSI in one task; a placeholder MMSI shared by many transponders can hold a
third of all rows. Here the time axis is cut into buckets: ``lag`` runs within
(mmsi, bucket), and the first ping of each bucket gets, as an extra context
row, the last ping of the vessel's previous non-empty bucket. The context rows
come from a small per-(mmsi, bucket) aggregate (partial aggregation on the map
side) and a window over it that holds at most one row per bucket per vessel.
The result equals the plain lag row for row.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TIMELINE_INPUT = ["mmsi", "vessel_name", "base_date_time", "latitude", "longitude"]
TIMELINE_COLUMNS = TIMELINE_INPUT + ["prev_ts", "prev_lat", "prev_lon"]

# Default time bucket of the split lag: one hour. A (mmsi, hour) holding more
# than MAX_GROUP_ROWS pings is re-cut into fine buckets of at most that many
# microseconds: (mmsi, ts) is unique after dedup, so a fine bucket can never
# hold more rows than its width in microseconds. Any setting gives the same rows.
DEFAULT_BUCKET_SECONDS = 3600
MAX_GROUP_ROWS = 2_000_000
MAX_BROADCAST_HOT = 100_000


def _fine_width(primary_us: int, max_rows: int) -> int:
    """Largest divisor of the primary width (in microseconds) not above ``max_rows``."""
    best, d = 1, 1
    while d * d <= primary_us:
        if primary_us % d == 0:
            for c in (d, primary_us // d):
                if c <= max_rows and c > best:
                    best = c
        d += 1
    return best


def prior_ping(clean: DataFrame, before) -> DataFrame:
    """Last ping per vessel strictly before date ``before`` over all history.

    A backward as-of lookup. Aggregation (partial on the map side), so a hot
    MMSI never lands whole in one task.
    """
    b = before if isinstance(before, date) else date.fromisoformat(str(before))
    hist = (clean.where(F.col("event_date") < F.lit(b))
                 .where(F.col("base_date_time").isNotNull())
                 .select(*TIMELINE_INPUT))
    last = hist.groupBy("mmsi").agg(
        F.max_by(F.struct(*TIMELINE_INPUT[1:]), F.col("base_date_time")).alias("p"))
    return last.select("mmsi", *[F.col(f"p.{c}").alias(c) for c in TIMELINE_INPUT[1:]])


def daily_last_ping(clean: DataFrame) -> DataFrame:
    """Last ping per (vessel, day): a compact lookback table (one row per vessel-day).

    The prior ping of any window is the last row of this table before the
    window, so a windowed run reads vessel-days instead of all pings of
    history. Kept with the same replace-window writes as silver.
    """
    w = Window.partitionBy("mmsi", "event_date").orderBy(F.col("base_date_time").desc())
    return (clean.where(F.col("base_date_time").isNotNull())
                 .select("event_date", *TIMELINE_INPUT)
                 .withColumn("_rn", F.row_number().over(w))
                 .where(F.col("_rn") == 1)
                 .drop("_rn"))


def timeline_input(clean: DataFrame, window=None, lookback: DataFrame | None = None) -> DataFrame:
    """Rows that take part in the timeline: the window's pings plus one prior ping each.

    ``lookback`` is where the prior ping is searched (default: ``clean``
    itself; a :func:`daily_last_ping` table gives the same ping for less).
    """
    if window is None:
        return clean.select(*TIMELINE_INPUT)
    start, end = (x if isinstance(x, date) else date.fromisoformat(str(x)) for x in window)
    rows = (clean.where(F.col("event_date").between(F.lit(start), F.lit(end)))
                 .select(*TIMELINE_INPUT))
    return rows.unionByName(prior_ping(clean if lookback is None else lookback, start))


def timeline(clean: DataFrame, window=None, bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
             lookback: DataFrame | None = None, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Pings with ``prev_ts``, ``prev_lat``, ``prev_lon`` of the vessel's previous ping.

    The predecessor is taken as is (not IGNORE NULLS): a predecessor without a
    position gives null ``prev_lat``/``prev_lon``. Pings without a timestamp are
    left out: they sort first, so they could only ever be the predecessor of a
    vessel's first ping, which never forms an event.
    """
    rows = (timeline_input(clean, window, lookback)
            .where(F.col("base_date_time").isNotNull())
            .withColumn("_us", F.unix_micros("base_date_time")))
    bucketed, per = _with_buckets(rows, bucket_seconds * 1_000_000, max_group_rows)
    return _split_lag(bucketed, per)


def _with_buckets(rows: DataFrame, primary_us: int, max_group_rows: int) -> tuple[DataFrame, int | None]:
    """``_bucket``: a time-ordered group key per vessel with at most ``max_group_rows`` rows.

    Bucket keys count fine buckets: a normal (mmsi, primary) group takes the
    key of its first fine bucket, a hot one keeps each row's own fine bucket.
    Hot groups are found by a partial count per (mmsi, primary bucket); the
    list is broadcast when bounded, else joined by a shuffle. Returns the
    frame and, when fine buckets are in use, the fine buckets per primary one.
    """
    fine = _fine_width(primary_us, max_group_rows)
    per = primary_us // fine
    us = F.col("_us")
    primary = F.expr(f"_us div {primary_us}")
    rows = rows.withColumn("_p", primary)
    if fine >= primary_us:  # the primary width already bounds every group
        return rows.withColumn("_bucket", F.col("_p")).drop("_p", "_us"), None
    hot = (rows.groupBy("mmsi", "_p").agg(F.count(F.lit(1)).alias("_n"))
               .where(F.col("_n") > max_group_rows).select("mmsi", "_p", F.lit(True).alias("_hot")))
    n_hot = hot.limit(MAX_BROADCAST_HOT + 1).count()
    if n_hot == 0:
        return rows.withColumn("_bucket", F.col("_p") * per).drop("_p", "_us"), None
    hot = F.broadcast(hot) if n_hot <= MAX_BROADCAST_HOT else hot
    tagged = rows.join(hot, ["mmsi", "_p"], "left")
    bucket = F.when(F.col("_hot"), F.expr(f"_us div {fine}")).otherwise(F.col("_p") * per)
    return tagged.withColumn("_bucket", bucket).drop("_p", "_us", "_hot"), per


def _last_pings(df: DataFrame, keys, *extra) -> DataFrame:
    # Last ping per key. Fixed-width max/max_by keep this a hash aggregate with
    # map-side partial aggregation; (mmsi, ts) is unique after dedup, so both
    # max_by pick the same ping.
    ts = F.col("base_date_time")
    return df.groupBy(*keys).agg(
        F.max(ts).alias("base_date_time"),
        F.max_by("latitude", ts).alias("latitude"),
        F.max_by("longitude", ts).alias("longitude"),
        *extra)


def _context(last: DataFrame, partition, order: str, target: str) -> DataFrame:
    """Each row's ping as context for the next non-empty ``order`` value of its partition."""
    w = Window.partitionBy(*partition).orderBy(order)
    return (last.withColumn("_next", F.lead(target).over(w))
                .where(F.col("_next").isNotNull())
                .select("mmsi", F.col("_next").alias("_bucket"),
                        F.lit(None).cast("string").alias("vessel_name"),
                        "base_date_time", "latitude", "longitude",
                        F.lit(True).alias("_ctx")))


def _split_lag(rows: DataFrame, per: int | None = None) -> DataFrame:
    tails = _last_pings(rows, ["mmsi", "_bucket"])
    if per is None:
        # the last ping of each bucket becomes context for the vessel's next
        # non-empty bucket; the window holds one row per bucket of a vessel
        context = _context(tails, ["mmsi"], "_bucket", "_bucket")
    else:
        # fine buckets in use: two bounded levels instead of one window over
        # every fine bucket of a vessel. Within a primary bucket, fine buckets
        # chain to each other; across primary buckets, a primary bucket's last
        # ping is context for the first fine bucket of the next one.
        t = tails.withColumn("_p", F.expr(f"_bucket div {per}"))
        within = _context(t, ["mmsi", "_p"], "_bucket", "_bucket")
        hours = _last_pings(t, ["mmsi", "_p"], F.min("_bucket").alias("_first"))
        across = _context(hours, ["mmsi"], "_p", "_first")
        context = within.unionByName(across)
    body = rows.withColumn("_ctx", F.lit(False))
    both = body.unionByName(context)
    w = Window.partitionBy("mmsi", "_bucket").orderBy("base_date_time")
    lagged = (both.withColumn("prev_ts", F.lag("base_date_time").over(w))
                  .withColumn("prev_lat", F.lag("latitude").over(w))
                  .withColumn("prev_lon", F.lag("longitude").over(w)))
    return lagged.where(~F.col("_ctx")).select(*TIMELINE_COLUMNS)


def timeline_plain(clean: DataFrame, window=None) -> DataFrame:
    """Reference formulation (one window per MMSI); used by tests as the brute force."""
    rows = timeline_input(clean, window).where(F.col("base_date_time").isNotNull())
    w = Window.partitionBy("mmsi").orderBy("base_date_time")
    return (rows.withColumn("prev_ts", F.lag("base_date_time").over(w))
                .withColumn("prev_lat", F.lag("latitude").over(w))
                .withColumn("prev_lon", F.lag("longitude").over(w))
                .select(*TIMELINE_COLUMNS))
