"""Lags and running sums along a key's time axis without one task for a key.

As in the timeline, time is cut into buckets: the window functions run within
(key, bucket), and what a bucket needs of the ones before comes from a table of
one row per key and bucket, over which a second window runs. Any bucket width
gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400


def bucketed(rows: DataFrame, at: str, seconds: int = DAY) -> DataFrame:
    return rows.withColumn("_bucket", F.expr(f"unix_seconds({at}) div {seconds}"))


def with_previous(rows: DataFrame, keys: list[str], at: str, columns: list[str], seconds: int = DAY) -> DataFrame:
    """``rows`` and a struct ``prev`` of the columns of the key's row before (null for the first). ``at`` is unique within a key."""
    rows = bucketed(rows, at, seconds)
    held = F.struct(*columns)
    tails = rows.groupBy(*keys, "_bucket").agg(F.max_by(held, F.col(at)).alias("_tail"))
    before = tails.withColumn("_before", F.lag("_tail").over(Window.partitionBy(*keys).orderBy("_bucket"))).drop("_tail")
    w = Window.partitionBy(*keys, "_bucket").orderBy(at)
    return _joined(rows, before, keys).withColumn("prev", F.coalesce(F.lag(held).over(w), "_before")).drop("_bucket", "_before")


def with_running_sum(rows: DataFrame, keys: list[str], at: str, value: str, name: str, seconds: int = DAY) -> DataFrame:
    """``rows`` and the sum of ``value`` over the key's rows up to and with each. ``at`` is unique within a key."""
    rows = bucketed(rows, at, seconds)
    totals = rows.groupBy(*keys, "_bucket").agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.withColumn("_before", F.coalesce(F.sum("_total").over(earlier), F.lit(0))).drop("_total")
    w = Window.partitionBy(*keys, "_bucket").orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return _joined(rows, before, keys).withColumn(name, F.col("_before") + F.sum(value).over(w)).drop("_bucket", "_before")


def _joined(rows: DataFrame, before: DataFrame, keys: list[str]) -> DataFrame:
    """Join on (key, bucket), null keys included."""
    side = before.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_bucket").alias("_kb"), "_before")
    on = F.col("_bucket") == F.col("_kb")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return rows.join(side, on).drop("_kb", *[f"_k{i}" for i in range(len(keys))])
