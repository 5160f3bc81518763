"""Silver cleaning: latest-copy dedup, then range validation (D3)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vesseltrack.schemas import AIS_COLUMNS

# Validity ranges of the position and speed over ground.
LAT_RANGE = (-90.0, 90.0)
LON_RANGE = (-180.0, 180.0)
SOG_RANGE = (0.0, 102.2)


def in_window(ts_or_date: Column, window) -> Column:
    """``cast(x as date) between start and end`` (Catalyst turns it into a scan range)."""
    start, end = window
    return F.to_date(ts_or_date).between(F.lit(_d(start)), F.lit(_d(end)))


def _d(x) -> date:
    return x if isinstance(x, date) else date.fromisoformat(str(x))


def dedup_latest(raw: DataFrame) -> DataFrame:
    """One row per (mmsi, base_date_time): the latest ingested copy.

    Ties on ``_ingestion_ts`` (every row of one flush shares it) are broken by
    ``_source_file`` and then by every data column, descending with nulls last,
    so the pick does not depend on the physical row order. ``row_number() = 1``
    plans as a WindowGroupLimit, which also trims each group inside every map
    task before the shuffle: a huge group of copies never reaches one task.
    """
    order = [F.col("_ingestion_ts").desc_nulls_last(), F.col("_source_file").desc_nulls_last()]
    order += [F.col(c).desc_nulls_last() for c in AIS_COLUMNS if c not in ("mmsi", "base_date_time")]
    w = Window.partitionBy("mmsi", "base_date_time").orderBy(*order)
    return (raw.withColumn("_rn", F.row_number().over(w))
               .where(F.col("_rn") == 1)
               .drop("_rn"))


def quality_flag(df: DataFrame) -> DataFrame:
    """Tag the first failing range check (lat, then lon, then sog); nulls pass."""
    lat, lon, sog = F.col("latitude"), F.col("longitude"), F.col("sog")
    flag = (F.when((lat < LAT_RANGE[0]) | (lat > LAT_RANGE[1]), F.lit("invalid_lat"))
             .when((lon < LON_RANGE[0]) | (lon > LON_RANGE[1]), F.lit("invalid_lon"))
             .when((sog < SOG_RANGE[0]) | (sog > SOG_RANGE[1]), F.lit("invalid_sog"))
             .otherwise(F.lit(None).cast("string")))
    return df.withColumn("quality_flag", flag)


def clean(raw: DataFrame, window=None) -> DataFrame:
    """bronze ais_raw -> silver ais_clean.

    With a window, only pings whose UTC date falls in [start, end] are read
    (the filter reaches the scan); without one, all history, including pings
    with an unparsable (null) timestamp. Dedup runs before validation, so an
    invalid newest copy removes the older valid one too.
    """
    src = raw
    if window is not None:
        src = src.where(in_window(F.col("base_date_time"), window))
    validated = quality_flag(dedup_latest(src))
    return (validated.where(F.col("quality_flag").isNull())
                     .withColumn("event_date", F.to_date("base_date_time")))
