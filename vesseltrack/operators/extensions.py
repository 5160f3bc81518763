"""Further checks and reports on pings and events: per-row inconsistencies, grid aggregates,
a second sanctions join, two-tier ranking, draught changes, type-aware priority.

Per-row checks are filters on silver (pushed into the scan); grid reports are
partial aggregates per cell, so a crowded cell is summed map-side; the draught
lag runs over one row per vessel and day, which bounds a hot vessel's window by
the number of days. No self-join of pings anywhere.

Nulls: a check needs all of its columns; a ping that misses one is not reported
(identity risk excepted, which is about the missing value).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vesseltrack.operators.joins import maybe_broadcast

# Fixed values of the rules.
AT_ANCHOR, ANCHOR_SPEED = 1, 5.0
NO_IMO = "IMO0000000"
TANKERS = (80, 89)
MAX_LENGTH_TO_WIDTH = 20
HEADING_UNKNOWN, MOVING_SPEED, MAX_DIVERGENCE = 511, 3.0, 45.0
TYPE_WEIGHTS = [(8, 1.0), (7, 0.8), (3, 0.6), (6, 0.5)]  # tens of the vessel type; any other type 0.3
OTHER_WEIGHT = 0.3

PING = ["mmsi", "base_date_time"]


def anchored_but_moving(silver: DataFrame) -> DataFrame:
    """Status at anchor, speed over 5 knots."""
    return silver.where((F.col("status") == AT_ANCHOR) & (F.col("sog") > ANCHOR_SPEED)).select(*PING, "status", "sog")


def no_imo(imo: Column) -> Column:
    return F.coalesce(F.trim(imo), F.lit("")).isin("", NO_IMO)


def identity_risk(silver: DataFrame) -> DataFrame:
    """Vessels with pings that lack a usable IMO number, and how many of all their pings that is."""
    return silver.groupBy("mmsi").agg(F.count("*").alias("pings"), F.count_if(no_imo(F.col("imo"))).alias("without_imo")).where(
        "without_imo > 0")


def imo_number(imo: Column) -> Column:
    """The seven digits of a well-formed IMO number with the right check digit, else null.

    The first six digits, weighted 7 down to 2, sum to a number that ends in the
    seventh. The prefix and blanks around it are optional.
    """
    digits = F.regexp_extract(F.upper(F.trim(imo)), r"^(?:IMO)?\s*([0-9]{7})$", 1)
    weighted = sum((F.substring(digits, i + 1, 1).cast("int") * (7 - i) for i in range(6)), F.lit(0))
    return F.when((digits != "") & (digits != "0000000") & (weighted % 10 == F.substring(digits, 7, 1).cast("int")), digits)


def identity_check(silver: DataFrame) -> DataFrame:
    """Vessels by what is wrong with their IMO numbers: none given, or one that cannot be right; and how many right ones they used."""
    imo = F.col("imo")
    return silver.groupBy("mmsi").agg(
        F.count("*").alias("pings"), F.count_if(no_imo(imo)).alias("without_imo"),
        F.count_if(~no_imo(imo) & imo_number(imo).isNull()).alias("false_imo"), F.count_distinct(imo_number(imo)).alias("numbers_used")).where(
        "without_imo > 0 or false_imo > 0 or numbers_used > 1")


def tanker_on_class_b(silver: DataFrame) -> DataFrame:
    """Tanker types on a class B transceiver."""
    return silver.where(F.col("vessel_type").between(*TANKERS) & (F.col("transceiver") == "B")).select(
        *PING, "vessel_type", "transceiver")


def odd_dimensions(silver: DataFrame) -> DataFrame:
    """Longer than twenty times the width."""
    return silver.where(F.col("length") > F.col("width") * MAX_LENGTH_TO_WIDTH).select(*PING, "length", "width")


def divergence(heading: Column, cog: Column) -> Column:
    """Smallest angle between two directions, 0 to 180 degrees."""
    return F.abs((heading - cog + F.lit(540.0)) % F.lit(360.0) - F.lit(180.0))


def heading_off_course(silver: DataFrame) -> DataFrame:
    """E5: heading and course more than 45 degrees apart while under way."""
    apart = divergence(F.col("heading"), F.col("cog"))
    return silver.where((F.col("sog") >= MOVING_SPEED) & (F.col("heading") != HEADING_UNKNOWN) & (apart > MAX_DIVERGENCE)).select(
        *PING, "heading", "cog", F.round(apart, 6).alias("divergence"))


def cargo_against_type(silver: DataFrame) -> DataFrame:
    """The cargo code's group (tens) is not the vessel type's."""
    return silver.where(F.floor(F.col("cargo") / 10) != F.floor(F.col("vessel_type") / 10)).select(*PING, "vessel_type", "cargo")


def code_table(spark) -> DataFrame:
    """Type and cargo codes 20 to 99: their kind, and the hazard category where the code names one.

    Fixed values: the decades 30 and 50 hold a kind of vessel per code. In the
    others the decade is the kind and the second digit 1 to 4 a hazard category;
    0 and 5 to 9 say nothing about it. Other codes are not in use.
    """
    code = F.col("id").cast("int")
    decade, digit = F.floor(code / 10), code % 10
    return spark.range(20, 100).select(
        code.alias("code"), F.when(decade.isin(3, 5), code).otherwise(decade * 10).cast("int").alias("kind"),
        F.when(~decade.isin(3, 5) & digit.between(1, 4), digit).alias("hazard"))


def cargo_conflicts(silver: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """Pings whose cargo code does not go with the vessel type, by a table of codes: another kind, or another hazard category.

    A code that the table lacks is reported as such (verdict ``unknown code``).
    The table is broadcast after a check of its size.
    """
    codes = maybe_broadcast(codes if codes is not None else code_table(silver.sparkSession))
    of = lambda side: codes.select(F.col("code").alias(f"{side}_code"), F.col("kind").alias(f"{side}_kind"), F.col("hazard").alias(f"{side}_hazard"))
    both = (silver.where("cargo is not null and vessel_type is not null").select(*PING, "vessel_type", "cargo")
            .join(of("type"), F.col("vessel_type") == F.col("type_code"), "left").join(of("cargo"), F.col("cargo") == F.col("cargo_code"), "left"))
    verdict = (F.when(F.col("type_code").isNull() | F.col("cargo_code").isNull(), "unknown code")
               .when(F.col("type_kind") != F.col("cargo_kind"), "other kind")
               .when(F.col("type_hazard") != F.col("cargo_hazard"), "other hazard"))
    return both.select(*PING, "vessel_type", "cargo", verdict.alias("verdict")).where("verdict is not null")


def cell(lat: Column, lon: Column, size: float) -> list[Column]:
    return [F.floor(lat / F.lit(size)).cast("int").alias("cell_lat"), F.floor(lon / F.lit(size)).cast("int").alias("cell_lon")]


def area_silence(gaps: DataFrame, size: float = 1.0, min_vessels: int = 2) -> DataFrame:
    """Cells and hours in which several vessels went dark."""
    keys = [*cell(F.col("last_known_lat"), F.col("last_known_lon"), size), F.date_trunc("hour", "gap_start").alias("hour")]
    return gaps.groupBy(*keys).agg(F.count_distinct("mmsi").alias("vessels")).where(F.col("vessels") >= min_vessels)


def crowding(silver: DataFrame, size: float = 0.01, unit: str = "minute", min_vessels: int = 5) -> DataFrame:
    """Cells and minutes with many vessels."""
    keys = [*cell(F.col("latitude"), F.col("longitude"), size), F.date_trunc(unit, "base_date_time").alias("at")]
    return silver.groupBy(*keys).agg(F.count_distinct("mmsi").alias("vessels")).where(F.col("vessels") >= min_vessels)


def imo_digits(imo: Column) -> Column:
    """The number in an IMO field; null where it is missing or all zeros."""
    digits = F.regexp_replace(imo, "[^0-9]", "")
    return F.when(digits.rlike("[1-9]"), digits)


def sanctions_by_imo(silver: DataFrame, sanctions: DataFrame) -> DataFrame:
    """Vessels whose IMO number is on a sanctions entry."""
    vessels = silver.select("mmsi", imo_digits(F.col("imo")).alias("imo_key")).where("imo_key is not null").distinct()
    entries = sanctions.select(imo_digits(F.col("imo_number")).alias("imo_key"), "entity_id", "entity_name").where("imo_key is not null")
    return vessels.join(maybe_broadcast(entries), "imo_key")


def sanctions_by_checked_imo(silver: DataFrame, sanctions: DataFrame) -> DataFrame:
    """Vessels whose IMO number, right by its check digit, is on a sanctions entry. Other numbers join nothing."""
    vessels = silver.select("mmsi", imo_number(F.col("imo")).alias("imo")).where("imo is not null").distinct()
    entries = sanctions.select(imo_number(F.col("imo_number")).alias("imo"), "entity_id", "entity_name").where("imo is not null")
    return vessels.join(maybe_broadcast(entries), "imo")


def two_tier_ranking(scores: DataFrame, score: str, n: int = 20) -> DataFrame:
    """Confirmed sanctions first, then behaviour; the first ``n`` (a top-n report)."""
    return scores.orderBy(F.col("is_sanctioned").desc_nulls_last(), F.col(score).desc_nulls_last(), F.col("mmsi")).limit(n)


def draught_changes(silver: DataFrame, least: float = 2.0) -> DataFrame:
    """The last known draught of a day against that of the vessel's day before with one."""
    daily = silver.where("draft is not null and base_date_time is not null").groupBy("mmsi", "event_date").agg(
        F.max_by("draft", "base_date_time").alias("draft"))
    w = Window.partitionBy("mmsi").orderBy("event_date")
    steps = daily.withColumn("prev_draft", F.lag("draft").over(w)).withColumn("prev_date", F.lag("event_date").over(w))
    return steps.where(F.abs(F.col("draft") - F.col("prev_draft")) >= least)


def heat_map(gaps: DataFrame, jumps: DataFrame, size: float = 1.0) -> DataFrame:
    """Events per cell, at the place where they began."""
    rows = gaps.select(*cell(F.col("last_known_lat"), F.col("last_known_lon"), size), F.lit(1).alias("gap"), F.lit(0).alias("jump")).unionByName(
        jumps.select(*cell(F.col("from_lat"), F.col("from_lon"), size), F.lit(0).alias("gap"), F.lit(1).alias("jump")))
    return rows.groupBy("cell_lat", "cell_lon").agg(F.sum("gap").alias("dark_gaps"), F.sum("jump").alias("impossible_speeds"))


def disappearance_timeline(gaps: DataFrame) -> DataFrame:
    """Per day, gaps that began, vessels concerned and hours they lasted."""
    return gaps.groupBy(F.to_date("gap_start").alias("day")).agg(
        F.count("*").alias("dark_gaps"), F.count_distinct("mmsi").alias("vessels"), F.sum("gap_hours").alias("hours"))


def type_priority(events: DataFrame, silver: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """Event score times the weight of the vessel's type (its largest reported one); weights as a table."""
    spark = events.sparkSession
    weights = weights if weights is not None else spark.createDataFrame(TYPE_WEIGHTS, "type_group int, weight double")
    types = silver.groupBy("mmsi").agg(F.max("vessel_type").alias("vessel_type"))
    typed = events.join(types, "mmsi", "left").withColumn("type_group", F.floor(F.col("vessel_type") / 10).cast("int"))
    weighed = typed.join(maybe_broadcast(weights), "type_group", "left")
    score = F.col("anomaly_score").cast("double") * F.coalesce("weight", F.lit(OTHER_WEIGHT))
    return weighed.select("mmsi", "event_date", "anomaly_type", "vessel_type", F.round(score, 6).alias("priority"))
