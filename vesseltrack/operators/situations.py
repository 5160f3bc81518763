"""Situations of several vessels or several stops: outages, crowds, port calls, zones.

* ``outages`` (E7): in which cells and when several vessels were dark at once, by
  a sweep over the ends of gaps.
* ``crowds`` (E8): vessels that lie within a distance of one another, as connected
  groups; the grid serves the search only, so its origin changes no group.
* ``port_calls``, ``draught_between_calls`` (E11): stays of a vessel in one place,
  and how its draught changed from one to the next.
* ``zones`` (E12): events per equal-area cell on all zoom levels.

Rows without a time or a position take part in none of them; a null mmsi is a
vessel of its own in the port calls and no member of a crowd.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vesseltrack.functions import haversine_nm
from vesseltrack.operators.extensions import cell
from vesseltrack.operators.runs import with_previous, with_running_sum
from vesseltrack.session import materialize

NM_PER_DEGREE = 60.0
EARTH_NM_PER_DEGREE = math.pi / 180 * 3440.065  # on the sphere of haversine_nm


def outages(gaps: DataFrame, size: float = 1.0, min_vessels: int = 2) -> DataFrame:
    """Per cell, the periods in which at least ``min_vessels`` vessels were dark at once, and the most at one time.

    A vessel counts from the start of its gap up to its end, in the cell where it
    was last seen. +1 and -1 are summed per instant first, on the map side.
    """
    known = gaps.where("last_known_lat is not null and last_known_lon is not null and gap_start < gap_end").select(
        *cell(F.col("last_known_lat"), F.col("last_known_lon"), size), "gap_start", "gap_end")
    keys = ["cell_lat", "cell_lon"]
    ends = known.select(*keys, F.explode(F.array(F.struct(F.col("gap_start").alias("at"), F.lit(1).alias("change")),
                                                 F.struct(F.col("gap_end").alias("at"), F.lit(-1).alias("change")))).alias("e"))
    steps = ends.groupBy(*keys, "e.at").agg(F.sum("e.change").alias("change")).where("change <> 0")
    dark = with_running_sum(steps, keys, "at", "change", "dark")
    enough, before = F.col("dark") >= min_vessels, F.col("dark") - F.col("change") >= min_vessels
    turns = dark.withColumn("opens", (enough & ~before).cast("int")).where(enough | before)
    periods = with_running_sum(turns, keys, "at", "opens", "period")
    return periods.groupBy(*keys, "period").agg(F.min("at").alias("began"), F.max("at").alias("ended"), F.max("dark").alias("peak")).drop("period")


def crowds(silver: DataFrame, nm: float = 0.5, unit: str = "minute", min_vessels: int = 5, origin: float = 0.0) -> DataFrame:
    """Connected groups of vessels, each within ``nm`` miles of another of the group, by their last position of a minute.

    The cells' diagonal is at most ``nm``, so vessels of one cell are connected
    without a comparison, and only whether two near cells hold a close pair is
    asked, by an equi-join with a distance test whose hits are reduced to cells on
    the map side. Vessels at the very same place are one row in that join.
    ``origin`` moves the grid; it changes no group.
    """
    side = nm / math.sqrt(2) / EARTH_NM_PER_DEGREE * 0.999
    seen = (silver.where("mmsi is not null and base_date_time is not null and latitude between -90 and 90 and longitude is not null")
            .withColumn("at", F.date_trunc(unit, "base_date_time")).groupBy("at", "mmsi")
            .agg(F.max_by(F.struct("latitude", "longitude"), "base_date_time").alias("p")).select("at", "mmsi", "p.*"))

    def row_of(lat: Column) -> Column:
        return F.floor((lat + 90 - origin) / side)

    def width(row: Column) -> Column:
        """Degrees of longitude of a row's cells: its side at the row's end that is nearer to the equator."""
        low, high = row * side - 90 + origin, (row + 1) * side - 90 + origin
        nearest = F.when((low <= 0) & (high >= 0), 0.0).otherwise(F.least(F.abs(low), F.abs(high)))
        return F.least(F.lit(360.0), side / F.greatest(F.cos(F.radians(nearest)), F.lit(1e-9)))

    def columns_in(row: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil(360.0 / width(row)))

    def column_of(lon: Column, row: Column) -> Column:
        # turned by the origin too; cells divide the circle evenly, so none is wider than ``width``
        return F.least(F.floor(F.pmod(lon + 180 - origin, F.lit(360.0)) / (360.0 / columns_in(row))), columns_in(row) - 1)

    placed = materialize(seen.withColumn("row", row_of(F.col("latitude"))).withColumn("column", column_of(F.col("longitude"), F.col("row"))), "crowd-cells")
    points = placed.select("at", "row", "column", "latitude", "longitude").distinct()

    # probes: from each point to the cells further on (same row: not the own cell) that a circle around it can touch
    reach_rows = math.ceil(nm / EARTH_NM_PER_DEGREE / side)
    to_rows = F.explode(F.sequence(F.col("row"), F.col("row") + reach_rows))
    probes = points.select("at", F.col("row").alias("from_row"), F.col("column").alias("from_column"), F.col("latitude").alias("from_lat"),
                           F.col("longitude").alias("from_lon"), to_rows.alias("row"))
    polar = F.least(F.lit(90.0), F.abs(F.col("from_lat")) + nm / EARTH_NM_PER_DEGREE)
    spread = F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.lit(nm / 3440.065)) / F.greatest(F.cos(F.radians("from_lat")), F.lit(1e-12)))))
    spread = F.when(polar >= 90, 180.0).otherwise(spread) * 1.001 + 1e-9
    step, count = 360.0 / columns_in(F.col("row")), columns_in(F.col("row"))
    turned = F.pmod(F.col("from_lon") + 180 - origin, F.lit(360.0))
    first = F.floor((turned - spread) / step)
    last = F.least(F.floor((turned + spread) / step), first + count - 1)
    probes = probes.withColumn("column", F.explode(F.sequence(first, last))).withColumn("column", F.pmod("column", count))
    probes = probes.where("row > from_row or column <> from_column")
    close = haversine_nm(F.col("from_lat"), F.col("from_lon"), F.col("latitude"), F.col("longitude")) <= nm
    touching = probes.join(points, ["at", "row", "column"]).where(close).select(
        F.struct("at", F.col("from_row").alias("row"), F.col("from_column").alias("column")).alias("a"), F.struct("at", "row", "column").alias("b")).distinct()
    labels = components(touching)
    own = F.struct("at", "row", "column")
    grouped = placed.withColumn("node", own).join(labels, "node", "left").withColumn("part", F.coalesce("part", "node"))
    return (grouped.groupBy("at", "part").agg(F.min("mmsi").alias("first_mmsi"), F.count("*").alias("vessels"), F.min("latitude").alias("south"),
                                             F.max("latitude").alias("north"), F.avg("latitude").alias("lat"))
            .where(F.col("vessels") >= min_vessels).drop("part"))


def components(edges: DataFrame) -> DataFrame:
    """node and part, the least node of its connected component, for the nodes of edges (a, b) of any orderable type.

    Each round, a node takes the least label of itself and its neighbours, and
    then that label's own label, until none changes.
    """
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "component-edges")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("part")), "component-labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("part").alias("least"))
        hooked = labels.join(near, F.col("node") == F.col("a")).select("node", F.col("part").alias("old"), F.least("part", "least").alias("part"))
        jump = labels.select(F.col("node").alias("part"), F.col("part").alias("further"))
        moved = materialize(hooked.join(jump, "part", "left").select("node", "old", F.least("part", F.coalesce("further", "part")).alias("part")),
                            "component-labels")
        if moved.where("part <> old").isEmpty():
            return moved.drop("old")
        labels = moved.drop("old")


def port_calls(silver: DataFrame, max_speed: float = 1.0, radius_nm: float = 0.5, min_hours: float = 2.0, max_silence_hours: float = 6.0) -> DataFrame:
    """Stays: unbroken runs of slow pings, none farther than ``radius_nm`` from the one before, that last ``min_hours``.

    mmsi, arrived, left, pings, lat and lon of the first ping, and the first and
    last draught reported during the stay. A run is numbered by the breaks up to it, a running sum over
    day buckets, so a stay goes on over day borders and no vessel is one task.
    """
    pings = silver.where("base_date_time is not null and latitude is not null and longitude is not null").select(
        "mmsi", "base_date_time", "latitude", "longitude", "sog", "draft")
    slow = F.coalesce(F.col("sog") <= max_speed, F.lit(False))
    stepped = with_previous(pings, ["mmsi"], "base_date_time", ["base_date_time", "latitude", "longitude"])
    far = haversine_nm(F.col("prev.latitude"), F.col("prev.longitude"), F.col("latitude"), F.col("longitude")) > radius_nm
    silent = F.unix_micros("base_date_time") - F.unix_micros("prev.base_date_time") > int(max_silence_hours * 3.6e9)
    breaks = F.when(~slow | F.coalesce(far | silent, F.lit(True)), 1).otherwise(0)
    runs = with_running_sum(stepped.withColumn("breaks", breaks).withColumn("slow", slow).drop("prev"), ["mmsi"], "base_date_time", "breaks", "run")
    at = F.col("base_date_time")
    drafted = F.when(F.col("draft").isNotNull(), at)
    stays = runs.where("slow").groupBy("mmsi", "run").agg(
        F.min(at).alias("arrived"), F.max(at).alias("left"), F.count("*").alias("pings"),
        F.min_by("latitude", at).alias("lat"), F.min_by("longitude", at).alias("lon"),
        F.min_by("draft", drafted).alias("draft_in"), F.max_by("draft", drafted).alias("draft_out"))
    return stays.where(F.unix_micros("left") - F.unix_micros("arrived") >= int(min_hours * 3.6e9)).drop("run")


def draught_between_calls(silver: DataFrame, **rules) -> DataFrame:
    """One row per two consecutive calls of a vessel: when it left and arrived, and its draught then.

    A vessel that grew lighter on the way has given cargo away at sea, one that
    grew heavier has taken some on; ``change`` is null where a draught is missing.
    """
    calls = materialize(port_calls(silver, **rules), "port-calls")  # few rows a vessel
    pairs = with_previous(calls, ["mmsi"], "arrived", ["left", "lat", "lon", "draft_out"], seconds=30 * 86_400)
    return pairs.where("prev is not null").select(
        "mmsi", F.col("prev.left").alias("left"), "arrived", F.col("prev.lat").alias("from_lat"), F.col("prev.lon").alias("from_lon"),
        F.col("lat").alias("to_lat"), F.col("lon").alias("to_lon"), F.col("prev.draft_out").alias("draft_out"), "draft_in",
        (F.col("draft_in") - F.col("prev.draft_out")).alias("change"))


def zones(gaps: DataFrame, jumps: DataFrame, levels: int = 8) -> DataFrame:
    """Level, row, column, dark_gaps, dark_hours and impossible_speeds of every cell with an event, for levels 0 to ``levels``.

    Rows divide the sine of the latitude and columns the longitude evenly, so the
    2^level x 2^level cells of a level have the same area everywhere, and a cell
    is four of the next level. Events are counted per finest cell; all levels
    come from those counts in one grouping-sets aggregation over cell prefixes.
    """
    n = 1 << levels

    def finest(lat: Column, lon: Column) -> list[Column]:
        down = F.least(F.floor((F.sin(F.radians(lat)) + 1) / 2 * n), F.lit(n - 1))
        along = F.least(F.floor((lon + 180) / 360 * n), F.lit(n - 1))
        return [down.alias("row"), along.alias("column")]

    g = gaps.where("last_known_lat is not null and last_known_lon is not null").select(
        *finest(F.col("last_known_lat"), F.col("last_known_lon")), F.lit(1).alias("g"), F.col("gap_hours").alias("h"), F.lit(0).alias("j"))
    j = jumps.where("from_lat is not null and from_lon is not null").select(
        *finest(F.col("from_lat"), F.col("from_lon")), F.lit(0).alias("g"), F.lit(0).alias("h"), F.lit(1).alias("j"))
    cells = g.unionByName(j).groupBy("row", "column").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("j").alias("j"))
    prefixes = [F.struct(F.shiftright("row", levels - k).alias("row"), F.shiftright("column", levels - k).alias("column")).alias(f"p{k}") for k in range(levels + 1)]
    names = [f"p{k}" for k in range(levels + 1)]
    by_level = cells.select("g", "h", "j", *prefixes).groupingSets([[F.col(p)] for p in names], *[F.col(p) for p in names]).agg(
        F.sum("g").alias("dark_gaps"), F.sum("h").alias("dark_hours"), F.sum("j").alias("impossible_speeds"))
    level = F.coalesce(*[F.when(F.col(p).isNotNull(), F.lit(k)) for k, p in enumerate(names)])
    place = F.coalesce(*[F.col(p) for p in names])
    return by_level.select(level.alias("level"), place["row"].alias("row"), place["column"].alias("column"), "dark_gaps", "dark_hours", "impossible_speeds")
