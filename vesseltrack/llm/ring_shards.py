"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``vnodes`` places on a ring of 2^32 positions; a row's key (its
id, and a copy number where whole rows repeat) hashes to a position and belongs
to the next place clockwise. A shard takes no more rows than its bound; what a
full shard cannot take goes on clockwise to the next place of a shard with
room. With bounds that add up to the number of rows (the default: n // shards,
one more for the first n % shards) counts differ by one at most, whatever the
hash does; looser bounds (``slack``) keep more rows at home. Rows of one arc
are ordered by hash and id; the first ones stay at home, so a few more rows or
a changed bound move rows near the bounds only.

Distributed without walking the rows one by one: rows are counted per arc;
only these counts (shards x vnodes numbers, a bound set by the parameters) are
walked clockwise, which gives for every arc the ranks that each shard takes. A
row finds its rank in its arc from the offset of its cell (arcs are cut into
cells of about ``cell_rows`` rows, so no sort group grows with the data) and
its row number there.

Law ``rows`` holds (counts at most one apart). Equal texts are not kept
together: balance of counts comes first.

Edge cases: null ids are one key (spread by text size, checksum and copy
number); repeated rows are numbered and spread like different ones; null texts
have size 1 and checksum 0; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vesseltrack.session import materialize

RING = 1 << 32
VNODES = 64
CELL_ROWS = 20_000


def ring(spark, shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(position, shard) of the places, ascending. A place hashes its shard and number only, so shards may be added."""
    at = F.pmod(F.xxhash64(F.lit("place"), "shard", "place"), F.lit(RING))
    rows = spark.range(shards).select(F.col("id").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(vnodes - 1))).alias("place"))
    found = rows.select(at.alias("at"), "shard").groupBy("at").agg(F.min("shard").alias("shard"))
    return sorted((r["at"], r["shard"]) for r in found.collect())


def bounds(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """The most rows of each shard; ``slack`` 0.25 allows a quarter over the mean."""
    if slack:
        return [-(-int(rows * (1 + slack) * 1000) // (1000 * shards)) + 1] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def walk(places: list[tuple[int, int]], counts: dict[int, int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, rank after the last, shard, slot of the first), from the counts of the arcs."""
    room, used, out, left = list(room), [0] * len(room), [], {}

    def put(arc: int, shard: int, first: int, n: int) -> int:
        n = min(n, room[shard])
        if n:
            out.append((arc, first, first + n, shard, used[shard]))
            room[shard] -= n
            used[shard] += n
        return n

    for arc, (_, shard) in enumerate(places):  # home first
        n = counts.get(arc, 0)
        took = put(arc, shard, 0, n)
        if took < n:
            left[arc] = took
    for arc, first in left.items():  # the rest goes on clockwise
        n = counts[arc]
        for step in range(1, len(places)):
            first += put(arc, places[(arc + step) % len(places)][1], first, n - first)
            if first == n:
                break
    return out


def _arc(position: Column, places: list[tuple[int, int]]) -> Column:
    """Number of the first place at or after the position; past the last place the first one."""
    ends = F.array(*[F.lit(p) for p, _ in places])
    i = F.aggregate(F.sequence(F.lit(1), F.lit(len(places).bit_length())),  # binary search
                    F.struct(F.lit(0).alias("lo"), F.lit(len(places)).alias("hi")),
                    lambda s, _: F.when(s["lo"] >= s["hi"], s).otherwise(
                        F.when(F.get(ends, F.floor((s["lo"] + s["hi"]) / 2).cast("int")) < position,
                               F.struct((F.floor((s["lo"] + s["hi"]) / 2) + 1).cast("int").alias("lo"), s["hi"].alias("hi")))
                        .otherwise(F.struct(s["lo"].alias("lo"), F.floor((s["lo"] + s["hi"]) / 2).cast("int").alias("hi")))),
                    lambda s: s["lo"])
    return F.when(i >= len(places), F.lit(0)).otherwise(i)


def shard_rows(docs: DataFrame, shards: int = 16, vnodes: int = VNODES, slack: float = 0.0,
               cell_rows: int = CELL_ROWS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    places = ring(spark, shards, vnodes)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    # equal rows are counted first (and map-side), then numbered: one repeated row never is a group of rows
    rows = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    rows = rows.select("doc_id", "size", "text_crc32", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy"))
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("size", "text_crc32")).otherwise(F.lit(0).cast("long"))
    key = F.xxhash64(F.lit("row"), "doc_id", "copy", spread)
    rows = materialize(rows.withColumn("key", key), "ring-rows")
    position = F.pmod("key", F.lit(RING))
    rows = rows.withColumn("position", position)
    total = rows.count()
    per_arc = max(1, -(-total // (cell_rows * len(places))))
    # a cell is a slice of the ring within one arc, ascending with the position
    rows = rows.withColumn("arc", _arc(F.col("position"), places)).withColumn(
        "cell", F.floor(F.pmod(F.col("position") - F.get(F.array(*[F.lit(p) for p, _ in places]), F.col("arc")) - 1,
                               F.lit(RING)) * per_arc * len(places) / RING).cast("long"))
    in_cell = rows.groupBy("arc", "cell").agg(F.count("*").alias("n"))
    counts = {r["arc"]: r["n"] for r in in_cell.groupBy("arc").agg(F.sum("n").alias("n")).collect()}
    taken = walk(places, counts, bounds(total, shards, slack))
    before = Window.partitionBy("arc").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = in_cell.select("arc", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    by_key = Window.partitionBy("arc", "cell").orderBy("position", "key", "doc_id", "size", "text_crc32", "copy")
    ranked = rows.withColumn("r", F.row_number().over(by_key) - 1).join(offsets, ["arc", "cell"]).withColumn(
        "rank", F.col("offset") + F.col("r"))
    plan = spark.createDataFrame(taken, "arc int, first long, stop long, shard int, base long").groupBy("arc").agg(
        F.collect_list(F.struct("first", "stop", "shard", "base")).alias("taken"))
    # at most shards x vnodes rows: a bound set by the parameters
    hit = F.get(F.filter("taken", lambda t: (t["first"] <= F.col("rank")) & (F.col("rank") < t["stop"])), F.lit(0))
    return ranked.join(F.broadcast(plan), "arc").withColumn("to", hit).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("to")["shard"].cast("int").alias("shard"),
        (F.col("to")["base"] + F.col("rank") - F.col("to")["first"]).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
