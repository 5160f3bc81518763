"""Adapters from the driver's test tables to this library's inputs.

The test tables carry no positions, so ``events`` is mapped to AIS pings and
``supplier`` to sanctions entities with integer arithmetic that Spark and DuckDB
evaluate identically (``vesseltrack.oracle`` holds the SQL twin of each view).

events (event_id, ts, user_id, event_type, value, props) -> ais_raw:
  one ping per event; events with event_id % 50 = 0 are ingested twice
  (identical rows, the second copy newer); user_id % 17 = 0 gives an invalid
  MMSI class ('99...'); event_id % 97 = 0 an invalid latitude; about 12 % of
  the values are above the 102.2 kn speed ceiling.
supplier (s_suppkey, s_name, s_nationkey, s_acctbal) -> sanctions:
  even keys carry a name that matches the vessel after normalisation
  ('Vessel 4' ~ 'VESSEL-4'), odd keys a different name (MMSI-only hit);
  keys % 13 = 0 have no MMSI; keys % 10 = 3 get a second entity on the same
  MMSI (join fan-out).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vesseltrack.schemas import BRONZE_AIS_COLUMNS, SANCTIONS_COLUMNS
from vesseltrack.session import pin_utc

# Fixed values of the adapter (shared with the SQL twin in vesseltrack.oracle).
INGEST_TS_FIRST = "2024-02-01 00:00:00"
INGEST_TS_SECOND = "2024-02-02 00:00:00"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def mmsi_from_key(key: Column) -> Column:
    """Deterministic 9-character vessel id from an integer key."""
    return (F.when(key % 17 == 0, F.concat(F.lit("99"), F.lpad(key.cast("string"), 7, "0")))
             .otherwise((F.lit(200000000) + (key * 3333333) % 599999999).cast("string")))


# Fixed value: the shared placeholder id of the hot-key variant.
PLACEHOLDER_MMSI = "000000001"


def ais_raw_from_events(spark: SparkSession, sf_dir: str, hot: bool = False) -> DataFrame:
    """bronze ais_raw view over ``events`` (17 AIS columns + lineage).

    With ``hot`` every vessel with user_id % 3 = 0 transmits the same
    placeholder MMSI, so one id holds about a third of all pings.
    """
    pin_utc(spark)
    ev = load(spark, sf_dir, "events")
    eid, uid = F.col("event_id"), F.col("user_id")
    # every event once (seq 1); every 50th event a second time (seq 2, newer copy)
    copies = ev.withColumn(
        "seq", F.explode(F.sequence(F.lit(1), F.when(eid % 50 == 0, 2).otherwise(1))))
    vessel_type = (F.when(uid % 4 == 0, 80 + uid % 10)
                    .when(uid % 4 == 1, F.lit(30))
                    .when(uid % 4 == 2, 70 + uid % 10)
                    .otherwise(F.lit(37))).cast("int")
    mmsi = mmsi_from_key(uid)
    if hot:
        mmsi = F.when(uid % 3 == 0, F.lit(PLACEHOLDER_MMSI)).otherwise(mmsi)
    cols = {
        "mmsi": mmsi,
        "base_date_time": F.col("ts").cast("timestamp"),
        "longitude": F.lit(-80) + ((eid * 61) % 1000) / 100,
        "latitude": F.when(eid % 97 == 0, F.lit(95.0).cast("double"))
                     .otherwise(F.lit(20) + ((eid * 37) % 1000) / 100),
        "sog": F.when((F.col("event_type") == "signup") & (eid % 2 == 0), F.lit(None).cast("double"))
                .otherwise(F.col("value")),
        "cog": ((eid * 7) % 3600) / 10,
        "heading": F.when(eid % 11 == 0, F.lit(None)).otherwise((eid * 13) % 360).cast("int"),
        "vessel_name": F.concat(F.lit("VESSEL-"), uid.cast("string")),
        "imo": (F.when(uid % 5 == 0, F.lit(None).cast("string"))
                 .when(uid % 5 == 1, F.lit("IMO0000000"))
                 .otherwise(F.concat(F.lit("IMO"), (F.lit(9000000) + uid).cast("string")))),
        "call_sign": F.concat(F.lit("CS"), uid.cast("string")),
        "vessel_type": vessel_type,
        "status": (eid % 16).cast("int"),
        "length": (F.lit(20) + (uid * 7) % 300).cast("int"),
        "width": (F.lit(2) + (uid * 3) % 50).cast("int"),
        "draft": ((eid * 3) % 200) / 10,
        "cargo": F.when(eid % 7 == 0, F.lit(30)).otherwise(vessel_type).cast("int"),
        "transceiver": F.when(uid % 3 == 0, F.lit("B")).otherwise(F.lit("A")),
        "_ingestion_ts": F.when(F.col("seq") == 1, F.lit(INGEST_TS_FIRST))
                          .otherwise(F.lit(INGEST_TS_SECOND)).cast("timestamp"),
        "_source_file": F.concat(F.lit("ais-"), F.to_date(F.col("ts")).cast("string"),
                                 F.lit(".csv.zst")),
    }
    return copies.select(*[cols[c].alias(c) for c in BRONZE_AIS_COLUMNS])


def sanctions_from_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bronze sanctions view over ``supplier``."""
    sup = load(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    # second entity for keys % 10 = 3 (same MMSI, other name)
    copies = sup.withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.when(key % 10 == 3, 2).otherwise(1))))
    first = F.col("copy") == 1
    name = (F.when(~first, F.concat(F.lit("Shadow "), F.col("s_name")))
             .when(key % 2 == 0, F.concat(F.lit("Vessel "), key.cast("string")))
             .otherwise(F.col("s_name")))
    cols = {
        "entity_id": F.concat(F.lit("E"), key.cast("string"),
                              F.when(~first, F.lit("-2")).otherwise(F.lit(""))),
        "entity_name": name,
        "mmsi": F.when(key % 13 != 0, mmsi_from_key(key)),
        "imo_number": F.concat(F.lit("IMO"), (F.lit(9000000) + key).cast("string")),
        "flag": F.col("s_nationkey").cast("string"),
        "sanctions_list": F.when(key % 3 == 0, F.lit("us_ofac_sdn, eu_fsf"))
                           .otherwise(F.lit("us_ofac_sdn")),
        "designation_date": F.concat(F.lit("2023-"), F.lpad(((key % 12) + 1).cast("string"), 2, "0"),
                                     F.lit("-15")),
    }
    return copies.select(*[cols[c].alias(c) for c in SANCTIONS_COLUMNS])


def entity_lines_from_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NDJSON entity lines built from ``supplier`` (one column ``value``).

    Every key gives one line; keys % 4 = 1 are not vessels ('Company'),
    keys % 7 = 0 have no mmsi property, keys % 9 = 0 an empty mmsi list,
    keys % 5 = 0 no datasets, keys % 6 = 0 two names (the first wins), and
    keys % 8 = 0 are followed by a blank line.
    """
    sup = load(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    one = lambda c: F.array(c)
    props = F.map_from_entries(F.filter(F.array(
        F.struct(F.lit("name").alias("k"),
                 F.when(key % 6 == 0, F.array(F.col("s_name"), F.lit("Alias")))
                  .otherwise(one(F.col("s_name"))).alias("v")),
        F.struct(F.lit("mmsi").alias("k"),
                 F.when(key % 9 == 0, F.array().cast("array<string>"))
                  .otherwise(one(mmsi_from_key(key))).alias("v")),
        F.struct(F.lit("imoNumber").alias("k"),
                 one(F.concat(F.lit("IMO"), (F.lit(9000000) + key).cast("string"))).alias("v")),
        F.struct(F.lit("flag").alias("k"), one(F.col("s_nationkey").cast("string")).alias("v")),
        F.struct(F.lit("startDate").alias("k"), one(F.lit("2023-06-01")).alias("v")),
    ), lambda e: ~((e["k"] == "mmsi") & (key % 7 == 0))))
    entity = F.struct(
        F.concat(F.lit("ent-"), key.cast("string")).alias("id"),
        F.when(key % 4 == 1, F.lit("Company")).otherwise(F.lit("Vessel")).alias("schema"),
        props.alias("properties"),
        F.when(key % 5 != 0, F.array(F.lit("us_ofac_sdn"), F.concat(F.lit("list_"),
               (key % 3).cast("string")))).alias("datasets"),
    )
    line = F.to_json(entity)
    lines = F.when(key % 8 == 0, F.array(line, F.lit(""))).otherwise(F.array(line))
    return sup.select(F.explode(lines).alias("value"))
