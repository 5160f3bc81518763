"""Sanctions bulk file: newline-delimited JSON entities -> one row per vessel entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vesseltrack.schemas import ENTITY_SCHEMA, SANCTIONS_COLUMNS

# Entity type kept, property names read, list separator.
VESSEL_SCHEMA_NAME = "Vessel"
PROPERTY_COLUMNS = {
    "entity_name": "name",
    "mmsi": "mmsi",
    "imo_number": "imoNumber",
    "flag": "flag",
    "designation_date": "startDate",
}
DATASET_SEPARATOR = ", "


def read_sanctions(spark: SparkSession, path: str) -> DataFrame:
    """Read entity lines; blank lines are skipped, a malformed line fails the read."""
    entities = (spark.read.schema(ENTITY_SCHEMA)
                .option("mode", "FAILFAST")
                .json(path))
    return flatten_entities(entities)


def parse_entity_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Parse a column of JSON entity lines (e.g. from ``spark.read.text``) and flatten.

    Blank lines are dropped; a line that is not a JSON object fails the query,
    like the file reader in FAILFAST mode.
    """
    text = F.col(column)
    non_blank = lines.where(F.trim(text) != "")
    parsed = non_blank.select(
        F.from_json(text, ENTITY_SCHEMA, {"mode": "FAILFAST"}).alias("e"))
    return flatten_entities(parsed.select("e.*"))


def _first(prop: str) -> Column:
    # first element of the property's value list; a missing key or an empty list -> null
    return F.get(F.col("properties")[prop], 0)


def flatten_entities(entities: DataFrame) -> DataFrame:
    """Keep vessels; first value of each property; datasets joined with ', '."""
    vessels = entities.where(F.col("schema") == VESSEL_SCHEMA_NAME)
    cols = {"entity_id": F.col("id")}
    for out, prop in PROPERTY_COLUMNS.items():
        cols[out] = _first(prop)
    cols["sanctions_list"] = F.array_join(
        F.coalesce(F.col("datasets"), F.array().cast("array<string>")), DATASET_SEPARATOR)
    return vessels.select(*[cols[c].alias(c) for c in SANCTIONS_COLUMNS])
