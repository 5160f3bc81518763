"""Daily AIS position files (CSV, optionally zstd-compressed) -> typed DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vesseltrack.schemas import AIS_SCHEMA

# Text cells that pandas' CSV reader turns into a missing value by
# default. The ingest must treat them the same way, including in text columns.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


TEXT_SCHEMA = T.StructType([T.StructField(f.name, T.StringType()) for f in AIS_SCHEMA])
# Columns compared with the missing tokens after trimming; text columns keep blanks as data.
NUMERIC = {f.name for f in AIS_SCHEMA.fields if not isinstance(f.dataType, T.StringType)}


def with_csv_options(reader):
    """The options of every AIS scan, batch or stream: all columns as text, the header checked against the schema."""
    return (reader.schema(TEXT_SCHEMA).option("header", True).option("enforceSchema", False)
            .option("mode", "PERMISSIVE"))


def source_file_name() -> Column:
    # the text after the last slash, looked for from the end: a pattern would try every letter of the folders, for each row
    return F.substring_index(F.col("_metadata.file_path"), "/", -1)


def read_ais(spark: SparkSession, paths: str | Sequence[str], source_file: bool = True, spread: int = 0) -> DataFrame:
    """Scan daily position files with the declared schema.

    Files are read by Spark's CSV source in parallel (``.zst`` is decoded by the
    Hadoop codec; a compressed file is a single split, so one day is one scan
    task; with ``spread`` the text rows of a file are dealt out to that many
    tasks before they are typed and written). Every column is read as
    text first so that pandas-style missing tokens can be nulled before the
    cast; unparsable numbers and timestamps become null instead of failing the
    file. A header whose names or order differ from the schema fails the read.
    With ``source_file`` the file's base name is kept as ``_source_file``.
    """
    if isinstance(paths, str):
        paths = [paths]
    raw = with_csv_options(spark.read).csv(list(paths))
    extra = []
    if source_file or spread:
        raw = raw.select(*TEXT_SCHEMA.names, source_file_name().alias("_source_file"))
        extra = ["_source_file"] if source_file else []
    if spread:
        raw = raw.repartition(F.col("_source_file"), F.pmod(F.hash("mmsi", "base_date_time"), F.lit(spread)))
    return typed_ais(raw, *extra)


def typed_ais(raw: DataFrame, *extra: str | Column) -> DataFrame:
    """All-text AIS columns cast to the declared schema, missing tokens nulled; ``extra`` columns are kept.

    Text is read in a step of its own: the test for integers looks at a number
    three times, and the text under it would be trimmed and parsed each time.
    """
    kinds = {f.name: f.dataType for f in AIS_SCHEMA}
    read, cols = [], []
    for name, kind in kinds.items():
        c = normalise_missing(F.col(name), trimmed=name in NUMERIC)
        out = F.col(name)
        if isinstance(kind, T.TimestampType):
            c = F.try_to_timestamp(c, F.lit(TIMESTAMP_FORMAT))
        elif isinstance(kind, T.IntegerType):
            c = c.try_cast("double")
            # Integral text only; a fractional value is null rather than a failed file.
            out = F.when(out == F.floor(out), out.try_cast("int")).alias(name)
        elif isinstance(kind, T.DoubleType):
            c = nan_to_null(c.try_cast("double"))
        read.append(c.alias(name))
        cols.append(out)
    kept = raw.select(*read, *extra)
    return kept.select(*cols, *kept.columns[len(cols):])


def normalise_missing(c: Column, trimmed: bool = True) -> Column:
    """Null the pandas default missing tokens, keep other text; text columns are compared untrimmed."""
    return F.when(~(F.trim(c) if trimmed else c).isin(NA_TOKENS), c)


def nan_to_null(c: Column) -> Column:
    """NaN compares greater than every number in Spark; treat it as missing instead."""
    return F.nanvl(c, F.lit(None).cast("double"))


def with_lineage(df: DataFrame, source_file: Column | str | None = None,
                 ingestion_ts: Column | None = None) -> DataFrame:
    """Add ``_ingestion_ts`` (now, one value per query) and ``_source_file``."""
    if isinstance(source_file, str):
        source_file = F.lit(source_file)
    out = df.withColumn("_ingestion_ts", ingestion_ts if ingestion_ts is not None
                        else F.current_timestamp())
    if source_file is not None:
        out = out.withColumn("_source_file", source_file)
    # keep lineage columns last, in their fixed order
    lineage = [c for c in ("_ingestion_ts", "_source_file") if c in out.columns]
    rest = [c for c in out.columns if c not in lineage]
    return out.select(*rest, *lineage)
