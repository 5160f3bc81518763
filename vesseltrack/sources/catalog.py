"""Catalog reads used by window control: ingested-file listing and the watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def ingested_files(spark: SparkSession, log: str) -> DataFrame:
    """Distinct ``_source_file`` values of the load log; an empty frame if there is none.

    The log has a few rows per file; bronze itself is not read.
    """
    if not table_exists(spark, log):
        return spark.createDataFrame([], T.StructType([T.StructField("_source_file", T.StringType())]))
    return spark.table(log).select(F.col("file").alias("_source_file")).distinct()


def read_watermark(spark: SparkSession, table: str):
    """``last_end`` of the one-row state table, or None when there is no state yet."""
    if not table_exists(spark, table):
        return None
    row = spark.table(table).agg(F.max("last_end").alias("last_end")).first()
    return None if row is None else row["last_end"]
