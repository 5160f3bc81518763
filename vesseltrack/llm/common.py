"""Shared helpers of the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vesseltrack.session import ship_package

# The ASCII letters that the word rules lower-case.
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by a path that Spark's reader resolves."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow`` with this package importable in the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``df`` has (compared without case), one for each of ``names``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def with_field(df: DataFrame, name: str, ddl: str) -> T.StructType:
    """The schema of ``df`` and one more struct column."""
    return T.StructType([*df.schema.fields, T.StructField(name, T.StructType.fromDDL(ddl))])


def text_bytes(text: Column) -> Column:
    """UTF-8 length of a text; null counts as empty."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
