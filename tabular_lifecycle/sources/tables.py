"""Catalog tables, Parquet files and small local literals."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or view by its name."""
    return spark.table(name)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def local_rows(
    spark: SparkSession, rows: Iterable, schema: T.StructType | str | None = None
) -> DataFrame:
    """A table from a few driver-side records: tuples under a schema, or dicts with inferred types."""
    return spark.createDataFrame(list(rows), schema=schema)
