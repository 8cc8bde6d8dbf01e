"""Stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import FEATURES, RESULT, TRACKS


def _table(spark: SparkSession, path: str, schema: T.StructType, declared: bool) -> DataFrame:
    if declared:
        return spark.read.schema(schema).parquet(path)
    found = spark.read.parquet(path)
    return found.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def tracks_table(spark: SparkSession, path: str, *, declared: bool = True) -> DataFrame:
    """Stored tracks. ``declared=False`` takes the types from the file and casts
    them: for tables that other tools wrote with types guessed from the data."""
    return _table(spark, path, TRACKS, declared)


def features_table(spark: SparkSession, path: str, *, declared: bool = True) -> DataFrame:
    """Stored audio features; ``declared`` as for ``tracks_table``."""
    return _table(spark, path, FEATURES, declared)


def result_table(
    spark: SparkSession, path: str | None = None, format: str = "parquet", **options: str
) -> DataFrame:
    """The categorised tracks, from Parquet or any store Spark has a reader for."""
    return spark.read.format(format).schema(RESULT).options(**options).load(path)
