"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from cratemark.session import new_folder

# Bytes that a Python worker is handed at once. It holds some copies of them beside
# an executor's own, and there is a worker for each core.
BATCH_BYTES = 8 << 20


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    This cuts the lineage: a lost executor costs the reading of some files, not
    the work before them. Later actions read what was written, so that values
    such as row numbers, once given, stay.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Within, what is written reaches Python workers by ``BATCH_BYTES`` at most (and a
    row at least), unless the session asks for less."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    given = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)
    if not 0 < given <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def discard(df: DataFrame) -> None:
    """Delete the files of a table made by ``stored`` that nothing reads any more."""
    spark: SparkSession = df.sparkSession
    folders = {name.rpartition("/")[0] for name in df.inputFiles()}
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fits(df: DataFrame, row_bytes: int, most: int = 32 << 20) -> bool:
    """Whether all rows, at ``row_bytes`` each, stay below ``most`` bytes: the
    check before a broadcast. Counts no further than needed."""
    rows = most // row_bytes
    return df.limit(rows + 1).count() <= rows
