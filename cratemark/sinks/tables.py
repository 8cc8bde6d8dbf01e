"""One writer for all tables and stores."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Formats that are folders of files.
FILES = ("parquet", "orc", "json", "csv", "text")


def write_table(
    frame: DataFrame,
    path: str | None = None,
    *,
    mode: str = "overwrite",
    format: str = "parquet",
    partition_by: str | None = None,
    compact: bool | None = None,
    **options: str,
) -> None:
    """Write ``frame``. ``overwrite`` is a full refresh, ``append`` adds rows.

    A table of files is written beside the one it replaces, which stays readable
    until all of it is there; then the folders change places. A write that fails
    leaves the previous table as it was. Between the two renames, for a moment,
    there is no table; a reader that has begun keeps the files it opened.

    ``format`` and ``options`` reach any store Spark has a writer for.
    ``compact`` asks for evenly sized output files: adaptive execution merges
    small partitions and splits large ones, also within one ``partition_by``
    value. It costs a shuffle. If not given, partitioned tables are compacted, as
    each task would write a file per value, and others are not.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, not {mode!r}")
    if partition_by is not None if compact is None else compact:
        frame = frame.hint("rebalance", *([partition_by] if partition_by else []))
    writer = frame.write.format(format).options(**options)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if mode == "append" or path is None or format not in FILES:
        writer.mode(mode).save(path)
        return
    mark = uuid.uuid4().hex
    fresh, old = f"{path.rstrip('/')}.new-{mark}", f"{path.rstrip('/')}.old-{mark}"
    try:
        writer.mode("errorifexists").save(fresh)
    except BaseException:
        _delete(frame.sparkSession, fresh)
        raise
    _replace(frame.sparkSession, path, fresh, old)


def _replace(spark: SparkSession, path: str, fresh: str, old: str) -> None:
    here, new, aside = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, fresh, old))
    files = here.getFileSystem(spark._jsc.hadoopConfiguration())
    there = files.exists(here)
    if there and not files.rename(here, aside):
        raise OSError(f"could not set {path} aside; the new table is in {fresh}")
    if not files.rename(new, here):
        if there:
            files.rename(aside, here)
        raise OSError(f"could not put {fresh} in the place of {path}")
    if there:
        files.delete(aside, True)


def _delete(spark: SparkSession, path: str) -> None:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)
