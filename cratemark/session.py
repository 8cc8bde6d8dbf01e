"""Session helpers: sensible settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Adaptive execution does the physical tuning at run time: it coalesces small
# shuffle partitions, splits skewed ones and turns joins with a small side into
# broadcasts. If every partition of a side is small, that side is hashed and the
# other one needs no sort. What it cannot do is split partitions that are all too
# large alike, so ``refresh`` sets their number from the stored bytes. Large input
# splits keep the number of map tasks, and so the driver's tables, small; small
# inputs are still split by the number of cores.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.files.maxPartitionBytes": "512MB",
    "spark.sql.session.timeZone": "UTC",
}
PARTITION_BYTES = 256 << 20
# Rows in a shuffle take about so many times the bytes of their Parquet files.
UNPACKED = 4

_local_scratch: tempfile.TemporaryDirectory | None = None


def shuffle_partitions(
    stored_bytes: int, total_cores: int, partition_bytes: int = PARTITION_BYTES
) -> int:
    """Shuffle partitions for tables of so many bytes of Parquet: about
    ``partition_bytes`` each, at least one per core."""
    return max(total_cores, -(-stored_bytes * UNPACKED // partition_bytes))


def partitions_are_set(spark: SparkSession) -> bool:
    """Whether the user has chosen a number of shuffle partitions."""
    keys = (
        "spark.sql.shuffle.partitions",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
    )
    given = spark.sparkContext.getConf()
    return any(given.contains(key) for key in keys) or spark.conf.get(keys[0]) != "200"


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes below ``paths``, from the file system's own summary."""
    total = 0
    for path in paths:
        found = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = found.getFileSystem(spark._jsc.hadoopConfiguration())
        total += files.getContentSummary(found).getLength()
    return total


@contextmanager
def partitions_for(
    spark: SparkSession, *paths: str, partition_bytes: int = PARTITION_BYTES
) -> Iterator[None]:
    """Within, shuffles have partitions for a join of the tables at ``paths``,
    unless the user has chosen their number."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    if not partitions_are_set(spark):
        cores = spark.sparkContext.defaultParallelism
        wanted = shuffle_partitions(stored_bytes(spark, *paths), cores, partition_bytes)
        spark.conf.set(key, str(wanted))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def build_session(app_name: str = "cratemark", **settings: str) -> SparkSession:
    """A session with ``SETTINGS``; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {
        **SETTINGS,
        **{k.replace("__", "."): v for k, v in settings.items()},
    }.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode session
    that leaves it unset gets a temporary folder, removed when Python exits.
    """
    global _local_scratch
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_scratch is None:
        _local_scratch = tempfile.TemporaryDirectory(
            prefix="cratemark-", ignore_cleanup_errors=True
        )
    return _local_scratch.name


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
