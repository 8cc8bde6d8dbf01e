"""What lies in a landing folder, and how to make few large files of many small ones."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.documents import is_text

FILE_BYTES = 256 << 20
# A gzip file holds about so many times its own bytes of JSON.
GZIP_RATIO = 8


# --- inventory ---------------------------------------------------------------------------

_LISTED = "path string, length bigint, modificationTime timestamp, is_folder boolean"
_ARROW = pa.schema(
    [("path", pa.string()), ("length", pa.int64()), ("modificationTime", pa.timestamp("us", "UTC")),
     ("is_folder", pa.bool_())]
)
# Schemes whose file systems tasks can open by themselves.
_SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs"}


def _pattern(glob: str | None) -> re.Pattern:
    """A name pattern with ``{a,b}`` alternatives as a regular expression."""
    found, ends = [glob or "*"], []
    while found:
        one = found.pop()
        group = re.search(r"\{([^{}]*)\}", one)
        if group is None:
            ends.append(fnmatch.translate(one))
        else:
            found += [one[: group.start()] + part + one[group.end() :] for part in group[1].split(",")]
    return re.compile("|".join(ends))


def _hidden(name: str) -> bool:
    """Names that Spark's readers pass over."""
    return (name.startswith("_") and "=" not in name) or name.startswith(".") or name.endswith("._COPYING_")


def _list_folder(folder: str, recursive: bool) -> Iterator[tuple]:
    from pyarrow import fs

    scheme, _, rest = folder.partition(":")
    # Hadoop writes file:/a, others file:///a.
    rest = "//" + rest if scheme == "file" and not rest.startswith("//") else rest
    system, at = fs.FileSystem.from_uri(f"{_SCHEMES[scheme]}:{quote(rest, safe='/:@')}")
    prefix = folder.removesuffix(at)
    waiting = [at]
    while waiting:
        for info in system.get_file_info(fs.FileSelector(waiting.pop())):
            is_folder = info.type == fs.FileType.Directory
            if _hidden(info.base_name) or (not is_folder and not info.size):
                continue
            if is_folder and recursive:
                waiting.append(info.path)
            else:
                yield prefix + info.path, info.size, info.mtime, is_folder


def _listing(recursive: bool, file_filter: str | None = None):
    """Rows of folders become rows of what is in them; rows of files stay, if their
    names are wanted."""
    wanted = _pattern(file_filter)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = [pa.array(list(c), f.type) for c, f in zip(zip(*held), _ARROW)]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, schema=_ARROW)

        for rows in batches:
            for row in rows.to_pylist():
                one = tuple(row.values())
                for found in _list_folder(one[0], recursive) if one[3] else [one]:
                    if found[3] or wanted.match(found[0].rpartition("/")[2]):
                        held.append(found)
                    if len(held) >= 10_000:
                        yield batch()
            if held:
                yield batch()

    return run


def landing_files(
    spark: SparkSession,
    path: str | list[str],
    file_filter: str | None = None,
    *,
    levels: int | None = None,
) -> DataFrame:
    """One row per file: ``path``, ``length``, ``modificationTime``. No file is opened.

    By default the listing is Spark's own, of which the driver holds all files.
    With ``levels`` tasks list the folders and no list of all files is held anywhere:
    what is found in the first ``levels`` levels is dealt out anew after each, and
    below them a task lists a folder with all that is in it. Choose it so that the
    folders there are many and none has most of the files. This takes folders, not
    patterns, of a file system that tasks can open by themselves: local, HDFS, S3 or
    Google's.

    Empty files, and names that begin with a dot or an underscore, are passed over at
    all depths, as by Spark's readers.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if levels is None:
        return _indexed(spark, paths, file_filter)
    rows = [(_qualified(spark, p), 0, None, True) for p in paths]
    found = spark.createDataFrame(rows, _LISTED)
    for _ in range(levels):
        found = found.mapInArrow(_listing(False), _LISTED).repartition(F.xxhash64("path"))
    found = found.mapInArrow(_listing(True, file_filter), _LISTED)
    found = found.where(~F.col("is_folder")).drop("is_folder")
    return found


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, for tasks to open."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = found.getFileSystem(spark._jsc.hadoopConfiguration())
    whole = found.makeQualified(system.getUri(), system.getWorkingDirectory()).toString()
    if whole.partition(":")[0] not in _SCHEMES:
        raise ValueError(f"tasks cannot list {whole}; leave levels out")
    return whole


def _indexed(spark: SparkSession, paths: list[str], file_filter: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if file_filter:
        reader = reader.option("pathGlobFilter", file_filter)
    return reader.load(paths).select("path", "length", "modificationTime")


# --- packing -----------------------------------------------------------------------------


@contextmanager
def _packed_by(spark: SparkSession, file_bytes: int) -> Iterator[None]:
    """Within, a scan's tasks get small files up to so many bytes each, and a file
    counts by its bytes alone."""
    wanted = {
        "spark.sql.files.maxPartitionBytes": str(file_bytes),
        "spark.sql.files.openCostInBytes": str(min(file_bytes >> 10, 4 << 10)),
        "spark.sql.files.minPartitionNum": "1",
        "spark.sql.files.maxPartitionNum": None,
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def pack_documents(
    spark: SparkSession,
    path: str | list[str],
    target: str,
    *,
    lines: bool = False,
    file_filter: str | None = None,
    file_bytes: int = FILE_BYTES,
    codec: str = "none",
) -> None:
    """Write landed documents, one a file, as files of one document a line, each of
    about ``file_bytes``, to the new folder ``target``; ``lines=True`` then reads them.

    Small files are put together by the scan: its tasks each get files of so many
    bytes and write one. Nothing is shuffled. The line ends of a document become
    spaces, which JSON allows wherever it allows line ends; empty files are left out.

    ``lines=True`` here means that the landed files have a document a line already.
    They are dealt out evenly, as a large ``.gz`` cannot be split otherwise: it is
    decompressed once, by one task, and what reads ``target`` has many. ``codec`` may
    be one that can be split, such as ``bzip2``, or ``none``.
    """
    reader = spark.read
    if file_filter:
        reader = reader.option("pathGlobFilter", file_filter)
    one_line = F.regexp_replace("value", r"[\r\n]+", " ").alias("value")
    if lines:
        documents = reader.text(path).where(is_text(F.col("value"), True))
        paths = [path] if isinstance(path, str) else list(path)
        sizes = _indexed(spark, paths, file_filter).select(
            F.sum(F.col("length") * F.when(F.col("path").endswith(".gz"), GZIP_RATIO).otherwise(1))
        )
        total = sizes.first()[0] or 0
        documents.repartition(max(1, -(-total // file_bytes))).write.option("compression", codec).text(target)
        return
    with _packed_by(spark, file_bytes):
        documents = reader.text(path, wholetext=True).where(is_text(F.col("value"), False))
        documents.select(one_line).write.option("compression", codec).text(target)
