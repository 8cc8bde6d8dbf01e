"""Playlist documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.documents import in_brackets, is_text
from ..schemas import PLAYLIST

FILE_NAME_ID = r"^playlist_(.+?)\.json(?:\.gz)?$"


def _id_in_file_name() -> Column:
    name = F.regexp_extract(F.col("_metadata.file_name"), FILE_NAME_ID, 1)
    return F.nullif(name, F.lit(""))


def playlists(
    spark: SparkSession,
    path: str | list[str],
    *,
    lines: bool = False,
    id_from: str = "document",
    malformed: str = "fail",
) -> DataFrame:
    """Columns ``playlist_id``, ``items`` and ``value``, the text; one row per
    document.

    ``path`` may be a file, a folder, a glob or a list of them; ``*.gz`` files
    are decompressed by the reader. By default each file is one document,
    however it is laid out. ``lines=True`` reads one document per line, which
    Spark can split and which suits large volumes. Blank lines and
    empty files, compressed or not, are nothing.

    The id comes from the ``playlist_id`` key of the ``document``, from a
    ``file_name`` like ``playlist_<id>.json``, or from a ``folder`` like
    ``playlist_id=<id>``; selecting one such folder reads only that folder.

    Text that is not exactly one document, or has other types than a playlist,
    fails the job. With ``malformed="skip"`` its ``items`` are null, and
    ``rejected_playlists`` shows it.
    """
    if id_from not in ("document", "file_name", "folder"):
        raise ValueError(f"id_from must be document, file_name or folder, not {id_from!r}")
    if malformed not in ("fail", "skip"):
        raise ValueError(f"malformed must be fail or skip, not {malformed!r}")
    schema = "value string" + (", playlist_id string" if id_from == "folder" else "")
    texts = spark.read.schema(schema).text(path, wholetext=not lines)
    texts = texts.where(is_text(F.col("value"), lines))
    outer_id = {
        "document": F.lit(None).cast("string"),
        "file_name": _id_in_file_name(),
        "folder": F.col("playlist_id"),
    }[id_from]
    text = F.col("value")
    parsed, one = _strictly(text) if malformed == "fail" else _leniently(text)
    found = F.col("document.playlist_id") if id_from == "document" else F.col("outer_id")
    return (
        texts.select("value", outer_id.alias("outer_id"), parsed.alias("parsed"))
        .select("value", "outer_id", F.explode(one).alias("document"))
        .select(found.alias("playlist_id"), "document.items", "value")
    )


# Below: what parses a text, and what makes an array with its one document of the
# column ``parsed``. The generator tests its input, as a filter would parse every
# document a second time.


def _strictly(text: Column) -> tuple[Column, Column]:
    """As it is, the JSON parser would take the first document of a text and
    ignore what follows. Within brackets it cannot."""
    documents = F.from_json(
        in_brackets(text), f"array<{PLAYLIST.simpleString()}>", {"mode": "FAILFAST"}
    )
    failure = F.raise_error("not one playlist document; rejected_playlists() finds it")
    return documents, F.when(F.size("parsed") == 1, F.col("parsed")).otherwise(failure)


def _leniently(text: Column) -> tuple[Column, Column]:
    """The same, with a null in place of a document that cannot be read."""
    whole = F.concat(F.lit('{"documents":['), text, F.lit("]}"))
    schema = f"struct<documents:array<{PLAYLIST.simpleString()}>,_broken:string>"
    read = F.from_json(whole, schema, {"columnNameOfCorruptRecord": "_broken"})
    good = F.col("parsed._broken").isNull() & (F.size("parsed.documents") == 1)
    nothing = F.array(F.lit(None).cast(PLAYLIST))
    return read, F.when(good, F.col("parsed.documents")).otherwise(nothing)


def rejected_playlists(documents: DataFrame) -> DataFrame:
    """The texts without items, which ``playlist_items(malformed="skip")`` passes
    over: ``playlist_id``, as far as it is known, and ``value``."""
    return documents.where(F.col("items").isNull()).select("playlist_id", "value")
