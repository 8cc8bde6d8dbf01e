"""The whole job: landed documents to the categorised table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (
    attach_features,
    classify,
    feature_rows,
    in_playlist,
    playlist_items,
    rejected_documents,
    track_rows,
)
from ..session import PARTITION_BYTES, partitions_for
from ..sinks import write_table
from ..sources import features_table, rejected_playlists, tracks_table


@dataclass(frozen=True)
class Tables:
    """Where the tables of a run live."""

    tracks: str
    features: str
    result: str
    rejected: str

    @classmethod
    def under(cls, folder: str) -> Tables:
        folder = folder.rstrip("/")
        names = ("tracks", "audio_features", "categorized_tracks", "rejected_documents")
        return cls(*(f"{folder}/{name}" for name in names))


def refresh(
    spark: SparkSession,
    playlists: DataFrame,
    documents: DataFrame,
    tables: Tables,
    *,
    playlist_id: str | None = None,
    malformed: str = "fail",
    result_mode: str = "overwrite",
    partition_by: str | None = None,
    compact: bool = False,
    partition_bytes: int = PARTITION_BYTES,
) -> None:
    """Flatten both kinds of documents, classify, join and store.

    The two base tables are written and read back. So each document is parsed
    once, and a lost executor in the join costs a re-read of Parquet columns,
    not of JSON. The number of shuffle partitions of the join follows the bytes
    that were stored, at about ``partition_bytes`` each, unless the session has a
    number of its own.

    With ``malformed="skip"`` documents that cannot be used are left out, and
    stored with their texts as a fourth table, ``rejected``: kind (playlist or
    feature) and value. ``playlists`` has to be read with the same option. The
    documents are parsed once more for it.

    ``compact`` evens out the files of the base tables. A result that is
    partitioned always gets even files, and one that is not from the join.
    """
    if playlist_id is None:
        chosen, unusable = playlists, rejected_playlists(playlists)
    else:
        # A document that cannot be read may be any playlist's.
        chosen = in_playlist(playlists, playlist_id)
        unusable = rejected_playlists(playlists).where(
            F.col("playlist_id").isNull() | (F.col("playlist_id") == playlist_id)
        )
    if malformed == "skip":
        rejected = unusable.select(F.lit("playlist").alias("kind"), "value").unionByName(
            rejected_documents(documents).select(F.lit("feature").alias("kind"), "value")
        )
        write_table(rejected, tables.rejected)
    tracks = track_rows(playlist_items(chosen, malformed=malformed))
    write_table(tracks, tables.tracks, compact=compact)
    write_table(feature_rows(documents, malformed=malformed), tables.features, compact=compact)

    with partitions_for(spark, tables.tracks, tables.features, partition_bytes=partition_bytes):
        result = attach_features(
            tracks_table(spark, tables.tracks), classify(features_table(spark, tables.features))
        )
        write_table(result, tables.result, mode=result_mode, partition_by=partition_by)
