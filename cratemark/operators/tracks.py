"""From playlist documents to the tracks table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import TRACK_NODE


def playlist_items(documents: DataFrame, *, malformed: str = "fail") -> DataFrame:
    """One row per playlist item that has a track: ``playlist_id``, ``position``
    in the document, and the ``track`` node. A track listed twice stays twice.

    A document without items, such as an error body, fails the job, or with
    ``malformed="skip"`` gives no rows.
    """
    if malformed not in ("fail", "skip"):
        raise ValueError(f"malformed must be fail or skip, not {malformed!r}")
    items = F.col("items")
    if malformed == "fail":
        failure = F.raise_error("a playlist document has no items")
        items = F.when(items.isNull(), failure).otherwise(items)
    return (
        documents.select("playlist_id", F.posexplode(items).alias("position", "item"))
        .select("playlist_id", "position", "item.track")
        .where(F.col("track").isNotNull())
    )


def _track_columns(track: Column) -> list[Column]:
    album = track["album"]
    return [
        track["id"].cast("string").alias("track_id"),
        album["album_type"].alias("album_type"),
        track["name"].alias("name"),
        album["release_date"].alias("release_date"),
        F.get(album["artists"], F.lit(0))["name"].alias("artist_name"),
    ]


def track_rows(items: DataFrame) -> DataFrame:
    """The five track columns. The artist is the first one of the album, null
    if it lists none."""
    return items.select(*_track_columns(F.col("track")))


def track_outcomes(documents: DataFrame) -> DataFrame:
    """What becomes of playlists that were read with ``malformed="skip"``, in one
    pass: rows of tracks, whose ``outcome`` is ``row``, and the texts of documents
    without items in ``value``, whose outcome is ``rejected``; the columns of the
    other kind are null."""
    listed = F.filter(F.transform("items", lambda item: item["track"]), lambda t: t.isNotNull())
    nothing = F.lit(None).cast(TRACK_NODE)
    rejected = F.array(outcome("rejected", _track_columns(nothing), F.col("value")))
    rows = F.transform(listed, lambda track: outcome("row", _track_columns(track)))
    one = F.explode(F.when(F.col("items").isNull(), rejected).otherwise(rows))
    return documents.select(one.alias("one")).select("one.*")


def outcome(kind: str, columns: list[Column], text: Column | None = None) -> Column:
    """One element of what the generators of outcomes unnest."""
    value = F.lit(None).cast("string") if text is None else text
    return F.struct(F.lit(kind).alias("outcome"), *columns, value.alias("value"))
