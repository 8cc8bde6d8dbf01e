"""The whole job into a store: all of its tables become current in one step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import (
    attach_features,
    classify,
    feature_outcomes,
    feature_rows,
    in_playlist,
    playlist_items,
    track_outcomes,
    track_rows,
)
from ..schemas import FEATURES, TRACKS
from ..session import PARTITION_BYTES, partitions_for
from ..store import Manifest, Store
from ..store.manifest import Entry
from ..store.tables import new_run

TRACK_TABLE, FEATURE_TABLE = "tracks", "audio_features"
RESULT_TABLE, REJECT_TABLE = "categorized_tracks", "rejected_documents"
REJECTED = T.StructType([T.StructField(name, T.StringType()) for name in ("kind", "value")])


def publish(
    spark: SparkSession,
    playlists: DataFrame,
    documents: DataFrame,
    store: Store,
    *,
    run: str | None = None,
    playlist_id: str | None = None,
    malformed: str = "fail",
    result_mode: str = "overwrite",
    partition_by: str | None = None,
    compact: bool = False,
    partition_bytes: int = PARTITION_BYTES,
) -> Manifest:
    """What ``refresh`` does, with a version of ``store`` for its outcome: tables
    ``tracks``, ``audio_features``, ``categorized_tracks`` and ``rejected_documents``
    (kind, playlist or feature, and value).

    All four change together, in one manifest. A reader sees all tables of one run
    or all of another, and there is no moment without them. A run that fails changes
    nothing.

    With ``malformed="skip"`` a scan of the documents writes both what they give
    and the texts of those that cannot be used, so that each is parsed once;
    ``playlists`` has to be read with the same option. Otherwise there are none, as
    the job fails.

    A ``run`` that has a name can be repeated. If it is through, nothing happens,
    so that ``result_mode="append"`` adds its rows once. If it failed after the base
    tables were stored, these are taken as they are and no document is read again.
    The number of partitions of the join is chosen as in ``refresh``.
    """
    if malformed not in ("fail", "skip"):
        raise ValueError(f"malformed must be fail or skip, not {malformed!r}")
    if result_mode not in ("overwrite", "append"):
        raise ValueError(f"result_mode must be overwrite or append, not {result_mode!r}")
    current = store.current()
    if run is not None and current.has(run, RESULT_TABLE):
        return current
    stored = None if run is None else store.staged(run)
    if stored is None:
        by = run or new_run()
        write = _with_rejects if malformed == "skip" else _without_rejects
        stored = write(store, playlists, documents, by, playlist_id, compact)
        if run is not None:
            stored = store.stage(run, stored)
    else:
        by = run

    tracks, features = stored[TRACK_TABLE], stored[FEATURE_TABLE]
    with partitions_for(spark, *store.paths(tracks, features), partition_bytes=partition_bytes):
        joined = attach_features(store.rows(tracks), classify(store.rows(features)))
        result = store.write(RESULT_TABLE, joined, by, partition_by=partition_by)

    def change(manifest: Manifest) -> Manifest:
        if manifest.has(by, RESULT_TABLE):
            return manifest
        for name, entry in stored.items():
            manifest = manifest.replaced(by, name, entry)
        added = Manifest.appended if result_mode == "append" else Manifest.replaced
        return added(manifest, by, RESULT_TABLE, result)

    done = store.commit(change)
    if run is not None:
        store.unstage(run)
    return done


def _without_rejects(store, playlists, documents, run, playlist_id, compact) -> dict[str, Entry]:
    chosen = playlists if playlist_id is None else in_playlist(playlists, playlist_id)
    tracks, features = track_rows(playlist_items(chosen)), feature_rows(documents)
    return {
        TRACK_TABLE: store.write(TRACK_TABLE, tracks, run, compact=compact),
        FEATURE_TABLE: store.write(FEATURE_TABLE, features, run, compact=compact),
        REJECT_TABLE: Entry(REJECTED.json(), "parquet", ()),
    }


def _with_rejects(store, playlists, documents, run, playlist_id, compact) -> dict[str, Entry]:
    """Each scan's rows go to a folder of their outcome."""
    chosen = playlists
    if playlist_id is not None:
        # A document that cannot be read may be any playlist's.
        unknown = F.col("items").isNull() & F.col("playlist_id").isNull()
        chosen = playlists.where((F.col("playlist_id") == playlist_id) | unknown)
    entries, rejects = {}, ()
    for name, kind, schema, outcomes in (
        (TRACK_TABLE, "playlist", TRACKS, track_outcomes(chosen)),
        (FEATURE_TABLE, "feature", FEATURES, feature_outcomes(documents)),
    ):
        both = outcomes.withColumn("kind", F.lit(kind))
        written = store.write(name, both, run, partition_by="outcome", compact=compact)
        entries[name] = store.narrowed(written, schema, "outcome=row")
        rejects += store.narrowed(written, REJECTED, "outcome=rejected").parts
    return {**entries, REJECT_TABLE: Entry(REJECTED.json(), "parquet", rejects)}
