"""Which feature documents a set of playlist items asks for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fetch_worklist(tracks: DataFrame, folder: str | None = None) -> DataFrame:
    """Each known ``track_id`` once, and the ``landing_path`` of its document."""
    pattern = "audio_features_%s.json"
    if folder:
        pattern = folder.rstrip("/").replace("%", "%%") + "/" + pattern
    return (
        tracks.select("track_id")
        .where(F.col("track_id").isNotNull())
        .distinct()
        .withColumn("landing_path", F.format_string(pattern, "track_id"))
    )
