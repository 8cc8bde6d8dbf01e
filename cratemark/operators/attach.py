"""Joining tracks with their features.

The strategy is Spark's: a broadcast if one side turns out small, else a shuffled
join. Playlists are skewed by nature, as everybody lists the same hit; adaptive
execution splits the partitions of such ids at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _with_text_key(frame: DataFrame) -> DataFrame:
    return frame.withColumn("track_id", F.col("track_id").cast("string"))


def attach_features(tracks: DataFrame, features: DataFrame) -> DataFrame:
    """Inner join on ``track_id``: the key, the track columns, the feature
    columns. Duplicates on either side multiply; null ids never match."""
    return _with_text_key(tracks).join(_with_text_key(features), "track_id", "inner")
