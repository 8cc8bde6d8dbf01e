"""Looking at the result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import EVERY_CATEGORY, labels
from ..schemas import BROWSE_COLUMNS


def in_category(result: DataFrame, category: str = EVERY_CATEGORY) -> DataFrame:
    """Rows with exactly this label; ``"all"`` keeps every row. On a stored
    result the filter reaches the scan."""
    if category == EVERY_CATEGORY:
        return result
    if category not in labels():
        raise ValueError(f"unknown category {category!r}, use one of {labels()} or 'all'")
    return result.where(F.col("category") == category)


def browse(result: DataFrame, category: str = EVERY_CATEGORY) -> DataFrame:
    """Title, artist and category of the rows in a category."""
    return in_category(result, category).select(*BROWSE_COLUMNS)


def in_playlist(frame: DataFrame, playlist_id: str) -> DataFrame:
    """Rows of one playlist, for documents and items alike."""
    return frame.where(F.col("playlist_id") == playlist_id)
