"""Audio-feature documents, as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.documents import is_text

DOCUMENT_FILES = "audio_features_*.{json,json.gz}"


def feature_documents(
    spark: SparkSession,
    path: str | list[str],
    *,
    lines: bool = False,
    file_filter: str | None = None,
) -> DataFrame:
    """Column ``value`` with the text of one document per row.

    By default each file is one document and Spark packs many small files into
    a task; files not named like ``audio_features_<id>.json`` or ``.json.gz``
    are passed over unless ``file_filter`` gives another pattern.
    ``lines=True`` reads one document per line: the same rows without the cost
    of opening one file per track. An empty file, compressed or not, and a
    blank line are no documents.
    """
    if file_filter is None and not lines:
        file_filter = DOCUMENT_FILES
    reader = spark.read
    if file_filter:
        reader = reader.option("pathGlobFilter", file_filter)
    return reader.text(path, wholetext=not lines).where(is_text(F.col("value"), lines))
