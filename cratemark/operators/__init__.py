"""Operators: functions from DataFrames to DataFrames. None of them runs a job."""

from .attach import attach_features
from .browse import browse, in_category, in_playlist
from .classify import category_domain, classify
from .combine import combine
from .features import feature_outcomes, feature_rows, rejected_documents
from .tracks import playlist_items, track_outcomes, track_rows
from .worklist import fetch_worklist

__all__ = [
    "attach_features",
    "browse",
    "category_domain",
    "classify",
    "combine",
    "feature_outcomes",
    "feature_rows",
    "fetch_worklist",
    "in_category",
    "in_playlist",
    "playlist_items",
    "rejected_documents",
    "track_outcomes",
    "track_rows",
]
