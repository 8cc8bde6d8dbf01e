"""Readers for landed documents and stored tables."""

from .feature_documents import feature_documents
from .landing import landing_files, pack_documents
from .playlists import playlists, rejected_playlists
from .tables import features_table, result_table, tracks_table

__all__ = [
    "feature_documents",
    "features_table",
    "landing_files",
    "pack_documents",
    "playlists",
    "rejected_playlists",
    "result_table",
    "tracks_table",
]
