"""Column lists and declared types of every table and document.

All readers take these schemas explicitly: no file is opened just to infer
types, and a batch whose tempos all happen to be whole numbers still yields
doubles.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The output columns of the two base tables, in order, and the
# keys a feature document must carry to be accepted.
TRACK_COLUMNS = ("track_id", "album_type", "name", "release_date", "artist_name")
FEATURE_COLUMNS = (
    "track_id",
    "danceability",
    "energy",
    "loudness",
    "speechiness",
    "acousticness",
    "instrumentalness",
    "liveness",
    "valence",
    "tempo",
    "duration_ms",
)
REQUIRED_KEYS = FEATURE_COLUMNS[1:]

RESULT_COLUMNS = TRACK_COLUMNS + REQUIRED_KEYS + ("category",)
BROWSE_COLUMNS = ("name", "artist_name", "category")


def _strings(names) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


def _measures() -> list[T.StructField]:
    return [
        T.StructField(n, T.LongType() if n == "duration_ms" else T.DoubleType())
        for n in REQUIRED_KEYS
    ]


TRACKS = T.StructType(_strings(TRACK_COLUMNS))
FEATURES = T.StructType(_strings(["track_id"]) + _measures())
RESULT = T.StructType(_strings(TRACK_COLUMNS) + _measures() + _strings(["category"]))

# A playlist document. Only the paths that are used are declared, so the JSON
# reader skips everything else. ``release_date`` stays text because sources
# give years, months and days alike.
TRACK_NODE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField(
            "album",
            T.StructType(
                [
                    T.StructField("album_type", T.StringType()),
                    T.StructField("release_date", T.StringType()),
                    T.StructField(
                        "artists", T.ArrayType(T.StructType(_strings(["name"])))
                    ),
                ]
            ),
        ),
    ]
)
PLAYLIST = T.StructType(
    [
        T.StructField("playlist_id", T.StringType()),
        T.StructField(
            "items", T.ArrayType(T.StructType([T.StructField("track", TRACK_NODE)]))
        ),
    ]
)

# One entry of a feature document. Every measure is parsed as a double, so
# that a duration written as 210000.0 is accepted; it becomes a long later.
FEATURE_ENTRY = T.StructType(
    _strings(["id"]) + [T.StructField(n, T.DoubleType()) for n in REQUIRED_KEYS]
)
# The same with every value as text, to look at values before converting them.
FEATURE_ENTRY_TEXT = T.StructType(_strings(("id",) + REQUIRED_KEYS))
