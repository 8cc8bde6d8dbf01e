"""

Queries that go through documents or stored tables write them below the shared
folder first (``cratemark.session.shared_folder``), derived from the given
tables, and return a DataFrame over what was written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import cratemark as cm
from cratemark.schemas import FEATURE_COLUMNS, RESULT_COLUMNS, TRACK_COLUMNS
from cratemark.session import new_folder
from testbed import adapter

# The operators for training data are optional: without their folder, and the
# pipeline on top of them, all other queries work as before.
try:
    import corpus_pipeline
    from cratemark.llm import queries as llm_queries
except ImportError as error:
    if error.name not in ("corpus_pipeline", "cratemark.llm", "cratemark.llm.queries"):
        raise
    corpus_pipeline = llm_queries = None

FLAGSHIP_DIR = "/root/testdata/sf0.001"


# --- classification and join ------------------------------------------------


def categorized_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = cm.classify(adapter.part_features(spark, sf_dir))
    return cm.attach_features(adapter.tracks(spark, sf_dir), features)


def _one_hit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks of which more than a third are the same one."""
    hit = F.when(F.col("l_suppkey") % 3 == 0, F.lit(1)).otherwise(F.col("l_partkey"))
    return adapter.tracks(spark, sf_dir, hit)


def categorized_tracks_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "tracks")
    cm.write_table(_one_hit(spark, sf_dir), path)
    features = cm.classify(adapter.part_features(spark, sf_dir))
    return cm.attach_features(cm.tracks_table(spark, path), features)


def categorize_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cm.classify(adapter.part_features(spark, sf_dir))


def _edge_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features that lie on, just beside, or null instead of the thresholds."""

    def pick(m: int, a: int, *values: float | None):
        index = ((F.col("p_partkey") + a) * m % 100003 % len(values)).cast("int")
        return F.get(F.array(*[F.lit(v).cast("double") for v in values]), index)

    return adapter.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("track_id"),
        pick(7919, 11, 0.5, 0.501, 0.7, 0.701, None).alias("danceability"),
        pick(104729, 23, 0.4, 0.401, 0.5, 0.6, 0.601, 0.7, 0.701, None).alias("energy"),
        pick(15485863, 37, 0.2, 0.4, 0.401, 0.8, 0.801, None).alias("speechiness"),
        pick(32452843, 41, 0.299, 0.3, 0.7, 0.701, None).alias("acousticness"),
        pick(49979687, 53, 0.5, 0.501, None).alias("valence"),
        pick(122949823, 83, 99.0, 100.0, 101.0, 120.0, 121.0, 140.0, None).alias("tempo"),
    )


def category_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cm.classify(_edge_features(spark, sf_dir))


def category_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of each part's category in the domain."""
    rows = cm.classify(adapter.part_features(spark, sf_dir)).select("track_id", "category")
    return rows.join(cm.category_domain(spark), "category").select(
        "track_id", "position", "category"
    )


# --- playlist documents -----------------------------------------------------


# Documents repeat their keys in every item, so that most of their bytes need not be
# written. A compressed file is one task's to read; hence a bound on its documents.
_LANDING = {"compression": "lz4", "maxRecordsPerFile": 200_000}


def _landed_playlists(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "playlists")
    texts = adapter.playlist_documents(spark, sf_dir).select("value")
    texts.write.options(**_LANDING).text(path)
    return cm.playlists(spark, path, lines=True)


def _landed_playlist_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document a file, in a folder for each playlist; a supplier is one. Its
    items lie all over the table, so its pages are its own: else it would have a
    file for each part of the table."""
    path = new_folder(spark, "playlist-files")
    pages = adapter.playlist_documents(spark, sf_dir, "l_suppkey", own_pages=True)
    pages.write.option("maxRecordsPerFile", 1).partitionBy("playlist_id").text(path)
    return cm.playlists(spark, path, id_from="folder")


def playlist_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cm.track_rows(cm.playlist_items(_landed_playlists(spark, sf_dir)))


def playlist_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks of the newest order that has items."""
    newest = adapter.table(spark, sf_dir, "lineitem").agg(F.max("l_orderkey")).first()[0]
    documents = cm.in_playlist(_landed_playlists(spark, sf_dir), str(newest))
    return cm.track_rows(cm.playlist_items(documents))


def playlist_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cm.track_rows(cm.playlist_items(_landed_playlist_files(spark, sf_dir)))


def playlist_by_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks of the last supplier; only its folder is read."""
    last = adapter.table(spark, sf_dir, "lineitem").agg(F.max("l_suppkey")).first()[0]
    documents = cm.in_playlist(_landed_playlist_files(spark, sf_dir), str(last))
    return cm.track_rows(cm.playlist_items(documents))


def track_frames_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Track frames of two origins, put together: documents and tables."""
    return cm.combine([playlist_flatten(spark, sf_dir), adapter.tracks(spark, sf_dir)])


def fetch_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cm.fetch_worklist(adapter.tracks(spark, sf_dir))


# --- feature documents ------------------------------------------------------


def _landed_features(spark: SparkSession, sf_dir: str, codec: str = "none") -> DataFrame:
    path = new_folder(spark, f"features-{codec}")
    texts = adapter.feature_document_texts(spark, sf_dir)
    texts.write.option("compression", codec).text(path)
    return cm.feature_documents(spark, path, lines=True)


def feature_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cm.feature_rows(_landed_features(spark, sf_dir))


def feature_document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per file, each an array of many entries."""
    path = new_folder(spark, "feature-files")
    texts = adapter.feature_array_documents(spark, sf_dir)
    texts.write.option("maxRecordsPerFile", 1).text(path)
    return cm.feature_rows(cm.feature_documents(spark, path, file_filter="*.txt"))


def feature_document_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from files named as they land, plain and gzipped mixed, beside
    files of other names."""
    path = new_folder(spark, "feature-names")
    texts = adapter.feature_array_documents(spark, sf_dir)
    size = F.length("value") % 2
    for codec, own in (("none", size == 0), ("gzip", size == 1)):
        part = f"{path}/{codec}"
        texts.where(own).write.option("compression", codec).option("maxRecordsPerFile", 1).text(part)
        adapter.renamed(spark, part, "audio_features_{}.json")
    adapter.broken_feature_texts(spark, sf_dir).write.text(f"{path}/other")
    return cm.feature_rows(
        cm.feature_documents(spark, [f"{path}/{name}" for name in ("none", "gzip", "other")])
    )


def feature_documents_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents, landed as a file each, put together in files of lines."""
    path, packed = new_folder(spark, "feature-files"), new_folder(spark, "feature-packed")
    texts = adapter.feature_array_documents(spark, sf_dir)
    texts.write.option("maxRecordsPerFile", 1).option("compression", "gzip").text(path)
    cm.pack_documents(spark, path, packed)
    return cm.feature_rows(cm.feature_documents(spark, packed, lines=True))


def gzip_resplit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in one compressed file, dealt out to files that can be split."""
    path, split = new_folder(spark, "features-one"), new_folder(spark, "features-split")
    texts = adapter.feature_document_texts(spark, sf_dir)
    texts.coalesce(1).write.option("compression", "gzip").text(path)
    cm.pack_documents(spark, path, split, lines=True)
    return cm.feature_rows(cm.feature_documents(spark, split, lines=True))


def gzip_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents from compressed files."""
    return cm.feature_rows(_landed_features(spark, sf_dir, "gzip"))


def feature_frames_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature frames of two origins, put together: documents and tables."""
    return cm.combine([feature_documents(spark, sf_dir), adapter.part_features(spark, sf_dir)])


def landing_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes landed per folder, from a listing that tasks made and wrote once."""
    path, inventory = new_folder(spark, "names"), new_folder(spark, "inventory")
    part = adapter.table(spark, sf_dir, "part")
    part.select(F.col("p_name").alias("value"), "p_brand").write.partitionBy("p_brand").text(path)
    folder = F.url_decode(F.regexp_extract("path", "/p_brand=([^/]*)/", 1))
    cm.write_table(cm.landing_files(spark, path, "*.txt", levels=1), inventory)
    return (
        spark.read.parquet(inventory)
        .groupBy(folder.alias("folder"))
        .agg(F.sum("length").alias("bytes"))
    )


# --- stored tables ----------------------------------------------------------


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "audio_features")
    cm.write_table(adapter.part_features(spark, sf_dir), path)
    return cm.features_table(spark, path)


def full_refresh_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = cm.Store(spark, new_folder(spark, "store"))
    for _ in range(2):
        store.replace("categorized_tracks", categorized_tracks(spark, sf_dir))
    return store.table("categorized_tracks")


def append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs, the second of them repeated: it counts once."""
    store = cm.Store(spark, new_folder(spark, "store"))
    for run in ("first", "second", "second"):
        store.append("categorized_tracks", categorized_tracks(spark, sf_dir), run=run)
    return store.table("categorized_tracks")


def append_twice_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without a store: a folder that other tools read as it is."""
    path = new_folder(spark, "categorized_tracks")
    for _ in range(2):
        cm.write_table(categorized_tracks(spark, sf_dir), path, mode="append")
    return cm.result_table(spark, path)


def earlier_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the table was before it was replaced."""
    store = cm.Store(spark, new_folder(spark, "store"))
    before = store.replace("categorized_tracks", categorized_tracks(spark, sf_dir))
    store.replace("categorized_tracks", store.table("categorized_tracks").where("category = 'all'"))
    return store.table("categorized_tracks", version=before.version)


def _stored_result(spark: SparkSession, sf_dir: str, partition_by: str | None) -> DataFrame:
    path = new_folder(spark, "categorized_tracks")
    cm.write_table(categorized_tracks(spark, sf_dir), path, partition_by=partition_by)
    return cm.result_table(spark, path)


def browse_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cm.browse(_stored_result(spark, sf_dir, None))


def browse_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cm.browse(_stored_result(spark, sf_dir, "category"), "Classic🏛️")


def refresh_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job: documents in, categorised table out."""
    tables = cm.Tables.under(new_folder(spark, "refresh"))
    cm.refresh(
        spark, _landed_playlists(spark, sf_dir), _landed_features(spark, sf_dir), tables
    )
    return cm.result_table(spark, tables.result)


def publish_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job into a store, and the same run once more: it is through and
    appends nothing."""
    store = cm.Store(spark, new_folder(spark, "store"))
    playlists, features = _landed_playlists(spark, sf_dir), _landed_features(spark, sf_dir)
    for _ in range(2):
        cm.publish(spark, playlists, features, store, run="nightly", result_mode="append")
    return store.table("categorized_tracks")


def _published_with_rejects(spark: SparkSession, sf_dir: str) -> cm.Store:
    """The whole job over documents of which some are broken."""
    landed = new_folder(spark, "landed")
    for name, good, broken in (
        ("playlists", adapter.playlist_documents, adapter.broken_playlist_texts),
        ("features", adapter.feature_document_texts, adapter.broken_feature_texts),
    ):
        texts = good(spark, sf_dir).select("value").unionByName(broken(spark, sf_dir))
        texts.write.options(**_LANDING).text(f"{landed}/{name}")
    store = cm.Store(spark, new_folder(spark, "store"))
    cm.publish(
        spark,
        cm.playlists(spark, f"{landed}/playlists", lines=True, malformed="skip"),
        cm.feature_documents(spark, f"{landed}/features", lines=True),
        store,
        malformed="skip",
    )
    return store


def refresh_skipping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the job makes of the documents that can be used."""
    return _published_with_rejects(spark, sf_dir).table("categorized_tracks")


def refresh_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kind and text of those that cannot."""
    return _published_with_rejects(spark, sf_dir).table("rejected_documents").select(
        "kind", F.sha2("value", 256).alias("text_sha256")
    )


# --- the contract -----------------------------------------------------------

_QUERIES = (
    categorized_tracks,
    categorized_tracks_hot_key,
    categorize_features,
    category_edges,
    category_domain,
    playlist_flatten,
    playlist_by_id,
    playlist_files,
    playlist_by_folder,
    track_frames_union,
    fetch_worklist,
    feature_documents,
    feature_document_files,
    feature_document_names,
    feature_documents_packed,
    gzip_documents,
    gzip_resplit,
    feature_frames_union,
    landing_inventory,
    parquet_roundtrip,
    full_refresh_twice,
    append_twice,
    append_twice_plain,
    earlier_version,
    browse_all,
    browse_category,
    refresh_from_documents,
    publish_from_documents,
    refresh_skipping,
    refresh_rejected,
)


def entry(spark: SparkSession) -> DataFrame:
    return categorized_tracks(spark, FLAGSHIP_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = {query.__name__: query for query in _QUERIES}
    if llm_queries is not None:
        named |= llm_queries.queries() | {"pipeline": corpus_pipeline.run}
    return named


# --- the same in SQL --------------------------------------------------------


def _d(number: str) -> str:
    return f"CAST({number} AS DOUBLE)"


# Fixed values, as in ``cratemark.functions.rules``: labels, thresholds, order.
_CATEGORY = f"""CASE
    WHEN energy > {_d('0.7')} AND tempo > {_d('120')} AND acousticness < {_d('0.3')} THEN 'Metal🤘'
    WHEN acousticness > {_d('0.7')} AND energy < {_d('0.5')} AND tempo < {_d('100')} THEN 'Classic🏛️'
    WHEN speechiness > {_d('0.8')} THEN 'Podcast🎧'
    WHEN speechiness > {_d('0.4')} THEN 'Vocal🎤'
    WHEN energy > {_d('0.6')} AND tempo > {_d('120')} AND danceability > {_d('0.7')} THEN 'Electro⚡'
    WHEN energy > {_d('0.6')} AND tempo > {_d('100')} AND tempo < {_d('140')}
     AND danceability > {_d('0.5')} THEN 'HipHop🎤'
    WHEN valence > {_d('0.5')} AND danceability > {_d('0.5')} AND danceability < {_d('0.7')}
     AND energy > {_d('0.4')} AND energy < {_d('0.6')} THEN 'Soul🎷'
    WHEN energy > {_d('0.6')} AND tempo > {_d('100')} AND tempo < {_d('140')}
     AND danceability > {_d('0.5')} AND danceability < {_d('0.7')} THEN 'Rock🎸'
    ELSE 'Other🦦' END"""


def _unit(m: int, a: int, name: str) -> str:
    return (
        f"CAST((((p_partkey + {a}) * {m}) % 100003) % 1001 AS DOUBLE) / {_d('1000')} AS {name}"
    )


_FEATURES = f"""SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS track_id,
    {_unit(7919, 11, 'danceability')},
    {_unit(104729, 23, 'energy')},
    {_d('0')} - CAST((((p_partkey + 97) * 141650939) % 100003) % 60001 AS DOUBLE) / {_d('1000')} AS loudness,
    {_unit(15485863, 37, 'speechiness')},
    {_unit(32452843, 41, 'acousticness')},
    {_unit(67867967, 61, 'instrumentalness')},
    {_unit(86028121, 71, 'liveness')},
    {_unit(49979687, 53, 'valence')},
    CAST(60 + (((p_partkey + 83) * 122949823) % 100003) % 141 AS DOUBLE) AS tempo,
    CAST(60000 + ((p_partkey + 101) * 160481183) % 100003 AS BIGINT) AS duration_ms
    FROM part"""

_CLASSIFIED = f"SELECT *, {_CATEGORY} AS category FROM ({_FEATURES}) AS f"


def _tracks_sql(track_id: str = "l_partkey") -> str:
    return f"""SELECT l_orderkey, CAST({track_id} AS VARCHAR) AS track_id, p_type AS album_type,
    p_name AS name, strftime(l_shipdate, '%Y-%m-%d') AS release_date, s_name AS artist_name
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey"""


_TRACKS = ", ".join(TRACK_COLUMNS)
_FEATURE_NAMES = ", ".join(FEATURE_COLUMNS)


def _joined(tracks: str, features: str = _CLASSIFIED) -> str:
    return (
        f"SELECT {', '.join(RESULT_COLUMNS)} FROM ({tracks}) AS t JOIN ({features}) AS c"
        " USING (track_id)"
    )


_FLAGSHIP = _joined(_tracks_sql())

# Which documents are accepted follows from their shape, which follows from the
# key; those with two entries contribute a second row of id and energy.
_SHAPED = f"""SELECT p_partkey, CASE WHEN p_partkey % 11 <> 0 THEN track_id END AS track_id,
    {', '.join(FEATURE_COLUMNS[1:])} FROM ({_FEATURES}) AS f
    WHERE p_partkey % 10 <> 0 AND p_partkey % 13 <> 0
    UNION ALL
    SELECT p_partkey, track_id || '-b', NULL, energy, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
    FROM ({_FEATURES}) AS f
    WHERE p_partkey % 10 <> 0 AND p_partkey % 13 <> 0 AND p_partkey % 7 = 0"""
_DOCUMENTS = f"SELECT {_FEATURE_NAMES} FROM ({_SHAPED}) AS s"

_ARRAYS = f"""SELECT {_FEATURE_NAMES.replace('tempo', 'CASE WHEN p_partkey % 3 <> 2 THEN tempo END AS tempo')}
    FROM (SELECT *, min(p_partkey) OVER (PARTITION BY p_partkey // 500) AS first_key
          FROM ({_FEATURES}) AS f) AS g
    WHERE first_key % 3 <> 2"""


def _edge(m: int, a: int, values: str, name: str) -> str:
    count = values.count(",") + 1
    return (
        f"CAST(list_extract([{values}], ((p_partkey + {a}) * {m}) % 100003 % {count} + 1)"
        f" AS DOUBLE) AS {name}"
    )


_EDGES = f"""SELECT CAST(p_partkey AS VARCHAR) AS track_id,
    {_edge(7919, 11, '0.5, 0.501, 0.7, 0.701, NULL', 'danceability')},
    {_edge(104729, 23, '0.4, 0.401, 0.5, 0.6, 0.601, 0.7, 0.701, NULL', 'energy')},
    {_edge(15485863, 37, '0.2, 0.4, 0.401, 0.8, 0.801, NULL', 'speechiness')},
    {_edge(32452843, 41, '0.299, 0.3, 0.7, 0.701, NULL', 'acousticness')},
    {_edge(49979687, 53, '0.5, 0.501, NULL', 'valence')},
    {_edge(122949823, 83, '99, 100, 101, 120, 121, 140, NULL', 'tempo')}
    FROM part"""

# The labels in the same order.
_POSITIONS = """(VALUES (1, 'Metal🤘'), (2, 'Classic🏛️'), (3, 'Podcast🎧'), (4, 'Vocal🎤'),
    (5, 'Electro⚡'), (6, 'HipHop🎤'), (7, 'Soul🎷'), (8, 'Rock🎸'), (9, 'Other🦦'))"""


_PAGE = """('{"playlist_id":"' || s_suppkey || '","items":[]}')"""
_BROKEN_PLAYLISTS = f"""SELECT 'playlist' AS kind, list_extract([
      '{{"playlist_id":"' || s_suppkey || '","items":[', {_PAGE} || {_PAGE}, {_PAGE} || ' and more',
      '{{"items":' || s_suppkey || '}}', '{{"error":{{"status":401,"key":' || s_suppkey || '}}}}'
    ], s_suppkey % 5 + 1) AS value FROM supplier"""
# The measures as JSON writes them: shortest digits, whole numbers with ".0".
_MEASURES = " || ',' || ".join(
    f"""'"{name}":' || CAST({name} AS VARCHAR)"""
    for name in FEATURE_COLUMNS[1:]
    if name != "duration_ms"
)
_OPENED = f"""('{{"id":"' || track_id || '",' || {_MEASURES})"""
_BROKEN_FEATURES = f"""SELECT 'feature' AS kind, list_extract([
      '<html>' || track_id || '</html>', {_OPENED} || ',"duration_ms":"long"}}',
      {_OPENED} || ',"duration_ms":"Infinity"}}', {_OPENED} || ',"duration_ms":1e300}}',
      {_OPENED} || ',"duration_ms":1000.7}}'
    ], p_partkey % 5 + 1) AS value FROM ({_FEATURES}) AS f"""


def oracle_sql() -> dict[str, str]:
    track_rows = f"SELECT {_TRACKS} FROM ({_tracks_sql()}) AS t"
    hit = "CASE WHEN l_suppkey % 3 = 0 THEN 1 ELSE l_partkey END"
    browse = f"SELECT name, artist_name, category FROM ({_FLAGSHIP}) AS r"
    equivalents = {
        "categorized_tracks": _FLAGSHIP,
        "categorized_tracks_hot_key": _joined(_tracks_sql(hit)),
        "categorize_features": f"SELECT {_FEATURE_NAMES}, category FROM ({_CLASSIFIED}) AS c",
        "category_edges": f"SELECT *, {_CATEGORY} AS category FROM ({_EDGES}) AS e",
        "category_domain": (
            f"SELECT track_id, CAST(position AS INTEGER) AS position, category"
            f" FROM ({_CLASSIFIED}) AS c JOIN {_POSITIONS} AS d(position, category)"
            " USING (category)"
        ),
        "playlist_flatten": track_rows,
        "playlist_by_id": (
            f"{track_rows} WHERE l_orderkey = (SELECT max(l_orderkey) FROM lineitem)"
        ),
        "playlist_files": track_rows,
        "playlist_by_folder": (
            f"SELECT {_TRACKS} FROM ({_tracks_sql()} WHERE l_suppkey"
            " = (SELECT max(l_suppkey) FROM lineitem)) AS t"
        ),
        "track_frames_union": f"{track_rows} UNION ALL {track_rows}",
        "fetch_worklist": (
            "SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS track_id,"
            " 'audio_features_' || CAST(l_partkey AS VARCHAR) || '.json' AS landing_path"
            " FROM lineitem"
        ),
        "feature_documents": _DOCUMENTS,
        "feature_document_files": _ARRAYS,
        "feature_document_names": _ARRAYS,
        "feature_documents_packed": _ARRAYS,
        "gzip_documents": _DOCUMENTS,
        "gzip_resplit": _DOCUMENTS,
        "feature_frames_union": (
            f"{_DOCUMENTS} UNION ALL SELECT {_FEATURE_NAMES} FROM ({_FEATURES}) AS f"
        ),
        "landing_inventory": (
            "SELECT p_brand AS folder, CAST(sum(strlen(p_name) + 1) AS BIGINT) AS bytes"
            " FROM part GROUP BY p_brand"
        ),
        "parquet_roundtrip": f"SELECT {_FEATURE_NAMES} FROM ({_FEATURES}) AS f",
        "full_refresh_twice": _FLAGSHIP,
        "append_twice": f"{_FLAGSHIP} UNION ALL {_FLAGSHIP}",
        "append_twice_plain": f"{_FLAGSHIP} UNION ALL {_FLAGSHIP}",
        "earlier_version": _FLAGSHIP,
        "browse_all": browse,
        "browse_category": f"{browse} WHERE category = 'Classic🏛️'",
        "refresh_from_documents": _joined(
            _tracks_sql(), f"SELECT *, {_CATEGORY} AS category FROM ({_SHAPED}) AS s"
        ),
        "publish_from_documents": _joined(
            _tracks_sql(), f"SELECT *, {_CATEGORY} AS category FROM ({_SHAPED}) AS s"
        ),
        "refresh_skipping": _joined(
            _tracks_sql(), f"SELECT *, {_CATEGORY} AS category FROM ({_SHAPED}) AS s"
        ),
        "refresh_rejected": (
            f"SELECT kind, sha256(value) AS text_sha256 FROM ({_BROKEN_PLAYLISTS}"
            f" UNION ALL {_BROKEN_FEATURES}) AS r"
        ),
    }
    if llm_queries is not None:
        equivalents |= llm_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL is not None:
            equivalents["pipeline"] = corpus_pipeline.ORACLE_SQL
    return equivalents
