"""Playlists, tracks and audio features out of the TPC-H-like tables.

An order is a playlist, a line item is a playlist item, a part is a track. The
mapping and the feature formulas are those of ``FIXTURES.md`` part 2. All of it
is plain DataFrame code whose work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratemark.schemas import FEATURE_COLUMNS, REQUIRED_KEYS, TRACK_COLUMNS

# Multiplier and offset of each pseudo-random feature.
UNIT_FEATURES = {
    "danceability": (7919, 11),
    "energy": (104729, 23),
    "speechiness": (15485863, 37),
    "acousticness": (32452843, 41),
    "valence": (49979687, 53),
    "instrumentalness": (67867967, 61),
    "liveness": (86028121, 71),
}
PAGE_ROWS = 100_000
ENTRIES = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _formula(name: str) -> str:
    if name in UNIT_FEATURES:
        m, a = UNIT_FEATURES[name]
        return f"CAST((((k + {a}) * {m}) % 100003) % 1001 AS DOUBLE) / CAST(1000 AS DOUBLE)"
    return {
        "tempo": "CAST(60 + (((k + 83) * 122949823) % 100003) % 141 AS DOUBLE)",
        "loudness": (
            "CAST(0 AS DOUBLE) - CAST((((k + 97) * 141650939) % 100003) % 60001 AS DOUBLE)"
            " / CAST(1000 AS DOUBLE)"
        ),
        "duration_ms": "CAST(60000 + ((k + 101) * 160481183) % 100003 AS BIGINT)",
    }[name]


def part_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audio-features table: one row per part."""
    keys = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"))
    return keys.select(
        F.col("k").cast("string").alias("track_id"),
        *[F.expr(_formula(name)).alias(name) for name in REQUIRED_KEYS],
    )


def lineitem_tracks(
    spark: SparkSession,
    sf_dir: str,
    id_of: Column | None = None,
    playlist: str = "l_orderkey",
    own_pages: bool = False,
) -> DataFrame:
    """The tracks table plus ``playlist_id``, the second artist, and the page the
    item would be delivered on: one row per line item.

    Pages cut each scan partition into runs of ``PAGE_ROWS`` rows. So a page is
    of bounded size (25 MB of JSON) however many items a playlist has, and since
    they are numbered straight off the scan, a task run again numbers them alike.
    That suits playlists whose items lie together. ``own_pages`` is for those whose
    items lie all over the table: each is dealt to as many pages as it needs, of
    about ``PAGE_ROWS`` rows, so that pages are as few as the playlists allow.
    """
    number = F.monotonically_increasing_id()
    page = number if own_pages else F.expr(f"monotonically_increasing_id() div {PAGE_ROWS}")
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", page.alias("page")
    )
    if own_pages:
        items = _own_pages(items, playlist)
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return (
        items.join(part, items.l_partkey == part.p_partkey)
        .join(supplier, items.l_suppkey == supplier.s_suppkey)
        .select(
            (F.col("l_partkey") if id_of is None else id_of).cast("string").alias("track_id"),
            F.col("p_type").alias("album_type"),
            F.col("p_name").alias("name"),
            F.col("l_shipdate").cast("date").cast("string").alias("release_date"),
            F.col("s_name").alias("artist_name"),
            F.col("p_brand").alias("second_artist"),
            F.col(playlist).cast("string").alias("playlist_id"),
            "page",
        )
    )


def _own_pages(items: DataFrame, playlist: str) -> DataFrame:
    """``page``, a row's number, becomes one of its playlist's pages."""
    key = F.col(playlist)
    sizes = items.groupBy(key.alias("sized")).agg(
        F.ceil(F.count("*") / PAGE_ROWS).alias("n_pages")
    )
    page = F.pmod(F.xxhash64("page"), F.col("n_pages"))
    return (
        items.join(sizes, key.eqNullSafe(F.col("sized")))
        .withColumn("page", page)
        .drop("sized", "n_pages")
    )


def tracks(spark: SparkSession, sf_dir: str, id_of: Column | None = None) -> DataFrame:
    return lineitem_tracks(spark, sf_dir, id_of).select(*TRACK_COLUMNS)


def playlist_documents(
    spark: SparkSession, sf_dir: str, playlist: str = "l_orderkey", own_pages: bool = False
) -> DataFrame:
    """Columns ``value`` and ``playlist_id``: playlist documents as JSON text, one
    per playlist and page. ``playlist`` names the column that makes a playlist,
    ``own_pages`` how its pages are cut."""
    artists = F.array(
        F.struct(F.col("artist_name").alias("name")),
        F.struct(F.col("second_artist").alias("name")),
    )
    album = F.struct("album_type", "release_date", artists.alias("artists"))
    track = F.struct(F.col("track_id").alias("id"), "name", album.alias("album"))
    return (
        lineitem_tracks(spark, sf_dir, playlist=playlist, own_pages=own_pages)
        # Collecting shrinks nothing, so it is done after the shuffle only.
        .repartition("playlist_id", "page")
        .groupBy("playlist_id", "page")
        .agg(F.collect_list(F.struct(track.alias("track"))).alias("items"))
        .select(F.to_json(F.struct("playlist_id", "items")).alias("value"), "playlist_id")
    )


def feature_document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column ``value``: one feature document per part, as JSON text.

    Its shape follows the key. Every tenth is an error body. Of the others,
    every thirteenth is an array whose first entry lacks its tempo, every
    seventh an array whose second entry has an id and an energy only, and every
    eleventh has no id. The rest are plain objects.
    """
    rows = part_features(spark, sf_dir).withColumn("k", F.col("track_id").cast("bigint"))
    k = F.col("k")
    track_id = F.when(k % 11 != 0, F.col("track_id")).alias("id")
    whole = F.to_json(F.struct(track_id, *FEATURE_COLUMNS[1:]))
    no_tempo = F.to_json(F.struct(track_id, *[n for n in REQUIRED_KEYS if n != "tempo"]))
    second = F.to_json(F.struct(F.concat("track_id", F.lit("-b")).alias("id"), "energy"))
    array = F.lit("["), F.lit(","), F.lit("]")
    return rows.select(
        F.when(k % 10 == 0, F.lit('{"error":{"status":404,"message":"analysis not found"}}'))
        .when(k % 13 == 0, F.concat(array[0], no_tempo, array[1], whole, array[2]))
        .when(k % 7 == 0, F.concat(array[0], whole, array[1], second, array[2]))
        .otherwise(whole)
        .alias("value"),
    )


def broken_playlist_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column ``value``: one text per supplier that is no playlist document: cut
    off, two documents, a document and more, other types, or without items."""
    key = F.col("s_suppkey").cast("string")
    page = F.concat(F.lit('{"playlist_id":"'), key, F.lit('","items":[]}'))
    broken = F.array(
        F.concat(F.lit('{"playlist_id":"'), key, F.lit('","items":[')),
        F.concat(page, page),
        F.concat(page, F.lit(" and more")),
        F.concat(F.lit('{"items":'), key, F.lit("}")),
        F.concat(F.lit('{"error":{"status":401,"key":'), key, F.lit("}}")),
    )
    suppliers = table(spark, sf_dir, "supplier")
    return suppliers.select(F.get(broken, (F.col("s_suppkey") % 5).cast("int")).alias("value"))


def broken_feature_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column ``value``: one text per part that is no feature document: no JSON, a
    measure in words, or a duration that is infinite, out of range or broken."""
    rows = part_features(spark, sf_dir)
    k = F.col("track_id").cast("bigint")
    rest = [name for name in REQUIRED_KEYS if name != "duration_ms"]
    whole = F.to_json(F.struct(F.col("track_id").alias("id"), *rest))
    opened = F.substring(whole, F.lit(1), F.length(whole) - 1)

    def lasting(duration: str) -> Column:
        return F.concat(opened, F.lit(f',"duration_ms":{duration}}}'))

    broken = F.array(
        F.concat(F.lit("<html>"), F.col("track_id"), F.lit("</html>")),
        lasting('"long"'),
        lasting('"Infinity"'),
        lasting("1e300"),
        lasting("1000.7"),
    )
    return rows.select(F.get(broken, (k % 5).cast("int")).alias("value"))


def renamed(spark: SparkSession, path: str, pattern: str) -> None:
    """Give the files of a small folder the names that landed files have:
    ``pattern`` with a number for ``{}``, and the ending of a gzipped file."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for number, status in enumerate(files.listStatus(folder)):
        found = status.getPath()
        if found.getName().startswith("part-"):
            zipped = ".gz" if found.getName().endswith(".gz") else ""
            name = pattern.format(number) + zipped
            files.rename(found, spark._jvm.org.apache.hadoop.fs.Path(folder, name))


def feature_array_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column ``value``: array documents of up to ``ENTRIES`` parts with adjacent
    keys, in key order; keys are unique, so no array is longer. Parts whose key leaves 2 when divided by 3 lack their
    tempo, so that an array which begins with one is to be dropped as a whole.
    """
    rows = part_features(spark, sf_dir).withColumn("k", F.col("track_id").cast("bigint"))
    tempo = F.when(F.col("k") % 3 != 2, F.col("tempo")).alias("tempo")
    columns = [tempo if name == "tempo" else F.col(name) for name in REQUIRED_KEYS]
    entry = F.struct("k", F.struct(F.col("track_id").alias("id"), *columns).alias("entry"))
    in_order = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["entry"])
    return (
        rows.groupBy(F.expr(f"k div {ENTRIES}").alias("block"))
        .agg(F.to_json(in_order).alias("value"))
        .select("value")
    )
