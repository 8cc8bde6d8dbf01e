"""Sinks and the whole job, from files to the browsed table."""

import gzip
import json
import os
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

import cratemark as cm
from cratemark.__main__ import main
from cratemark.functions.rules import labels
from cratemark.schemas import FEATURES, RESULT, RESULT_COLUMNS

BASE = {
    "danceability": 0.1,
    "energy": 0.2,
    "loudness": -5.5,
    "speechiness": 0.1,
    "acousticness": 0.5,
    "instrumentalness": 0.0,
    "liveness": 0.1,
    "valence": 0.1,
    "tempo": 90,
    "duration_ms": 1000,
}


def item(track_id, name, artist):
    album = {"album_type": "album", "release_date": "1999", "artists": [{"name": artist}]}
    return {"track": {"id": track_id, "name": name, "album": album}}


@pytest.fixture
def landed(tmp_path):
    """Raw folders as a run finds them."""
    playlists, features = tmp_path / "playlists", tmp_path / "features"
    playlists.mkdir()
    features.mkdir()
    items = [
        item("a", "Loud", "One"),
        item("a", "Loud", "One"),
        item("b", "Talk", "Two"),
        item("c", "Refused", "Three"),
        item("d", "Unfetched", "Four"),
        item(None, "Local file", "Five"),
    ]
    (playlists / "playlist_p.json").write_text(json.dumps({"items": items}))
    (playlists / "playlist_q.json").write_text(json.dumps({"items": [item("b", "Talk", "Two")]}))
    documents = {
        "a": {"id": "a", **BASE, "energy": 0.9, "tempo": 150, "acousticness": 0.1},
        "b": [{"id": "b", **BASE, "speechiness": 0.9}],
        "c": {"error": {"status": 404, "message": "analysis not found"}},
        "stale": {"id": "stale", **BASE},
        "noid": BASE,
    }
    for name, document in documents.items():
        (features / f"audio_features_{name}.json").write_text(json.dumps(document))
    zipped = features / "audio_features_gz.json.gz"
    zipped.write_bytes(gzip.compress(json.dumps({"id": "gz", **BASE}).encode()))
    return tmp_path


def run(spark, landed, **options):
    tables = cm.Tables.under(str(landed / "out") + "/")
    cm.refresh(
        spark,
        cm.playlists(
            spark,
            str(landed / "playlists"),
            id_from="file_name",
            malformed=options.get("malformed", "fail"),
        ),
        cm.feature_documents(spark, str(landed / "features")),
        tables,
        **options,
    )
    return tables


def browsed(spark, tables, category="all"):
    frame = cm.browse(cm.result_table(spark, tables.result), category)
    assert frame.columns == ["name", "artist_name", "category"]
    return Counter(tuple(r) for r in frame.collect())


LOUD, TALK = ("Loud", "One", "Metal🤘"), ("Talk", "Two", "Podcast🎧")


@pytest.mark.parametrize(
    "options",
    [{}, {"partition_by": "category", "compact": True}, {"compact": True}],
    ids=["plain", "partitioned", "compact"],
)
def test_job_and_rerun(spark, landed, options):
    for _ in range(2):
        tables = run(spark, landed, **options)
        assert browsed(spark, tables) == {LOUD: 2, TALK: 2}
    result = cm.result_table(spark, tables.result)
    assert result.columns == list(RESULT_COLUMNS)
    assert result.schema == RESULT
    assert cm.tracks_table(spark, tables.tracks).count() == 7
    features = cm.features_table(spark, tables.features)
    assert Counter(r.track_id for r in features.collect()) == {
        "a": 1, "b": 1, "stale": 1, None: 1, "gz": 1,
    }


def test_command_line(spark, landed):
    main(
        [
            *("--playlists", str(landed / "playlists"), "--id-from", "file_name"),
            *("--documents", str(landed / "features"), "--output", str(landed / "out")),
            *("--playlist-id", "p", "--partition-by-category"),
        ]
    )
    assert browsed(spark, cm.Tables.under(str(landed / "out"))) == {LOUD: 2, TALK: 1}
    assert spark.range(1).count() == 1  # the session is left running


def test_one_playlist(spark, landed):
    assert browsed(spark, run(spark, landed, playlist_id="q")) == {TALK: 1}
    assert browsed(spark, run(spark, landed, playlist_id="absent")) == {}


def test_append_keeps_what_is_there(spark, landed):
    for _ in range(2):
        tables = run(spark, landed, result_mode="append")
    assert browsed(spark, tables) == {LOUD: 4, TALK: 4}


def test_malformed_documents(spark, landed):
    (landed / "features" / "audio_features_x.json").write_text("<html>")
    with pytest.raises(Exception, match="MALFORMED_RECORD|not a feature document"):
        run(spark, landed)
    (landed / "playlists" / "playlist_x.json").write_text("{} {}")
    (landed / "playlists" / "playlist_y.json").write_text('{"error": 1}')
    tables = run(spark, landed, malformed="skip")
    assert browsed(spark, tables) == {LOUD: 2, TALK: 2}
    rejected = Counter(tuple(r) for r in spark.read.parquet(tables.rejected).collect())
    assert rejected == {
        ("feature", "<html>"): 1, ("playlist", "{} {}"): 1, ("playlist", '{"error": 1}'): 1,
    }
    tables = run(spark, landed, malformed="skip", playlist_id="q")
    assert browsed(spark, tables) == {TALK: 1}
    kept = spark.read.parquet(tables.rejected).where("kind = 'playlist'").count()
    assert kept == 0  # their file names say that they are other playlists


def test_a_failed_run_leaves_the_previous_result(spark, landed, monkeypatch):
    tables = run(spark, landed)
    before = browsed(spark, tables)

    def failing(tracks, features):
        return cm.attach_features(tracks, features).withColumn(
            "category", F.raise_error(F.lit("the join fails")).cast("string")
        )

    monkeypatch.setattr(sys.modules["cratemark.plans.refresh"], "attach_features", failing)
    with pytest.raises(Exception, match="the join fails"):
        run(spark, landed)
    assert browsed(spark, tables) == before
    assert sorted(os.listdir(landed / "out")) == ["audio_features", "categorized_tracks", "tracks"]


@pytest.mark.parametrize("partition_by", [None, "category"])
def test_browse_each_category(spark, tmp_path, partition_by):
    rows = [("t", "s", f"n{i}", "2020", "x", *[0.5] * 9, 1, c) for i, c in enumerate(labels())]
    path = str(tmp_path / "result")
    cm.write_table(spark.createDataFrame(rows, RESULT), path, partition_by=partition_by)
    result = cm.result_table(spark, path)
    assert cm.browse(result).count() == 9
    for i, category in enumerate(labels()):
        assert [tuple(r) for r in cm.browse(result, category).collect()] == [(f"n{i}", "x", category)]
    with pytest.raises(ValueError):
        cm.browse(result, "Classic🏛")  # lacks the variation selector
    plan = cm.browse(result, "Soul🎷")._jdf.queryExecution().executedPlan().toString()
    if partition_by:
        assert "PartitionFilters: [isnotnull(category" in plan
        assert len([d for d in os.listdir(path) if d.startswith("category=")]) == 9
    else:
        assert "EqualTo(category,Soul🎷)" in plan
        assert "ReadSchema: struct<name:string,artist_name:string,category:string>" in plan


def test_other_formats(spark, tmp_path):
    frame = spark.createDataFrame([("t", *"abcd", *[0.5] * 9, 1, "Other🦦")], RESULT)
    path = str(tmp_path / "orc")
    cm.write_table(frame, path, format="orc", compression="zlib")
    assert cm.result_table(spark, path, format="orc").collect() == frame.collect()
    with pytest.raises(ValueError):
        cm.write_table(frame, path, mode="upsert")


def test_tables_with_guessed_types(spark, tmp_path):
    """As pandas writes them: whole-number tempos, a duration with a gap."""
    pd = pytest.importorskip("pandas")
    rows = [{"track_id": 1, **BASE}, {"track_id": 2, **BASE, "duration_ms": None}]
    pd.DataFrame(rows)[FEATURES.names].to_parquet(tmp_path / "f.parquet", index=False)
    frame = cm.features_table(spark, str(tmp_path / "f.parquet"), declared=False)
    assert frame.schema == FEATURES
    got = sorted((r.track_id, r.tempo, r.duration_ms) for r in frame.collect())
    assert got == [("1", 90.0, 1000), ("2", 90.0, None)]
    pushed = frame.where("energy > 0.1")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(energy,0.1)" in pushed


def test_compact_merges_small_files(spark, tmp_path):
    frame = spark.range(0, 1000, 1, 50)
    cm.write_table(frame, str(tmp_path / "many"))
    cm.write_table(frame, str(tmp_path / "few"), compact=True)

    def files(name):
        return len([f for f in os.listdir(tmp_path / name) if f.startswith("part-")])

    assert files("many") == 50 and files("few") <= 8
    assert spark.read.parquet(str(tmp_path / "few")).count() == 1000


def test_worklist(spark):
    tracks = spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "track_id string")
    got = sorted(tuple(r) for r in cm.fetch_worklist(tracks).collect())
    assert got == [("a", "audio_features_a.json"), ("b", "audio_features_b.json")]
    rooted = cm.fetch_worklist(tracks, "s3://land/100%/").where("track_id = 'a'").first()
    assert rooted.landing_path == "s3://land/100%/audio_features_a.json"


def test_landing_files(spark, landed):
    files = cm.landing_files(spark, str(landed / "features"), "audio_features_*")
    assert files.columns == ["path", "length", "modificationTime"]
    sizes = {os.path.basename(r.path): r.length for r in files.collect()}
    assert sizes == {f: os.path.getsize(landed / "features" / f) for f in os.listdir(landed / "features")}
    assert cm.landing_files(spark, str(landed)).count() == 8


def test_combine(spark):
    a = spark.createDataFrame([("x", 1)], "track_id string, n int")
    b = spark.createDataFrame([(2, "x"), (1, "x")], "n int, track_id string")
    c = spark.createDataFrame([("y",)], "track_id string")
    got = Counter(tuple(r) for r in cm.combine([a, b, c]).collect())
    assert got == {("x", 1): 2, ("x", 2): 1, ("y", None): 1}
