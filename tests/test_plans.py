"""What Spark makes of the queries: the plans must stay the ones we want."""

import json
import sys
import tempfile

import pytest

import cratemark as cm
import cratemark.plans.refresh  # noqa: F401
from cratemark import session as session_module
from cratemark.session import build_session, new_folder, shared_folder, shuffle_partitions
from testbed import adapter

SF_DIR = "/root/testdata/sf0.001"
refresh_module = sys.modules["cratemark.plans.refresh"]


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_classification_is_one_scan_and_no_shuffle(spark, tmp_path):
    path = str(tmp_path / "features")
    cm.write_table(adapter.part_features(spark, SF_DIR), path)
    plan = physical(cm.classify(cm.features_table(spark, path)).select("track_id", "category"))
    assert "Exchange" not in plan and plan.count("FileScan") == 1
    for unused in ("loudness", "liveness", "instrumentalness", "duration_ms"):
        assert unused not in plan.split("ReadSchema")[1]


def test_join_of_large_tables_shuffles_each_side_once(spark, tmp_path):
    tables = cm.Tables.under(str(tmp_path))
    cm.write_table(adapter.tracks(spark, SF_DIR), tables.tracks)
    cm.write_table(adapter.part_features(spark, SF_DIR), tables.features)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(
            cm.attach_features(
                cm.tracks_table(spark, tables.tracks),
                cm.classify(cm.features_table(spark, tables.features)),
            )
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("SortMergeJoin") == 1
    assert plan.count("Exchange hashpartitioning(track_id") == 2
    assert plan.count("PushedFilters: [IsNotNull(track_id)]") == 2


def test_each_document_is_parsed_once(spark, tmp_path):
    (tmp_path / "audio_features_a.json").write_text(json.dumps({"id": "a"}))
    plan = physical(cm.feature_rows(cm.feature_documents(spark, str(tmp_path))))
    # one form for objects, one for arrays; a row takes one of them
    assert plan.count("from_json(") == 2 and "Filter (size" not in plan
    (tmp_path / "p.json").write_text('{"items": []}')
    plan = physical(cm.track_rows(cm.playlist_items(cm.playlists(spark, f"{tmp_path}/p.json"))))
    assert plan.count("from_json(") == 1


def test_worklist_aggregates_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "tracks")
    cm.write_table(adapter.tracks(spark, SF_DIR), path)
    plan = physical(cm.fetch_worklist(cm.tracks_table(spark, path)))
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1
    assert "ReadSchema: struct<track_id:string>" in plan


def test_inventory_does_not_read_contents(spark, tmp_path):
    (tmp_path / "f").write_text("x")
    assert "content" not in physical(cm.landing_files(spark, str(tmp_path))).split("ReadSchema")[1]


class Settings(dict):
    """Stands in for a session of which only the settings are asked."""

    conf = property(lambda self: self)


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Settings({"spark.master": "yarn"}))
    named = Settings({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///shared/"})
    assert new_folder(named, "x").startswith("hdfs:///shared/x-")
    assert shared_folder(Settings({"spark.master": "local[8]"})).startswith(tempfile.gettempdir())


def test_session_helpers(spark):
    assert build_session(spark__sql__session__timeZone="UTC") is spark
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_folder(spark, "x") != new_folder(spark, "x")
    assert shuffle_partitions(0, 16) == 16
    assert shuffle_partitions(1 << 40, 16) == 4 * 4096
    assert shuffle_partitions(100 << 40, 16) == 4 * 409_600


def test_partitions_of_the_join_follow_the_stored_bytes(spark, tmp_path, monkeypatch):
    """More bytes, more partitions; a number that the user has set stays."""
    numbers = {}

    def run(name, **options):
        texts = adapter.feature_document_texts(spark, SF_DIR)
        pages = tmp_path / f"{name}-pages"
        adapter.playlist_documents(spark, SF_DIR).select("value").write.text(str(pages))
        tables = cm.Tables.under(str(tmp_path / name))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        inside = {}
        write = refresh_module.write_table

        def watched(frame, path, **own):
            if path == tables.result:
                inside["join"] = frame.rdd.getNumPartitions()
            write(frame, path, **own)

        monkeypatch.setattr(refresh_module, "write_table", watched)
        try:
            cm.refresh(spark, cm.playlists(spark, str(pages), lines=True), texts, tables, **options)
        finally:
            monkeypatch.undo()
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        numbers[name] = inside["join"]
        return session_module.stored_bytes(spark, tables.tracks, tables.features)

    run("set by the user", partition_bytes=1 << 10)
    assert numbers["set by the user"] == 8
    for name, size in (("large parts", 8 << 10), ("small parts", 2 << 10)):
        monkeypatch.setattr(session_module, "partitions_are_set", lambda _: False)
        stored = run(name, partition_bytes=size)
        assert numbers[name] == shuffle_partitions(stored, 8, size)
    assert numbers["small parts"] > numbers["large parts"] > 8
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_the_domain_moves_and_the_data_does_not(spark, tmp_path):
    path = str(tmp_path / "features")
    cm.write_table(adapter.part_features(spark, SF_DIR), path)
    rows = cm.classify(cm.features_table(spark, path))
    joined = rows.join(cm.category_domain(spark), "category")
    plan = physical(joined)
    assert "BuildRight" in plan and "BuildLeft" not in plan
    assert "Exchange hashpartitioning" not in plan and plan.count("BroadcastExchange") == 1
    broadcast = plan[plan.index("BroadcastExchange") :]
    assert "LocalTableScan" in broadcast and "FileScan" not in broadcast
    assert joined.count() == rows.count()
