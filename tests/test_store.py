"""Versions of tables: one step from one to the next, whatever fails in between."""

import json
import os
import sys
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

import cratemark as cm
from cratemark.__main__ import main
from cratemark.schemas import REQUIRED_KEYS
from cratemark.store import files as files_module
from cratemark.store import tables as tables_module
from cratemark.store.manifest import Manifest, from_text, to_text
from tests.test_refresh import LOUD, TALK, landed  # noqa: F401

publish_module = sys.modules["cratemark.plans.publish"]


@pytest.fixture
def store(spark, tmp_path):
    return cm.Store(spark, str(tmp_path / "store") + "/")


def ids(frame):
    return sorted(r.id for r in frame.collect())


def listing(folder):
    return sorted(
        os.path.relpath(os.path.join(d, f), folder)
        for d, _, names in os.walk(folder)
        for f in names
        if not f.endswith(".crc")
    )


# --- K4: replacing a table ---------------------------------------------------------------


def test_replacing_renames_nothing(spark, store):
    first = store.replace("t", spark.range(3))
    before = listing(store.folder)
    earlier = store.table("t")
    second = store.replace("t", spark.range(5, 7))
    assert (first.version, second.version, second.based_on) == (1, 2, 1)
    # What was there is there still, under the same names.
    assert set(before) <= set(listing(store.folder))
    assert ids(earlier) == [0, 1, 2] and ids(store.table("t")) == [5, 6]
    assert ids(store.table("t", version=1)) == [0, 1, 2]
    with pytest.raises(ValueError, match="no table"):
        store.table("u")
    with pytest.raises(ValueError, match="no table"):
        store.table("u", version=1)


STEPS = ["write", "put", "close"]


@pytest.mark.parametrize("step", STEPS)
def test_a_run_killed_between_steps(spark, store, monkeypatch, step):
    """Before the data is there, before the manifest is, and in the middle of it."""
    store.replace("t", spark.range(3))

    class Killed(BaseException):
        pass

    def killed(*_, **__):
        raise Killed

    frame = spark.range(5)
    if step == "write":
        frame = frame.select(F.raise_error(F.lit("lost")).cast("bigint").alias("id"))
    elif step == "put":
        monkeypatch.setattr(files_module.Folder, "put", killed)
    else:
        put = files_module.Folder.put

        def cut_off(self, name, text):
            put(self, name, text[: len(text) // 2])
            raise Killed

        monkeypatch.setattr(files_module.Folder, "put", cut_off)
    with pytest.raises(BaseException):
        store.replace("t", frame, run="nightly")
    monkeypatch.undo()
    assert ids(store.table("t")) == [0, 1, 2]
    # The repetition of the run, and the one after it, go through.
    monkeypatch.setattr(tables_module, "PATIENCE_SECONDS", 0.2)
    store.replace("t", spark.range(5), run="nightly")
    assert ids(store.table("t")) == [0, 1, 2, 3, 4]
    store.replace("t", spark.range(1))
    assert ids(store.table("t")) == [0]


def test_there_is_a_table_at_every_moment(spark, store, monkeypatch):
    """Readers look between any two operations on the file system."""
    store.replace("t", spark.range(3))
    seen = []

    def watched(name):
        operation = getattr(files_module.Folder, name)

        def run(self, *args):
            if self is store._files and not inside:
                inside.append(1)
                seen.append(ids(cm.Store(spark, store.folder).table("t")))
                inside.clear()
            return operation(self, *args)

        return run

    inside = []
    for name in ("put", "delete", "names"):
        monkeypatch.setattr(files_module.Folder, name, watched(name))
    store.replace("t", spark.range(4))
    store.expire(keep=1, grace_seconds=0)
    assert len(seen) > 4 and all(s in ([0, 1, 2], [0, 1, 2, 3]) for s in seen)


def test_partitions_and_formats(spark, store):
    frame = spark.range(6).select("id", F.concat(F.lit("c"), F.col("id") % 2).alias("c"))
    for _ in range(2):
        store.append("p", frame, partition_by="c")
    found = store.table("p")
    assert found.columns == ["id", "c"]
    assert ids(found.where("c = 'c1'")) == [1, 1, 3, 3, 5, 5]
    plan = found.where("c = 'c1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(c" in plan
    store.replace("o", frame.withColumn("run", F.lit("mine")), format="orc", compact=True)
    assert {r.run for r in store.table("o").collect()} == {"mine"}
    with pytest.raises(ValueError, match="own"):
        store.replace("o", frame.withColumn("store_run", F.lit(1)))
    store.replace("e", frame.limit(0))
    assert store.table("e").dtypes == frame.dtypes and store.table("e").count() == 0


# --- K3: appending -----------------------------------------------------------------------


def test_a_repeated_append_counts_once(spark, store):
    for _ in range(2):
        store.append("t", spark.range(2), run="monday")
    assert ids(store.table("t")) == [0, 1]
    store.append("t", spark.range(2), run="tuesday")
    store.append("t", spark.range(2), run="monday")
    assert ids(store.table("t")) == [0, 0, 1, 1]
    store.append("t", spark.range(1))
    store.append("t", spark.range(1))
    assert ids(store.table("t")) == [0, 0, 0, 0, 1, 1]
    store.replace("t", spark.range(9, 10))
    store.append("t", spark.range(2), run="monday")  # late, and still the same run
    assert ids(store.table("t")) == [9]
    with pytest.raises(ValueError, match="other columns"):
        store.append("t", spark.range(1).withColumnRenamed("id", "n"))
    with pytest.raises(ValueError, match="a run is named"):
        store.append("t", spark.range(1), run="a/b")


def test_writers_at_the_same_time(spark, store):
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda n: store.append("t", spark.range(n, n + 1), run=f"r{n}"), range(6)))
    assert ids(store.table("t")) == list(range(6))


def test_a_writer_that_was_overtaken_tries_again(spark, store, monkeypatch):
    """Its manifest was not whole yet when another one was made without it."""
    store.append("t", spark.range(1), run="a")
    put, slow = files_module.Folder.put, []

    def overtaken(self, name, text):
        if "versions" in name and not slow:
            slow.append(name)
            put(self, name, "")  # in the middle of it
            monkeypatch.setattr(tables_module, "PATIENCE_SECONDS", 0.0)
            store.append("t", spark.range(2, 3), run="c")
            os.remove(f"{self.root}/{name}")
            os.remove(f"{self.root}/{os.path.dirname(name)}/.{os.path.basename(name)}.crc")
        return put(self, name, text)

    monkeypatch.setattr(files_module.Folder, "put", overtaken)
    store.append("t", spark.range(1, 2), run="b")
    assert slow and ids(store.table("t")) == [0, 1, 2]


# --- housekeeping ------------------------------------------------------------------------


def test_expiring(spark, store):
    for n in range(4):
        store.replace("t", spark.range(n))
    store.write("t", spark.range(9), "unfinished")
    assert len(os.listdir(f"{store.folder}/data/t")) == 5
    gone = store.expire(keep=2)
    assert len(gone) == 2 and store.versions() == [3, 4]
    assert ids(store.table("t")) == [0, 1, 2] and ids(store.table("t", version=3)) == [0, 1]
    assert store.expire(keep=2) == []
    assert [g for g in store.expire(keep=2, grace_seconds=0) if "unfinished" in g]
    assert cm.Store(spark, f"{store.folder}/none").expire() == []
    with pytest.raises(ValueError):
        store.expire(keep=0)


def test_manifests_that_are_not_whole():
    text = to_text(Manifest(3, 2, {}, {"r": ("t",)}))
    assert from_text(text) == Manifest(3, 2, {}, {"r": ("t",)})
    assert [from_text(t) for t in ("", text[:-1], "{}", "[1]", text[:20])] == [None] * 5


# --- E1: the whole job -------------------------------------------------------------------


def publish(spark, landed, store, **options):  # noqa: F811
    return cm.publish(
        spark,
        cm.playlists(
            spark, str(landed / "playlists"), id_from="file_name", malformed=options.get("malformed", "fail")
        ),
        cm.feature_documents(spark, str(landed / "features")),
        store,
        **options,
    )


def browsed(store):
    return Counter(tuple(r) for r in cm.browse(store.table("categorized_tracks")).collect())


@pytest.mark.parametrize("options", [{}, {"partition_by": "category", "compact": True}])
def test_job(spark, landed, store, options):  # noqa: F811
    for n in (1, 2):
        assert publish(spark, landed, store, **options).version == n
        assert browsed(store) == {LOUD: 2, TALK: 2}
    assert store.table("tracks").count() == 7 and store.table("audio_features").count() == 5
    assert store.table("rejected_documents").collect() == []
    publish(spark, landed, store, playlist_id="q", result_mode="append")
    assert browsed(store) == {LOUD: 2, TALK: 3}


def test_all_tables_change_in_one_step(spark, landed, store, monkeypatch):  # noqa: F811
    publish(spark, landed, store)
    (landed / "playlists" / "playlist_r.json").write_text('{"items": []}')
    (landed / "playlists" / "playlist_p.json").unlink()
    seen = []
    put = files_module.Folder.put

    def watched(self, name, text):
        def sizes():
            return tuple(t.count() for t in store.tables("tracks", "categorized_tracks"))

        seen.append(sizes())
        done = put(self, name, text)
        seen.append(sizes())
        return done

    monkeypatch.setattr(files_module.Folder, "put", watched)
    publish(spark, landed, store)
    assert seen == [(7, 4), (1, 1)]


def test_rejects_in_the_same_pass(spark, landed, store, monkeypatch):  # noqa: F811
    (landed / "features" / "audio_features_x.json").write_text("<html>")
    (landed / "playlists" / "playlist_x.json").write_text("{} {}")
    (landed / "playlists" / "playlist_y.json").write_text('{"error": 1}')
    with pytest.raises(Exception, match="MALFORMED_RECORD|not a feature document|no items|not one playlist"):
        publish(spark, landed, store)
    assert store.versions() == []
    plans = {}
    write = cm.Store.write

    def watched(self, name, frame, *args, **how):
        plans[name] = frame._jdf.queryExecution().executedPlan().toString()
        return write(self, name, frame, *args, **how)

    monkeypatch.setattr(cm.Store, "write", watched)
    publish(spark, landed, store, malformed="skip")
    assert browsed(store) == {LOUD: 2, TALK: 2}
    rejected = Counter(tuple(r) for r in store.table("rejected_documents").collect())
    assert rejected == {
        ("feature", "<html>"): 1, ("playlist", "{} {}"): 1, ("playlist", '{"error": 1}'): 1,
    }
    # One scan and one parse each; the parse of a feature document has a form for
    # objects and one for arrays, and looks at raw values only where one is missing.
    assert plans["tracks"].count("FileScan") == 1 and plans["tracks"].count("from_json(") == 1
    assert plans["audio_features"].count("FileScan") == 1
    parsed = [line for line in plans["audio_features"].splitlines() if "AS entries" in line]
    assert len(parsed) == 1 and parsed[0].count("from_json(") == 2
    publish(spark, landed, store, malformed="skip", playlist_id="q")
    assert browsed(store) == {TALK: 1}
    kinds = [r.kind for r in store.table("rejected_documents").collect()]
    assert kinds == ["feature"]  # the names of the others say that they are other playlists


def test_outcomes_are_rows_and_rejects(spark):
    texts = ["<html>", "[]", "{}", '{"error": 1}', '[{"id": 1}, null]', "null"]
    measures = {k: 1 for k in REQUIRED_KEYS}
    texts += [json.dumps({"id": "a", **measures}), json.dumps([{"id": "b", **measures}, None, {"id": "c"}])]
    texts += [json.dumps({"id": "d", **measures, "tempo": "fast"}), json.dumps({"id": "e", **measures, "duration_ms": 0.5})]
    documents = spark.createDataFrame([(t,) for t in texts], "value string")
    both = cm.feature_outcomes(documents)
    rows = both.where("outcome = 'row'").drop("outcome", "value")
    assert rows.columns == cm.feature_rows(documents, malformed="skip").columns
    assert Counter(rows.collect()) == Counter(cm.feature_rows(documents, malformed="skip").collect())
    rejected = both.where("outcome = 'rejected'").select("value")
    assert Counter(rejected.collect()) == Counter(cm.rejected_documents(documents).collect())


def failing(tracks, features):
    return cm.attach_features(tracks, features).withColumn(
        "category", F.raise_error(F.lit("the join fails")).cast("string")
    )


@pytest.mark.parametrize("malformed", ["fail", "skip"])
def test_restart_reads_no_document_again(spark, landed, store, monkeypatch, malformed):  # noqa: F811
    monkeypatch.setattr(publish_module, "attach_features", failing)
    with pytest.raises(Exception, match="the join fails"):
        publish(spark, landed, store, run="nightly", malformed=malformed)
    assert store.versions() == [] and list(store.staged("nightly")) == ["tracks", "audio_features", "rejected_documents"]
    monkeypatch.undo()
    # Expiring does not touch what the run may come back to.
    store.expire(grace_seconds=0)
    unread = spark.range(1).select(F.raise_error(F.lit("read again")).cast("string").alias("value"))
    pages = unread.select("value", F.col("value").alias("playlist_id"), F.lit(None).alias("items"))
    plans = []
    write = cm.Store.write

    def watched(self, name, frame, *args, **how):
        plans.append((name, frame._jdf.queryExecution().executedPlan().toString()))
        return write(self, name, frame, *args, **how)

    monkeypatch.setattr(cm.Store, "write", watched)
    cm.publish(spark, pages, unread, store, run="nightly", malformed=malformed)
    assert browsed(store) == {LOUD: 2, TALK: 2}
    assert [name for name, _ in plans] == ["categorized_tracks"]
    assert "from_json" not in plans[0][1] and "FileScan text" not in plans[0][1]
    assert store.staged("nightly") is None
    # Once it is through, a repetition does nothing, and appends nothing.
    version = cm.publish(spark, pages, unread, store, run="nightly", result_mode="append").version
    assert version == 1 and browsed(store) == {LOUD: 2, TALK: 2}


def test_appending_runs(spark, landed, store):  # noqa: F811
    for run in ("a", "b", "a"):
        publish(spark, landed, store, run=run, result_mode="append")
    assert browsed(store) == {LOUD: 4, TALK: 4}
    with pytest.raises(ValueError):
        publish(spark, landed, store, result_mode="upsert")
    with pytest.raises(ValueError):
        cm.publish(spark, None, None, store, malformed="ignore")


def test_a_note_that_was_cut_off(spark, store):
    entry = store.write("t", spark.range(1), "r")
    store._files.put("staged/r.json", "{")
    assert store.staged("r") is None
    assert store.stage("r", {"t": entry}) == {"t": entry} == store.staged("r")
    assert store.stage("r", {}) == {"t": entry}


def test_command_line(spark, landed, store):  # noqa: F811
    arguments = [
        *("--playlists", str(landed / "playlists"), "--id-from", "file_name", "--append"),
        *("--documents", str(landed / "features"), "--output", store.folder, "--malformed", "skip"),
    ]
    for _ in range(2):
        main([*arguments, "--versions", "--run", "monday"])
    assert browsed(store) == {LOUD: 2, TALK: 2}
    with pytest.raises(SystemExit):
        main([*arguments, "--run", "monday"])
