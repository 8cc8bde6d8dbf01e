"""Inventories made by tasks, and packing of small or unsplittable files."""

import gzip
import json
import os
from collections import Counter

import pytest

import cratemark as cm
from cratemark.sources.landing import _list_folder, _pattern
from tests.test_feature_documents import full, ids


def files(folder):
    return sorted(f for f in os.listdir(folder) if f.startswith("part-"))


@pytest.fixture
def landed(tmp_path):
    """Folders of folders, odd names, and what readers pass over."""
    for name, size in {
        "top.json": 3, "a/audio_features_1.json": 5, "a/b/audio_features_2.json.gz": 7, "a/b/c/d/x.txt": 0,
        "e%20 é/y.json": 2, "day=_1/z.json": 1, "a/_temporary/no.json": 9, "a/.hidden": 9, ".dot/no.json": 9,
        "_SUCCESS": 0, "a/part._COPYING_": 4, "_kept=1/k.json": 6,
    }.items():
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(b"x" * size)
    (tmp_path / "in" / "empty").mkdir()
    return tmp_path / "in"


@pytest.mark.parametrize("levels", [0, 1, 2, 9])
@pytest.mark.parametrize("file_filter", [None, "*.json", "audio_features_*.{json,json.gz}"])
def test_tasks_list_what_the_index_lists(spark, landed, levels, file_filter):
    expected = cm.landing_files(spark, str(landed), file_filter)
    found = cm.landing_files(spark, str(landed), file_filter, levels=levels)
    assert found.columns == expected.columns == ["path", "length", "modificationTime"]
    assert found.schema["modificationTime"].dataType == expected.schema["modificationTime"].dataType

    def rows(frame):
        return Counter((r.path, r.length, r.modificationTime.replace(microsecond=0)) for r in frame.collect())

    assert rows(found) == rows(expected) and found.count() > 1


def test_no_list_of_files_in_the_driver(spark, landed, monkeypatch):
    plan = cm.landing_files(spark, [str(landed / "a"), f"file://{landed}/day=_1"], levels=1)
    assert sorted(r.length for r in plan.collect()) == [1, 5, 7]
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in text and "MapInArrow" in text
    with pytest.raises(Exception):
        cm.landing_files(spark, str(landed / "absent"), levels=1).collect()
    monkeypatch.setattr("cratemark.sources.landing._SCHEMES", {})
    with pytest.raises(ValueError, match="leave levels out"):
        cm.landing_files(spark, str(landed), levels=1)
    monkeypatch.undo()
    assert next(iter(_list_folder(f"file:{landed}/day=_1", True)))[0] == f"file:{landed}/day=_1/z.json"


def test_patterns():
    assert _pattern("a_{1,2{x,y}}.json").match("a_2y.json")
    assert not _pattern("a_{1,2}.json").match("a_3.json")
    assert not _pattern("*.json").match("a.json.gz")


@pytest.mark.parametrize("indent", [None, 1])
def test_packing_one_file_per_track(spark, tmp_path, indent):
    source, want = tmp_path / "in", []
    source.mkdir()
    for k in range(300):
        document = [full(f"t{k}")] if k % 7 == 0 else {"error": k} if k % 10 == 0 else full(f"t{k}")
        if k % 7 == 0 or k % 10:
            want.append(f"t{k}")
        text = json.dumps(document, indent=indent).encode()
        if k % 3:
            (source / f"audio_features_t{k}.json").write_bytes(text.replace(b"\n", b"\r\n"))
        else:
            (source / f"audio_features_t{k}.json.gz").write_bytes(gzip.compress(text))
    (source / "audio_features_none.json.gz").write_bytes(gzip.compress(b""))
    (source / "notes.txt").write_text("not a document")
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")}
    total = sum(f.stat().st_size for f in source.iterdir())
    for size in (total // 4, 1 << 30):
        target = str(tmp_path / f"packed-{size}")
        cm.pack_documents(spark, str(source), target, file_filter="audio_features_*", file_bytes=size)
        # As many files as the bytes make, each entry counted with its small cost.
        assert len(files(target)) == 1 if size == 1 << 30 else 4 <= len(files(target)) <= 8
        packed = cm.feature_documents(spark, target, lines=True)
        assert packed.count() == 300
        assert ids(cm.feature_rows(packed)) == sorted(want)
    assert before == {k: spark.conf.get(k, None) for k in before}
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        cm.pack_documents(spark, str(source), target)


def test_a_large_gzip_is_split(spark, tmp_path):
    texts = [json.dumps(full(f"t{k}")) for k in range(2000)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "all.json.gz").write_bytes(gzip.compress("\n".join(texts + ["", " "]).encode()))
    whole = cm.feature_documents(spark, str(tmp_path / "in"), lines=True)
    assert whole.rdd.getNumPartitions() == 1
    target = str(tmp_path / "out")
    packed_bytes = os.path.getsize(tmp_path / "in" / "all.json.gz")
    cm.pack_documents(spark, str(tmp_path / "in"), target, lines=True, file_bytes=packed_bytes)
    assert len(files(target)) == 8
    sizes = [os.path.getsize(f"{target}/{f}") for f in files(target)]
    assert max(sizes) < 2 * min(sizes)
    again = cm.feature_documents(spark, target, lines=True)
    assert again.rdd.getNumPartitions() > 1
    assert ids(cm.feature_rows(again)) == ids(cm.feature_rows(whole))
