"""The derived inputs themselves: the counts that ``FIXTURES.md`` gives."""

import json
import os
from collections import Counter
from urllib.parse import unquote, urlparse

import pytest

import __spark_entry__ as entry
import cratemark as cm
from testbed import adapter

# Labels per part at each scale factor.
LABELS = {
    "sf0.001": {"Classic🏛️": 7, "Electro⚡": 9, "HipHop🎤": 5, "Metal🤘": 5, "Other🦦": 58,
                "Podcast🎧": 38, "Soul🎷": 2, "Vocal🎤": 76},
    "sf0.01": {"Classic🏛️": 73, "Electro⚡": 49, "HipHop🎤": 36, "Metal🤘": 100, "Other🦦": 633,
               "Podcast🎧": 365, "Soul🎷": 16, "Vocal🎤": 728},
    "sf0.1": {"Classic🏛️": 835, "Electro⚡": 436, "HipHop🎤": 318, "Metal🤘": 1012, "Other🦦": 6367,
              "Podcast🎧": 3611, "Soul🎷": 150, "Vocal🎤": 7271},
}


@pytest.mark.parametrize("sf", LABELS)
def test_labels_per_part(spark, sf):
    rows = cm.classify(adapter.part_features(spark, f"/root/testdata/{sf}")).select("category")
    assert Counter(r.category for r in rows.collect()) == LABELS[sf]


def test_pages_lose_no_item(spark, monkeypatch):
    """Playlists cut into many small pages give the same tracks."""
    sf_dir = "/root/testdata/sf0.001"
    want = Counter(tuple(r) for r in adapter.tracks(spark, sf_dir).collect())
    monkeypatch.setattr(adapter, "PAGE_ROWS", 50)
    texts = adapter.playlist_documents(spark, sf_dir)
    parsed = texts.selectExpr(
        "from_json(value, 'playlist_id string, items array<struct<track:struct<id:string,"
        "name:string,album:struct<album_type:string,release_date:string,"
        "artists:array<struct<name:string>>>>>>') AS d"
    ).select("d.*")
    got = Counter(tuple(r) for r in cm.track_rows(cm.playlist_items(parsed)).collect())
    assert got == want


def _tables(spark, folder, rows, a_file=3):
    """Tables of line items (order, part, supplier), dealt over many files."""
    items = spark.createDataFrame(rows, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint")
    items = items.selectExpr("*", "timestamp'1995-01-02' AS l_shipdate").repartition(8)
    items.write.option("maxRecordsPerFile", a_file).parquet(f"{folder}/lineitem.parquet")
    part = "id AS p_partkey; 'n' || id AS p_name; 'b' AS p_brand; 't' AS p_type"
    spark.range(4).selectExpr(*part.split("; ")).write.parquet(f"{folder}/part.parquet")
    supplier = spark.range(4).selectExpr("id AS s_suppkey", "'s' || id AS s_name")
    supplier.write.parquet(f"{folder}/supplier.parquet")
    return str(folder)


def test_scattered_playlists_have_as_few_pages_as_they_need(spark, tmp_path, monkeypatch):
    rows = [(n, n % 4, n % 3) for n in range(90)] + [(1, 1, None), (2, None, 1), (None, 1, 2)]
    sf_dir = _tables(spark, tmp_path, rows)
    want = Counter(tuple(r) for r in adapter.tracks(spark, sf_dir).collect())
    assert sum(want.values()) == 91

    def documents():
        return adapter.playlist_documents(spark, sf_dir, "l_suppkey", own_pages=True)

    assert sorted(r.playlist_id for r in documents().collect()) == ["0", "1", "2"]
    files = entry._landed_playlist_files(spark, sf_dir)
    assert files.select("playlist_id").distinct().count() == len(files.inputFiles()) == 3
    assert Counter(tuple(r) for r in cm.track_rows(cm.playlist_items(files)).collect()) == want

    monkeypatch.setattr(adapter, "PAGE_ROWS", 10)
    sizes = [len(json.loads(r.value)["items"]) for r in documents().collect()]
    assert sum(sizes) == 91 and 3 < len(sizes) <= 12
    files = entry._landed_playlist_files(spark, sf_dir)
    assert Counter(tuple(r) for r in cm.track_rows(cm.playlist_items(files)).collect()) == want


def test_landed_documents_take_few_bytes(spark, tmp_path):
    """The landed files are a fraction of the texts, which come back as they were."""
    sf_dir = _tables(spark, tmp_path, [(n // 3, n % 4, n % 3) for n in range(6000)], 1000)
    want = sorted(r.value for r in adapter.playlist_documents(spark, sf_dir).collect())
    landed = entry._landed_playlists(spark, sf_dir)
    assert sorted(r.value for r in landed.collect()) == want
    files = [unquote(urlparse(name).path) for name in landed.inputFiles()]
    assert sum(map(os.path.getsize, files)) < sum(map(len, want)) / 3
