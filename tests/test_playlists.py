"""Playlist documents: shapes, layouts, ids."""

import gzip
import json

import pytest

import cratemark as cm


def item(track_id, name="n", artists=("A", "B"), released="2020-05-01", **extra):
    album = {
        "album_type": "single",
        "release_date": released,
        "artists": [{"name": a, "id": "x"} for a in artists],
        "label": "unused",
    }
    return {"track": {"id": track_id, "name": name, "album": album, **extra}, "added_at": "unused"}


def write(path, document):
    text = json.dumps(document, indent=2)
    if path.suffix == ".gz":
        path.write_bytes(gzip.compress(text.encode()))
    else:
        path.write_text(text, encoding="utf-8")


def flat(documents):
    return cm.track_rows(cm.playlist_items(documents))


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_flatten_shapes(spark, tmp_path):
    write(
        tmp_path / "playlist_p1.json",
        {
            "href": "unused",
            "items": [
                item("a", "Über🎵", ("First", "Second"), "2020"),
                item("a", "Über🎵", ("First", "Second"), "2020"),
                item("b", artists=(), released="2020-05"),
                item(None, artists=("Solo",)),
                {"track": None},
                {"track": {"id": "c", "name": "bare"}},
                item(17, popularity=3),
            ],
        },
    )
    frame = flat(cm.playlists(spark, str(tmp_path)))
    assert frame.columns == ["track_id", "album_type", "name", "release_date", "artist_name"]
    assert {f.dataType.simpleString() for f in frame.schema} == {"string"}
    want = [
        ("a", "single", "Über🎵", "2020", "First"),
        ("a", "single", "Über🎵", "2020", "First"),
        ("b", "single", "n", "2020-05", None),
        (None, "single", "n", "2020-05-01", "Solo"),
        ("c", None, "bare", None, None),
        ("17", "single", "n", "2020-05-01", "A"),
    ]
    assert rows(frame) == sorted(want, key=repr)


def test_items_keep_their_position(spark, tmp_path):
    write(tmp_path / "p.json", {"items": [item("a"), {"track": None}, item("b")]})
    items = cm.playlist_items(cm.playlists(spark, str(tmp_path)))
    assert sorted((r.position, r.track.id) for r in items.collect()) == [(0, "a"), (2, "b")]


def test_many_files_plain_and_compressed(spark, tmp_path):
    write(tmp_path / "playlist_1.json", {"items": [item("a")]})
    write(tmp_path / "playlist_2.json.gz", {"items": [item("b"), item("c")]})
    write(tmp_path / "playlist_3.json", {"items": []})
    frame = flat(cm.playlists(spark, f"{tmp_path}/playlist_*.json*"))
    assert sorted(r.track_id for r in frame.collect()) == ["a", "b", "c"]


def test_select_one_playlist_by_file_name(spark, tmp_path):
    write(tmp_path / "playlist_mix7.x-y.json", {"items": [item("a")]})
    write(tmp_path / "playlist_zz.json.gz", {"items": [item("b")]})
    write(tmp_path / "other.json", {"items": [item("c")]})
    documents = cm.playlists(spark, str(tmp_path), id_from="file_name")
    assert sorted(r.playlist_id or "" for r in documents.collect()) == ["", "mix7.x-y", "zz"]
    assert [r.track_id for r in flat(cm.in_playlist(documents, "mix7.x-y")).collect()] == ["a"]
    assert [r.track_id for r in flat(cm.in_playlist(documents, "zz")).collect()] == ["b"]
    assert flat(cm.in_playlist(documents, "absent")).count() == 0


def test_select_one_playlist_by_folder_prunes(spark, tmp_path):
    for name in ("007", "8"):
        (tmp_path / f"playlist_id={name}").mkdir()
        write(tmp_path / f"playlist_id={name}" / "page.json", {"items": [item(f"t{name}")]})
    documents = cm.in_playlist(cm.playlists(spark, str(tmp_path), id_from="folder"), "007")
    assert [r.track_id for r in flat(documents).collect()] == ["t007"]
    plan = documents._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(playlist_id" in plan


def test_lines(spark, tmp_path):
    lines = [
        {"playlist_id": "1", "items": [item("a")]},
        {"playlist_id": "2", "items": [item("b"), item("b")]},
    ]
    (tmp_path / "batch.jsonl").write_text("\n".join(map(json.dumps, lines)) + "\n\n")
    documents = cm.playlists(spark, str(tmp_path), lines=True)
    assert sorted(r.track_id for r in flat(documents).collect()) == ["a", "b", "b"]
    assert flat(cm.in_playlist(documents, "2")).count() == 2


def test_id_in_document_and_argument(spark, tmp_path):
    write(tmp_path / "p.json", {"playlist_id": "x", "items": [item("a")]})
    documents = cm.playlists(spark, str(tmp_path))
    assert [r.playlist_id for r in documents.collect()] == ["x"]
    with pytest.raises(ValueError):
        cm.playlists(spark, str(tmp_path), id_from="title")


def test_lines_with_ids_in_file_names(spark, tmp_path):
    pages = [json.dumps({"items": [item(t)]}) for t in "ab"]
    (tmp_path / "playlist_q.json").write_text("\n".join(pages))
    documents = cm.playlists(spark, str(tmp_path), lines=True, id_from="file_name")
    assert flat(cm.in_playlist(documents, "q")).count() == 2


BROKEN = [
    '{"items": [',
    "<html/>",
    '{"items": 5}',
    "5",
    '{"items": []} x',
    '{"items": []}{"items": []}',
    '{"items": []}, {"items": []}',
]


@pytest.mark.parametrize("lines", [False, True])
@pytest.mark.parametrize("text", BROKEN)
def test_malformed_fails(spark, tmp_path, text, lines):
    (tmp_path / "p.json").write_text(text)
    with pytest.raises(Exception, match="MALFORMED_RECORD|one playlist document"):
        cm.playlists(spark, str(tmp_path), lines=lines).collect()


@pytest.mark.parametrize("lines", [False, True])
def test_malformed_is_skipped_and_shown(spark, tmp_path, lines):
    texts = [*BROKEN, '{"error": 1}', '{"items": null}']
    for n, text in enumerate(texts):
        (tmp_path / f"playlist_{n}.json").write_text(text)
    (tmp_path / "playlist_good.json").write_text(json.dumps({"items": [item("a"), item("b")]}))
    documents = cm.playlists(
        spark, str(tmp_path), lines=lines, id_from="file_name", malformed="skip"
    )
    found = cm.track_rows(cm.playlist_items(documents, malformed="skip"))
    assert sorted(r.track_id for r in found.collect()) == ["a", "b"]
    rejected = {r.playlist_id: r.value for r in cm.rejected_playlists(documents).collect()}
    assert rejected == {str(n): text for n, text in enumerate(texts)}


def test_a_blank_file_is_no_document(spark, tmp_path):
    (tmp_path / "p.json").write_text(" ")
    with pytest.raises(Exception, match="one playlist document"):
        cm.playlists(spark, str(tmp_path)).collect()
    assert cm.playlists(spark, str(tmp_path), lines=True).collect() == []


def test_lines_read_as_one_document_fail(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"items": []}\n{"items": []}\n')
    with pytest.raises(Exception, match="MALFORMED_RECORD|one playlist document"):
        cm.playlists(spark, str(tmp_path)).collect()


def test_an_empty_file_holds_nothing(spark, tmp_path):
    (tmp_path / "p.json").touch()
    write(tmp_path / "q.json", {"items": [item("a")]})
    assert cm.playlists(spark, str(tmp_path)).count() == 1


@pytest.mark.parametrize("text", ['{"error": {"status": 401}}', '{"items": null}'])
@pytest.mark.parametrize("lines", [False, True])
def test_document_without_items(spark, tmp_path, text, lines):
    (tmp_path / "p.json").write_text(text)
    documents = cm.playlists(spark, str(tmp_path), lines=lines)
    with pytest.raises(Exception, match="has no items"):
        cm.playlist_items(documents).collect()
    assert cm.playlist_items(documents, malformed="skip").collect() == []
    with pytest.raises(ValueError):
        cm.playlist_items(documents, malformed="ignore")


@pytest.mark.parametrize("malformed", ["fail", "skip"])
def test_empty_files_hold_nothing(spark, tmp_path, malformed):
    for name, text in {"a": b"", "c": b'{"playlist_id": "c", "items": []}'}.items():
        (tmp_path / f"{name}.json").write_bytes(text)
        (tmp_path / f"{name}z.json.gz").write_bytes(gzip.compress(text))
    frame = cm.playlists(spark, str(tmp_path), malformed=malformed)
    assert [r.playlist_id for r in frame.collect()] == ["c", "c"]
