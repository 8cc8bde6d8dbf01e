"""The whole job on random documents, against a few lines of plain Python."""

import json
import random
from collections import Counter

import pytest

import cratemark as cm
from cratemark.schemas import REQUIRED_KEYS, RESULT_COLUMNS

from .test_rules import TESTED, expected


def random_documents(seed):
    rng = random.Random(seed)
    ids = [f"t{i}" for i in range(300)]

    def item():
        # a third of all items is one track
        track_id = "t0" if rng.random() < 1 / 3 else rng.choice(ids + [None])
        artists = [{"name": f"artist {rng.randrange(20)}"} for _ in range(rng.randrange(3))]
        released = rng.choice(["1999", "2020-05", "2021-01-31", None])
        album = {"album_type": rng.choice(["album", "single"]), "artists": artists}
        album["release_date"] = released
        track = {"id": track_id, "name": f"name of {track_id}", "album": album}
        return {"track": None if rng.random() < 0.05 else track}

    def entry(track_id):
        values = {k: round(rng.random(), 1) for k in REQUIRED_KEYS}
        values |= {"tempo": rng.choice([90, 100, 110, 120, 130.5, 140, 150])}
        values |= {"duration_ms": rng.randrange(1000, 9000), "id": track_id}
        for key in REQUIRED_KEYS:
            if rng.random() < 0.03:
                values[key] = None
        if rng.random() < 0.1:
            values.pop(rng.choice(list(values)))
        return values

    def document(track_id):
        kind = rng.random()
        if kind < 0.1:
            return {"error": {"status": 404}}
        if kind < 0.4:
            return [entry(rng.choice([track_id, *ids])) for _ in range(rng.randrange(4))]
        return entry(track_id)

    playlists = [{"items": [item() for _ in range(rng.randrange(40))]} for _ in range(40)]
    return playlists, [document(i) for i in ids + ids[:50]]


def by_hand(playlists, documents):
    features = {}
    for document in documents:
        entries = document if isinstance(document, list) else [document]
        if entries and set(REQUIRED_KEYS) <= entries[0].keys():
            for e in entries:
                if e.get("id") is not None:
                    features.setdefault(e["id"], []).append([e.get(k) for k in REQUIRED_KEYS])
    rows = []
    for playlist in playlists:
        for track in (i["track"] for i in playlist["items"] if i["track"]):
            album = track["album"]
            artist = album["artists"][0]["name"] if album["artists"] else None
            for values in features.get(track["id"], []):
                named = dict(zip(REQUIRED_KEYS, values))
                category = expected(*[named[n] for n in TESTED])
                front = (track["id"], album["album_type"], track["name"], album["release_date"])
                rows.append((*front, artist, *values, category))
    return Counter(rows)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("lines", [False, True], ids=["files", "lines"])
def test_refresh(spark, tmp_path, seed, lines):
    playlists, documents = random_documents(seed)
    for folder, prefix, texts in (
        ("playlists", "playlist_", playlists),
        ("documents", "audio_features_", documents),
    ):
        (tmp_path / folder).mkdir()
        if lines:
            text = "\n".join(map(json.dumps, texts))
            (tmp_path / folder / "all.jsonl").write_text(text)
        else:
            for number, document in enumerate(texts):
                path = tmp_path / folder / f"{prefix}{number}.json"
                path.write_text(json.dumps(document, indent=seed))
    tables = cm.Tables.under(str(tmp_path / "out"))
    cm.refresh(
        spark,
        cm.playlists(spark, str(tmp_path / "playlists"), lines=lines),
        cm.feature_documents(spark, str(tmp_path / "documents"), lines=lines),
        tables,
    )
    result = cm.result_table(spark, tables.result)
    assert result.columns == list(RESULT_COLUMNS)
    want = by_hand(playlists, documents)
    assert len(want) > 100
    assert Counter(tuple(r) for r in result.collect()) == want
