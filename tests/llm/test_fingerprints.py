import hashlib
import re
import struct

import pytest
import xxhash

from cratemark.llm import fingerprints

MASK = (1 << 64) - 1


def chained(values, seed=42):
    for v in values:
        data = v.encode() if isinstance(v, str) else struct.pack("<q", v - (1 << 64) if v >> 63 else v)
        seed = xxhash.xxh64_intdigest(data, seed & MASK)
    return seed


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def reference(text, bins=128, shingle=5):
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", text or "") if w]
    hashed = [chained([w]) for w in words]
    if not hashed:
        return ""
    if len(hashed) < shingle:
        shingles = {chained([" ".join(str(signed(h)) for h in hashed)])}
    else:
        shingles = {chained(hashed[i : i + shingle]) for i in range(len(hashed) - shingle + 1)}
    held = {}
    for h in shingles:
        b = h >> 57
        held[b] = min(held.get(b, h), h)
    out = []
    for b in range(bins):
        source = b if b in held else min(held, key=lambda x: signed(chained([b, x])))
        out.append(f"{held[source] & 0xFF:02x}")
    return "".join(out)


TEXTS = [
    "one two three four five six seven eight nine ten " * 3,
    "one two three four five six seven eight nine ten " * 3,
    None,
    "",
    "  \t ",
    "short text",
    "ünïcödé wörds " * 40 + " ".join(f"word{i}" for i in range(400)),
    " ".join(f"word{i}" for i in range(420)),
    "x" * 50000,
]


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i * 10, t, i, "a") for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `row` int, n_chars string")
    result = fingerprints.fingerprints_with_edits(docs.repartition(4)).collect()
    return {r.doc_id // 10: r for r in result}


def test_against_brute_force(found):
    assert len(found) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        text, after = text or "", TEXTS[(i + 1) % len(TEXTS)] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        row = found[i]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.fingerprint == reference(text)
        assert row.edited_fingerprint == reference(edited)


def test_likeness(found):
    assert found[0].fingerprint == found[1].fingerprint and found[0].near_next == 1.0
    assert found[2].fingerprint == "" and found[2].near_next == 1.0
    assert found[4].near_next == 0.0
    # 396 shingles of 416 + 36 repeats of unusual words are the same.
    assert 0.75 < found[6].near_next < 1.0
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found.values())


def test_nulls_repeats_and_empty_table(spark):
    docs = spark.createDataFrame(
        [(None, "a b c d e f"), (None, None), (3, "a b c d e f"), (3, "a b c d e f")],
        "doc_id long, text string",
    )
    assert len(fingerprints.fingerprints_with_edits(docs).collect()) == 4
    alone = fingerprints.fingerprints_with_edits(docs.limit(1)).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0
    assert fingerprints.fingerprints_with_edits(docs.limit(0)).collect() == []
