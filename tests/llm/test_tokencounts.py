import os
import random

import numpy as np
import pytest

from cratemark.llm import tokencounts

END = 9


def lengths(ids, end):
    """Brute force over one file."""
    out, n = [], 0
    for i in ids:
        if i == end:
            out.append(n)
            n = 0
        else:
            n += 1
    return out + [n] * (n > 0)


def cut(ids, size, dtype):
    return [np.array(ids[i : i + size], dtype=dtype).tobytes() for i in range(0, len(ids), size)]


@pytest.mark.parametrize("size, dtype", [(1, "<u2"), (4, "<u2"), (7, "<u4"), (1000, "<u4")])
def test_scan_against_brute_force(spark, size, dtype):
    rng = random.Random(size)
    files = {
        f"f{k}": [rng.choice([END, 1, 2, 3] if k % 2 else [END] + [5] * 20) for _ in range(k * 23)]
        for k in range(6)
    }
    files["long"] = [5] * 50 + [END] + [5] * 60
    files["ends"] = [END] * 5
    rows = [(f, b, data) for f, ids in files.items() for b, data in enumerate(cut(ids, size, dtype))]
    rows.append(("null", 0, None))
    blocks = spark.createDataFrame(rows, "file string, block int, data binary").repartition(5)
    found = {}
    for r in tokencounts.document_lengths(blocks, END, int(dtype[-1])).collect():
        found.setdefault(r.file, {})[r.ordinal] = r.n_tokens
    expected = {f: dict(enumerate(lengths(ids, END))) for f, ids in files.items()}
    assert found == {f: x for f, x in expected.items() if x}


def test_raw_files(spark, tmp_path):
    ids = [1, 2, END, 3, END, END, 4, 5, 6]
    (tmp_path / "a.bin").write_bytes(np.array(ids, dtype="<u2").tobytes())
    (tmp_path / "b.bin").write_bytes(b"")
    blocks = tokencounts.read_flat_files(spark, str(tmp_path), block_bytes=4)
    found = tokencounts.document_lengths(blocks, END).collect()
    assert sorted((r.ordinal, r.n_tokens) for r in found) == [(0, 2), (1, 1), (2, 0), (3, 3)]


@pytest.mark.skipif(
    not os.path.exists("/opt/tokenizers/byte_bpe_50k.tiktoken"), reason="no public vocabulary here"
)
def test_counts_are_those_of_the_tokenizer(spark):
    vocabulary, end = "/opt/tokenizers/byte_bpe_50k.tiktoken", 50256
    texts = [
        "The quick brown fox", "", None, "été à  Paris \n\n 12345 !!", "<|endoftext|>", "x" * 5000,
        " ".join(f"word{i}  and" for i in range(5000)), "The quick brown fox",
    ]
    rows = [(None if i == 3 else i, t, "f") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, file string")
    found = tokencounts.token_counts(docs.repartition(3), vocabulary, end, block_bytes=64, stretch=100)
    encode = tokencounts._encoding(vocabulary).encode_ordinary
    expected = sorted((str(i), len(encode(t or ""))) for i, t, _ in rows)
    assert sorted((str(r.doc_id), r.n_tokens) for r in found.collect()) == expected
    assert tokencounts.token_counts(docs.limit(0), vocabulary, end).collect() == []
