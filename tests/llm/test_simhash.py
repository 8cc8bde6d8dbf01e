import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cratemark.llm import simhash
from cratemark.llm.components import components


def by_hand(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0d]+", lowered)
    if not words:
        return 0
    n = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_the_code_is_perfect():
    offsets = simhash._offsets(0)
    assert len(offsets) == 2048 and all(len(row[0]) == 1 for row in offsets)


@pytest.mark.parametrize("blocks", [1, 2])
def test_visitors_reach_every_home_within_three_bits(blocks):
    rng = np.random.default_rng(blocks)
    for _ in range(60):
        x = rng.integers(0, 1 << 63, dtype=np.int64)
        flips = sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 4), replace=False))
        a, b = simhash.anchors_of(np.array([x, x ^ flips]), blocks, 3)
        assert a[0] in b and b[0] in a and len(set(b.tolist())) == len(b)


@pytest.mark.parametrize("blocks", [1, 2])
def test_components_against_brute_force(spark, blocks, monkeypatch):
    monkeypatch.setattr(simhash, "_HOMES", 16)  # crowded anchors are dealt out
    rng = random.Random(7)
    seeds = [rng.getrandbits(64) for _ in range(12)]
    fps = {x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for x in seeds for _ in range(25)}
    fps |= {(seeds[0] & ~0x3F) | k for k in range(64)} | {0, (1 << 64) - 1}
    frame = spark.createDataFrame([(signed(x),) for x in fps] * 2, "fp long")
    found = {r.node: r.root for r in components(simhash.near_links(frame, 3, blocks)).collect()}
    values = np.array(sorted(fps), dtype=np.uint64)
    links = [
        (signed(int(x)), signed(int(values[j])))
        for x in values
        for j in np.flatnonzero(np.bitwise_count(values ^ x) <= 3)
    ]
    want = roots([signed(x) for x in fps], links)
    assert {n: found.get(n, n) for n in want} == want


def test_near_duplicates(spark):
    base = [f"word{i}" for i in range(400)]
    rows = [(10, " ".join(base)), (3, " ".join(base).upper()), (4, " ".join(base[:-1] + ["other"]))]
    rows += [(7, ""), (6, None), (None, " \t"), (8, "one two"), (9, "One  two"), (9, "one two"), (1, "x" * 100000)]
    docs = spark.createDataFrame([(i, t, 0, 0) for i, t in rows], "doc_id long, text string, fp int, _text int")
    found = simhash.near_duplicates(docs).withColumn("hex", simhash.hex_digits(F.col("fp"))).collect()
    assert len(found) == len(rows)
    assert sorted(r.hex for r in found) == sorted(f"{by_hand(t):016x}" for _, t in rows)
    fps = {i: by_hand(t) for i, t in rows if i is not None}
    links = [(a, b) for a in fps for b in fps if (fps[a] ^ fps[b]).bit_count() <= 3]
    want = roots(list(fps), links)
    assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == want
    assert want[10] == 3 and want[7] == 6 and want[9] == 8
    assert [r.component_id for r in found if r.doc_id is None] == [6]
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["None", *(str(i) for i in want if want[i] == i)])
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_components_of_chains_stars_and_nulls(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(5, 5), (None, 3), (200, 201), (201, 200)]
    frame = spark.createDataFrame(links, "a long, b long")
    found = {r.node: r.root for r in components(frame).collect()}
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 200, 201: 200}
    assert found == want
    assert components(frame.limit(0)).collect() == []


def test_one_row_of_repeated_ids(spark):
    rows = [(5, "one two"), (3, "one two"), (3, "One two"), (3, "x" * 90), (5, "y y y"), (None, "one two")]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, place int").coalesce(1)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.place for r in kept.collect()) == [1, 3, 4, 5]
