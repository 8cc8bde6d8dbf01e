import hashlib
import math
import random
import re
import zlib

import pyarrow as pa
import pytest

from cratemark.llm import resampling
from cratemark.llm.ordering import placed
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BIG, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text):
    return WORD.findall((text or "").translate(str.maketrans(BIG, SMALL)))


def features(text, buckets, most):
    w = words(text)
    runs = [" ".join(w[i : i + n]) for n in range(1, most + 1) for i in range(len(w) - n + 1)]
    return [zlib.crc32(run.encode()) % buckets for run in runs]


def brute_force(docs, target, buckets, most, least, percent, seed):
    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for f in features(text, buckets, most):
                counts[f] += 1
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets))))
        for b in range(buckets)
    ]
    rows = []
    for i, text in docs:
        own = features(text, buckets, most)
        weight = sum(gain[f] for f in own) // len(own) if own else 0
        name = f"{seed}:{'' if i is None else i}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(words(text)), len(own), weight, score, None])
    fit = sorted(
        (r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0)
    )
    for rank, row in enumerate(fit[: percent * len(fit) // 100], 1):
        row[5] = rank
    return sorted(map(str, rows))


def texts_of(rng, n):
    letters = ["a", "B", "Z", "é", "日", "0", " ", " ", "\n", "-", " ", "😀", "_"]
    plain = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(n)]
    return plain + [None, "", "the " * 3000, "THE the", "x" * 70_000, "\x00\x7f", plain[0], plain[0]]


@pytest.mark.parametrize("most", [1, 2, 3])
def test_features_of_arrays(most):
    rng = random.Random(most)
    for _ in range(30):
        texts = texts_of(rng, 5)
        rng.shuffle(texts)
        array = pa.array(["skipped", *texts], pa.string())[1:]
        found, sizes, n_words = resampling.bucketed(array, 97, most)
        assert list(found) == [f for t in texts for f in features(t, 97, most)]
        assert list(sizes) == [len(features(t, 97, most)) for t in texts]
        assert list(n_words) == [len(words(t)) for t in texts]


def test_checksums():
    rng = random.Random(0)
    values = [rng.randbytes(rng.choice([0, 1, 2, 7, 300])) for _ in range(200)]
    array = pa.array(values, pa.binary())
    assert resampling.crc32_of(array).tolist() == [zlib.crc32(v) for v in values]
    assert resampling.crc32_of(array[50:60]).tolist() == [zlib.crc32(v) for v in values[50:60]]
    assert len(resampling.crc32_of(array[:0])) == 0


@pytest.mark.parametrize("most, percent", [(1, 30), (2, 100)])
def test_against_brute_force(spark, most, percent):
    rng = random.Random(percent)
    texts = texts_of(rng, 60)
    docs = [(None if n == 3 else n // 2, t) for n, t in enumerate(texts)] + [(7, "A b c d e f g")] * 5
    target = [t for t in texts_of(rng, 10) if t != "the " * 3000]
    named = "doc_id long, text string, place string, features string, score int"
    found = resampling.resampled(
        spark.createDataFrame([(*d, "p", "f", 1) for d in docs], named).repartition(5),
        spark.createDataFrame([(t,) for t in target], "text string"),
        buckets=101, most_words=most, least_words=4, percent=percent, seed=5,
    )
    assert found.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    rows = sorted(str(list(r)) for r in found.collect())
    assert rows == brute_force(docs, target, 101, most, 4, percent, 5)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    found = resampling.resampled(docs, docs.limit(0), least_words=1, percent=100).collect()
    assert sorted((r.doc_id, r.rank) for r in found) == [(1, 1), (2, None)]
    assert resampling.resampled(docs.limit(0), docs).collect() == []


def test_places(spark):
    rows = [(g, v) for g in (None, "a", "b") for v in [3, 1, 1, None, 2] * (40 if g == "a" else 1)]
    frame = spark.createDataFrame(rows, "g string, v int").repartition(7)
    found = placed(frame, [F.col("v").asc_nulls_first()], ["g"]).collect()
    assert len(found) == len(rows)
    for g in (None, "a", "b"):
        own = sorted((r for r in found if r.g == g), key=lambda r: r.place)
        assert [r.place for r in own] == list(range(len(own)))
        assert {r.among for r in own} == {len(own)}
        values = [-1 if r.v is None else r.v for r in own]
        assert values == sorted(values)
