"""Importance resampling towards a target distribution of hashed word runs.

A document's features are its runs of one to ``most_words`` consecutive words,
hashed to buckets by CRC32. The corpus and a target corpus each give a
distribution over the buckets; a document's weight is the mean logarithm of how
much likelier the target makes its features. Gumbel noise on top of the weights
makes the highest scores a sample without replacement.

Checksums are computed on Arrow batches. The distinct features of a batch are
grouped by their length in bytes; each group is a matrix of bytes with a feature a
row, and all its checksums advance together, a column at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratemark.llm.ordering import placed
from cratemark.llm.storage import stored

BUCKETS = 10_000
MOST_WORDS = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
# A feature longer than this is a matrix of its own with more columns than it is
# worth; such junk words are summed one by one.
LONG = 512
# Texts of a batch are worked on in slices of about so many bytes.
SLICE_BYTES = 8 << 20


def _crc_table() -> np.ndarray:
    """The 256 steps of CRC32, from its (reflected) polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


_CRC = _crc_table()
# Bytes of words: digits, small letters, and all bytes of characters beyond ASCII.
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[ord("0") : ord("9") + 1] = True
_IN_WORD[ord("a") : ord("z") + 1] = True
_IN_WORD[0x80:] = True


def _buffers(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of an array of strings or binaries without nulls."""
    wide = pa.types.is_large_string(strings.type) or pa.types.is_large_binary(strings.type)
    _, offsets, data = strings.buffers()
    kind = np.int64 if wide else np.int32
    if not len(strings):
        return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    at = np.frombuffer(offsets, dtype=kind)[strings.offset : strings.offset + len(strings) + 1]
    flat = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    return at.astype(np.int64) - int(at[0]), flat[int(at[0]) : int(at[-1])]


def crc32_of(distinct: pa.Array) -> np.ndarray:
    """CRC32 of every (non-null) string or binary, by length-bucketed matrices; those
    beyond LONG bytes one by one."""
    offsets, data = _buffers(distinct)
    lengths = np.diff(offsets)
    sums = np.zeros(len(lengths), dtype=np.uint32)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        if length > LONG:
            for row in rows:
                sums[row] = zlib.crc32(data[offsets[row] : offsets[row + 1]])
            continue
        matrix = data[offsets[rows][:, None] + np.arange(length)]
        crc = np.full(len(rows), 0xFFFFFFFF, dtype=np.uint32)
        for column in range(length):
            crc = _CRC[(crc ^ matrix[:, column]) & 0xFF] ^ (crc >> np.uint32(8))
        sums[rows] = crc ^ np.uint32(0xFFFFFFFF)
    return sums


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of ``texts`` in order, and how many each text has."""
    offsets, data = _buffers(pc.ascii_lower(texts.fill_null("")))
    inside = _IN_WORD[data]
    # A word begins where the byte before is none of a word, or of another text.
    fresh = inside.copy()
    fresh[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    fresh[heads] = inside[heads]
    starts = np.flatnonzero(fresh)
    kept = np.concatenate([[0], np.cumsum(inside)])
    ends = np.append(kept[starts], kept[-1]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data[inside].tobytes())]
    )
    return words, np.diff(np.searchsorted(starts, offsets))


def bucketed(texts: pa.Array, buckets: int, most_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket of every feature, text by text; how many features, and how many
    words, each text has."""
    words, n_words = _words(texts)
    owner = np.repeat(np.arange(len(n_words)), n_words)
    found, owners, runs = [], [], words
    for size in range(1, most_words + 1):
        if size > 1:
            # Runs of one word less, each with the word that follows them.
            runs = pc.binary_join_element_wise(runs[:-1], words[size - 1 :], pa.scalar(b" ", pa.large_binary()))
        held = owner[: len(runs)] == owner[size - 1 :] if len(runs) else np.zeros(0, dtype=bool)
        coded = (runs.filter(pa.array(held)) if size > 1 else runs).dictionary_encode()
        sums = crc32_of(coded.dictionary) % np.uint32(buckets)
        found.append(sums[coded.indices.to_numpy(zero_copy_only=False)].astype(np.int32))
        owners.append(owner[: len(runs)][held])
        if len(runs) < 2:
            break
    features, owners = np.concatenate(found), np.concatenate(owners)
    if most_words > 1:
        features = features[np.argsort(owners, kind="stable")]
    return features, np.bincount(owners, minlength=len(n_words)), n_words


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices whose texts have about SLICE_BYTES, one text at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes.astype(np.int64)) // SLICE_BYTES
    edges = np.flatnonzero(np.diff(group)) + 1
    for start, end in zip(np.append(0, edges), np.append(edges, len(sizes))):
        if end > start:
            yield batch.slice(start, end - start)


def hashed(docs: DataFrame, text_col: str, id_col: str, buckets: int, most_words: int) -> DataFrame:
    """Per row: id, n_words, n_features and ``features``, the bucket of each. A null
    text has no words."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, 1):
                features, sizes, words = bucketed(batch.column(1), buckets, most_words)
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(words.astype(np.int64)),
                        pa.array(sizes.astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(features, pa.int32())),
                    ],
                    ["id", "n_words", "n_features", "features"],
                )

    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(
        run, f"id {id_type}, n_words bigint, n_features bigint, features array<int>"
    )


def counted(features: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n) over the ``features`` arrays. Each task adds up its own features
    and hands on a row for each bucket, so that no word, however common, weighs
    more than that in the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["bucket", "n"]
        )

    parts = features.select("features").mapInArrow(run, "bucket int, n bigint")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """(bucket, gain): floor(1000 ln) of how much likelier the target makes a bucket,
    each bucket counted once more than it occurs. All buckets have a row."""

    def all_of(df: DataFrame) -> Column:
        return F.coalesce(df.agg(F.sum("n")).scalar(), F.lit(0))

    every = source.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    counts = every.join(source.withColumnRenamed("n", "s"), "bucket", "left").join(
        target.withColumnRenamed("n", "t"), "bucket", "left"
    )
    s, t = (F.coalesce(F.col(c), F.lit(0)).cast("double") + 1 for c in ("s", "t"))
    ratio = t * (all_of(source).cast("double") + buckets) / (s * (all_of(target).cast("double") + buckets))
    return counts.select("bucket", F.floor(F.log(ratio) * 1000).alias("gain"))


def _weighed(features: DataFrame, table: np.ndarray) -> DataFrame:
    """``features`` with the floored mean of the gains in place of the arrays."""
    kept = [f for f in features.schema if f.name != "features"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", weight bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.names.index("features"))
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            gained = table[lists.flatten().to_numpy(zero_copy_only=False)]
            running = np.concatenate([[0], np.cumsum(gained)])
            ends = np.cumsum(sizes)
            sums = running[ends] - running[ends - sizes]
            weights = np.where(sizes > 0, sums // np.maximum(sizes, 1), 0)
            arrays = [batch.column(batch.schema.names.index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(weights.astype(np.int64))], [*(f.name for f in kept), "weight"]
            )

    return features.mapInArrow(run, schema)


def gumbel(id_col: Column, seed: int) -> Column:
    """Noise of a row from its id: floor(-1000 ln(-ln(u))) with u from a hash."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000)


def resampled(
    docs: DataFrame, target: DataFrame, text_col: str = "text", id_col: str = "doc_id",
    buckets: int = BUCKETS, most_words: int = MOST_WORDS, least_words: int = LEAST_WORDS,
    percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_features, weight, score and rank, from 1
    for the best of the rows that are drawn; the others' rank is null.

    ``percent`` per cent (rounded down) of the rows with ``least_words`` words are
    drawn, ties to the smaller id. ``target`` needs the column ``text_col`` only.

    What goes through the driver is one number for each of ``buckets`` buckets,
    whatever the size of the corpus. Documents are read once: what is kept of them
    are their buckets.

    Nulls: a null text has no words, a weight of 0 and is not drawn; a null id is
    the empty text in the hash, and comes before other ids in a tie. Rows with the
    same id and text have the same score; each has its own rank, in any but a fixed
    order. An empty target counts as one with no features, an empty table gives no
    rows. Other columns are not read.
    """
    found = stored(hashed(docs, text_col, id_col, buckets, most_words), "resampling-features")
    aims = hashed(target.select(F.lit(0).alias("id"), target[text_col].alias("text")), "text", "id", buckets, most_words)
    known = stored(
        gains(stored(counted(found, buckets), "resampling-source"), stored(counted(aims, buckets), "resampling-target"), buckets),
        "resampling-gains",
    )
    table = np.zeros(buckets, dtype=np.int64)
    for row in known.collect():  # one row a bucket
        table[row.bucket] = row.gain
    scored = _weighed(found, table).withColumn("score", F.col("weight") + gumbel(F.col("id"), seed))
    fit = F.col("n_words") >= least_words
    ranked = placed(
        scored, [fit.desc(), F.col("score").desc(), F.col("id").asc_nulls_first()], name="resampling-order"
    )
    drawn = F.floor(found.where(fit).agg(F.count("*")).scalar() * percent / 100)
    return ranked.select(
        F.col("id").alias(id_col),
        "n_words",
        "n_features",
        "weight",
        "score",
        F.when(F.col("place") < drawn, F.col("place") + 1).alias("rank"),
    )
