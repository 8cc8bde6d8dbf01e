"""SimHash near-duplicates by anchor-point covering.

Anchors are the words of a covering code. The code here is the perfect binary
Golay code of length 23 (4096 words, covering radius 3), applied to bits 0-22 of
the fingerprint, and for large sets also to bits 23-45. With ``blocks`` codes
side by side, every fingerprint is within the covering radius R = 3 * blocks of
exactly one anchor, its home, and two fingerprints of at most t differing bits
are both within R + t of the home of either: each block of the second is as far
from the anchor as that of the first, plus what differs in the block. Each
fingerprint therefore goes to its home and, as a visitor, to all anchors that
such a partner could have for its home; per anchor, homes are compared with all.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratemark.llm.components import components
from cratemark.llm.storage import fits, stored

SHINGLE = 3
MOST_BITS = 3
SEED = 42

# Generator polynomial of the perfect Golay code: x^11+x^9+x^7+x^6+x^5+x+1.
_GOLAY = 0b101011100011
_LENGTH, _CHECKS, _RADIUS = 23, 11, 3
# Distinct fingerprints above which a second block keeps anchors small.
_ONE_BLOCK = 1 << 22
# Homes of one anchor that one comparison takes; more are dealt to several.
_HOMES = 4096


# --- fingerprints -------------------------------------------------------------


def _fingerprint(text: str | None, shingle: int) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    # Every shingle is a stretch of the words joined by single spaces.
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    width = min(shingle, len(words))
    counts = np.zeros(64, dtype=np.int64)
    total = len(words) - width + 1
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, 1 << 15):
        to = min(at + (1 << 15), total)
        hashes = np.array(
            [
                digest(joined[i:j], SEED)
                for i, j in zip(
                    starts[at:to].tolist(), ends[at + width - 1 : to + width - 1].tolist()
                )
            ],
            dtype="<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    value = 0
    for bit in np.flatnonzero(2 * counts > total).tolist():
        value |= 1 << bit
    return value - (1 << 64) if value >> 63 else value


def fingerprints(
    docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
    shingle: int = SHINGLE,
) -> DataFrame:
    """``keep`` and fp, the fingerprint of each text as a signed 64-bit number.

    A-Z count as a-z, words are what white space of ASCII separates, shingles of
    ``shingle`` words are hashed with repeats, and a bit is set if it is set in
    over half of the hashes. A text of fewer words is one shingle; without words
    (also null) the fingerprint is 0.
    """
    slim = docs.select(*[docs[c] for c in keep], docs[text_col].alias("_text"))
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            found = pa.array([_fingerprint(t.as_py(), shingle) for t in texts], pa.int64())
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, found], [*keep, "fp"])

    return slim.mapInArrow(run, f"{schema}, fp bigint")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --- anchors ------------------------------------------------------------------


def _syndromes(points: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator: equal for words that differ
    by a code word."""
    rest = points.copy()
    for bit in range(_LENGTH - 1, _CHECKS - 1, -1):
        set_ = (rest >> bit) & 1 == 1
        rest[set_] ^= _GOLAY << (bit - _CHECKS)
    return rest


@lru_cache(maxsize=4)
def _offsets(most: int) -> list[list[np.ndarray]]:
    """[syndrome][excess]: differences to the code words that are at distance
    at most 3 (excess 0, just one) or 3 + excess, for excess up to ``most``."""
    table: list[list[list[int]]] = [[[] for _ in range(most + 1)] for _ in range(1 << _CHECKS)]
    for weight in range(_RADIUS + most + 1):
        patterns = np.array(
            [sum(1 << b for b in bits) for bits in itertools.combinations(range(_LENGTH), weight)],
            dtype=np.int64,
        )
        for pattern, syndrome in zip(patterns.tolist(), _syndromes(patterns).tolist()):
            table[syndrome][max(0, weight - _RADIUS)].append(pattern)
    return [[np.array(x, dtype=np.int64) for x in row] for row in table]


@lru_cache(maxsize=4)
def _all_offsets(most: int) -> list[np.ndarray]:
    return [np.concatenate(row) for row in _offsets(most)]


def _block(fps: np.ndarray, number: int) -> tuple[list[int], list[int]]:
    points = (fps >> (_LENGTH * number)) & ((1 << _LENGTH) - 1)
    return points.tolist(), _syndromes(points).tolist()


def anchors_of(fps: np.ndarray, blocks: int, most: int) -> list[np.ndarray]:
    """All anchors of each fingerprint, its home first."""
    if blocks == 1:
        table = _all_offsets(most)
        return [point ^ table[syndrome] for point, syndrome in zip(*_block(fps, 0))]
    table = _offsets(most)
    excesses = [(i, j) for i in range(most + 1) for j in range(most + 1 - i)]
    found = []
    for p, s, q, t in zip(*_block(fps, 0), *_block(fps, 1)):
        first, second = [p ^ o for o in table[s]], [q ^ o for o in table[t]]
        pairs = [((first[i] << _LENGTH)[:, None] | second[j]).ravel() for i, j in excesses]
        found.append(np.concatenate(pairs))
    return found


def _placements(blocks: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                fps = batch.column(0).slice(at, 1024).to_numpy(zero_copy_only=False)
                anchors = anchors_of(fps, blocks, most)
                sizes = np.array([len(x) for x in anchors])
                home = np.zeros(sizes.sum(), dtype=bool)
                home[np.cumsum(sizes) - sizes] = True
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(anchors)), pa.array(home), pa.array(np.repeat(fps, sizes))],
                    ["anchor", "home", "fp"],
                )

    return run


def _homes(blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            home = np.array([x[0] for x in anchors_of(fps, blocks, 0)], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(home)], ["anchor"])

    return run


def _links_at_anchor(fps: np.ndarray, home: np.ndarray, most: int) -> Iterator[tuple]:
    """Links that connect whatever is linked: for every home, those within reach
    that are not connected to it yet."""
    label = np.arange(len(fps))
    for i in np.flatnonzero(home).tolist():
        near = np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= most)
        if len(near) < 2:
            continue
        labels = np.unique(label[near])
        if len(labels) < 2:
            continue
        mine = label[i]
        for other in labels[labels != mine].tolist():
            partner = near[np.argmax(label[near] == other)]
            yield int(fps[i]), int(fps[partner])
        label[np.isin(label, labels)] = mine


def _compare(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        key = None
        out: list[tuple[int, int]] = []

        def flush() -> None:
            rows = np.concatenate(held, axis=1)
            home = rows[0] > 0
            if home.any() and rows.shape[1] > 1:
                # A fingerprint is at an anchor once, so rows are distinct.
                signed = rows[1]
                for a, b in _links_at_anchor(signed.view(np.uint64), home, most):
                    out.append((a - (1 << 64) if a >> 63 else a, b - (1 << 64) if b >> 63 else b))

        for batch in batches:
            anchor = batch.column(0).to_numpy(zero_copy_only=False)
            part = batch.column(1).to_numpy(zero_copy_only=False)
            home = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            fp = batch.column(3).to_numpy(zero_copy_only=False)
            if not len(anchor):
                continue
            new = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(part) != 0)) + 1
            for lo, hi in zip([0, *new.tolist()], [*new.tolist(), len(anchor)]):
                here = (int(anchor[lo]), int(part[lo]))
                if here != key and held:
                    flush()
                    held = []
                key = here
                held.append(np.stack([home[lo:hi], fp[lo:hi]]))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"]
                )
                out = []
        if held:
            flush()
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"]
            )

    return run


def near_links(fps: DataFrame, most_bits: int = MOST_BITS, blocks: int | None = None) -> DataFrame:
    """Links (a, b) between distinct values of ``fps.fp`` that connect any two of
    at most ``most_bits`` differing bits, directly or through others.

    ``blocks`` is 1 or 2; if not given, two for more than four million distinct
    fingerprints. Both give the same components; two make about four times more rows and
    4096 times more anchors. An anchor with very many homes is dealt to several
    comparisons by home, its visitors going to each.
    """
    distinct = stored(fps.select("fp").distinct(), "simhash-distinct")
    if blocks is None:
        blocks = 1 if distinct.count() <= _ONE_BLOCK else 2
    placed = distinct.mapInArrow(
        _placements(blocks, most_bits), "anchor bigint, home boolean, fp bigint"
    )
    crowded = (
        distinct.mapInArrow(_homes(blocks), "anchor bigint")
        .groupBy("anchor")
        .agg(F.count("*").alias("homes"))
        .where(F.col("homes") > _HOMES)
        .select(
            F.col("anchor").alias("crowded"),
            F.ceil(F.col("homes") / _HOMES).cast("int").alias("parts"),
        )
    )
    crowded = stored(crowded, "simhash-crowded")
    parts = F.coalesce("parts", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), parts).cast("int")
    dealt = (
        placed.join(
            F.broadcast(crowded) if fits(crowded, 32) else crowded,
            placed["anchor"] == crowded["crowded"],
            "left",
        )
        # Homes of one part are visitors in the others.
        .select("anchor", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), "home", own.alias("own"), "fp")
        .withColumn("home", F.col("home") & (F.col("part") == F.col("own")))
    )
    return (
        dealt.select("anchor", "part", "home", "fp")
        .repartition("anchor", "part")
        .sortWithinPartitions("anchor", "part")
        .mapInArrow(_compare(most_bits), "a bigint, b bigint")
        .distinct()
    )


def near_duplicates(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    shingle: int = SHINGLE,
    most_bits: int = MOST_BITS,
    blocks: int | None = None,
) -> DataFrame:
    """Per row of ``docs``: ``id_col``, fp and component_id, the smallest id that
    can be reached over links of at most ``most_bits`` differing bits, itself
    included.

    Nulls: a null text is an empty one; rows without an id are linked like any
    other, and a component in which no row has an id has a null one. Repeated
    rows and ids each get their row. An empty table gives no rows. Only the
    columns named are read. Equal fingerprints are one node of the graph, so a
    group of copies, however large, costs one comparison.
    """
    named = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
    found = _grouped(named, ("_id",), shingle, most_bits, blocks)
    return found.select(F.col("_id").alias(id_col), "fp", "component_id")


def _grouped(
    docs: DataFrame, keep: tuple[str, ...], shingle: int, most_bits: int, blocks: int | None
) -> DataFrame:
    """``keep``, with _id among them, fp, component_id and root, a number of the
    component, for the texts of ``docs._text``."""
    fps = stored(fingerprints(docs, "_text", keep, shingle), "simhash-fps")
    member = stored(components(near_links(fps, most_bits, blocks)), "simhash-components")
    least = fps.groupBy("fp").agg(F.min("_id").alias("least"))
    rooted = least.join(member, least["fp"] == member["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(ids, "root").select(F.col("fp").alias("_fp"), "component_id", "root")
    return fps.join(named, F.col("fp") == F.col("_fp")).select(*keep, "fp", "component_id", "root")


def one_of_each(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    shingle: int = SHINGLE,
    most_bits: int = MOST_BITS,
    blocks: int | None = None,
) -> DataFrame:
    """``docs`` with one row of each component; all columns.

    It is the row with the smallest id, of rows that share it the first as the table
    was read. Rows without an id stay.
    """
    numbered = stored(docs.withColumn("_number", F.monotonically_increasing_id()), "simhash-rows")
    named = numbered.select(
        F.col(id_col).alias("_id"), F.col("_number").alias("_n"), F.col(text_col).alias("_text")
    )
    found = _grouped(named, ("_id", "_n"), shingle, most_bits, blocks)
    # Rows without an id link others, but neither go nor stand for them.
    found = found.where(F.col("_id").isNotNull())
    first = found.groupBy(F.col("root").alias("_root")).agg(F.min(F.struct("_id", "_n")).alias("_first"))
    gone = stored(
        found.join(first, F.col("root") == F.col("_root"))
        .where(F.col("_n") != F.col("_first._n"))
        .select(F.col("_n").alias("_gone")),
        "simhash-gone",
    )
    small = F.broadcast(gone) if fits(gone, 16) else gone
    return numbered.join(small, F.col("_number") == F.col("_gone"), "left_anti").drop("_number")
