"""Token counts of documents in flat, unindexed token files.

A token file is nothing but token ids, 16 or 32 bits each, one document after the
other, each followed by an end-of-document id. It is stored as blocks of equal
size that heed no document boundary. A block is searched for the id in one
vectorised comparison; what it says is small: the documents that begin and end in
it, the tokens before its first end and after its last one. A prefix scan over
the blocks of a file then tells how many documents came before a block, and how
many tokens of its first document were in earlier blocks.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cratemark.llm.storage import stored

BLOCK_BYTES = 1 << 20
# How words are told apart before byte pairs are merged: fixed with the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_encodings: dict = {}


def _encoding(vocabulary: str):
    """The tokenizer of a rank file, once per Python worker."""
    import tiktoken

    if vocabulary not in _encodings:
        with open(vocabulary, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        _encodings[vocabulary] = tiktoken.Encoding(
            "own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return _encodings[vocabulary]


def token_files(
    docs: DataFrame,
    vocabulary: str,
    end_id: int,
    text_col: str = "text",
    id_col: str = "doc_id",
    block_bytes: int = BLOCK_BYTES,
    stretch: int = 1 << 16,
) -> tuple[DataFrame, DataFrame]:
    """Write ``docs`` as token files, one for each input partition, below the
    shared folder: ``(blocks, manifest)``.

    ``blocks`` has file, block (from 0) and data, little-endian 32-bit ids, or 16-bit
    ones if ``end_id`` and all others fit. ``manifest`` tells which document is the
    n-th of a file: file, ordinal, id. The blocks say nothing about documents.

    ``vocabulary`` is the path of a rank file that all executors can open. Special
    tokens in texts are ordinary text. Long texts are encoded ``stretch``
    characters at a time, cut before a space that follows a letter, where the
    tokenizer parts words anyway.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    wide = "<u2" if end_id < 1 << 16 else "<u4"
    slim = docs.select(
        F.spark_partition_id().alias("file"), docs[id_col].alias("id"), docs[text_col].alias("text")
    )

    def encoded(text: str) -> Iterator[np.ndarray]:
        encode = _encoding(vocabulary).encode_to_numpy
        at = 0
        while at < len(text):
            to = at + stretch
            if to < len(text):
                while to < len(text) and not (text[to] == " " and text[to - 1].isalpha()):
                    to += 1
            # Nothing is disallowed and nothing allowed: all text is ordinary.
            ids = encode(text[at:to], disallowed_special=())
            if len(ids) and ids.max() >= 1 << (16 if wide == "<u2" else 32):
                raise ValueError(f"an id of {vocabulary} does not fit beside end_id {end_id}")
            yield ids.astype(wide)
            at = to

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], dtype=wide).tobytes()
        pending, size, block, ordinal, file = [], 0, 0, 0, None

        def cut(most: int) -> Iterator[pa.RecordBatch]:
            nonlocal pending, size, block
            data = b"".join(pending)
            whole = len(data) if most == 0 else len(data) // most * most
            for at in range(0, whole, most or max(1, whole)):
                part = data[at : at + (most or whole)]
                yield batch_of([("block", file, block, None, part)])
                block += 1
            pending, size = [data[whole:]], len(data) - whole

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            types = (pa.string(), pa.int32(), pa.int64(), None, pa.binary())
            kind, files, numbers, ids, data = zip(*rows)
            ids = ids[0] if isinstance(ids[0], pa.Array) else pa.nulls(len(rows), id_arrow)
            columns = [
                pa.array(kind, types[0]),
                pa.array(files, types[1]),
                pa.array(numbers, types[2]),
                ids,
                pa.array(data, types[4]),
            ]
            return pa.RecordBatch.from_arrays(columns, ["kind", "file", "number", "id", "data"])

        id_arrow = None
        for batch in batches:
            if not batch.num_rows:
                continue
            file, id_arrow = batch.column(0)[0].as_py(), batch.column(1).type
            for text in batch.column(2):
                for ids in encoded(text.as_py() or ""):
                    pending.append(ids.tobytes())
                    size += len(pending[-1])
                    if size >= block_bytes:
                        yield from cut(block_bytes)
                pending.append(end)
                size += len(end)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(["document"] * n),
                    pa.array([file] * n, pa.int32()),
                    pa.array(np.arange(ordinal, ordinal + n)),
                    batch.column(1),
                    pa.nulls(n, pa.binary()),
                ],
                ["kind", "file", "number", "id", "data"],
            )
            ordinal += n
            if size >= block_bytes:
                yield from cut(block_bytes)
        if size:
            yield from cut(block_bytes)
        if size:
            yield from cut(0)

    written = stored(
        slim.mapInArrow(run, f"kind string, file int, number bigint, id {id_type}, data binary"),
        "token-files",
        partition_by="kind",
    )
    blocks = written.where(F.col("kind") == "block").select(
        "file", F.col("number").alias("block"), "data"
    )
    manifest = written.where(F.col("kind") == "document").select(
        "file", F.col("number").alias("ordinal"), "id"
    )
    return blocks, manifest


def read_flat_files(spark, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of raw token files (``path``, one row of blocks for each file), as
    ``document_lengths`` takes them. Spark reads a raw file as a whole, so files
    should stay below a few hundred MB."""
    files = spark.read.format("binaryFile").load(path)
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.lit(0), F.col("length") - 1), F.lit(block_bytes).cast("bigint"))
    return files.select(F.col("path").alias("file"), "content", F.posexplode(starts).alias("block", "at")).select(
        "file", F.col("block").cast("bigint").alias("block"), F.expr(f"substring(content, cast(at + 1 as int), {block_bytes})").alias("data")
    )


def _scan(end_id: int, token_bytes: int):
    """Per block: how many documents end in it, the tokens before the first end,
    those after the last, and the lengths of the documents in between."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads, tails, counts, inner = [], [], [], []
            for data in batch.column(2):
                ids = np.frombuffer(data.as_buffer() or b"", dtype=f"<u{token_bytes}")
                ends = np.flatnonzero(ids == end_id)
                counts.append(len(ends))
                heads.append(int(ends[0]) if len(ends) else len(ids))
                tails.append(len(ids) - int(ends[-1]) - 1 if len(ends) else 0)
                inner.append((np.diff(ends) - 1).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(counts, pa.int64()),
                    pa.array(heads, pa.int64()),
                    pa.array(tails, pa.int64()),
                    pa.array(inner, pa.list_(pa.int64())),
                ],
                ["file", "block", "ends", "head", "tail", "inner"],
            )

    return run


def document_lengths(blocks: DataFrame, end_id: int, token_bytes: int = 2) -> DataFrame:
    """(file, ordinal, n_tokens) for every document in token files.

    ``blocks`` has file, block and data (whole tokens of ``token_bytes`` bytes),
    blocks numbered in order within a file, gaps allowed. The end id is not
    counted. Tokens after the last end of a file make a document too; a file that
    ends with an end id has none of these. Null or empty data is an empty block;
    no blocks give no documents. The scan's windows see one small row a block.
    """
    file_type = blocks.schema["file"].dataType.simpleString()
    found = stored(
        blocks.select("file", F.col("block").cast("bigint"), "data").mapInArrow(
            _scan(end_id, token_bytes),
            f"file {file_type}, block bigint, ends bigint, head bigint, tail bigint, inner array<bigint>",
        ),
        "token-scan",
    )
    earlier = (
        Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    # Blocks without an end add up until the next one with an end: their sums run
    # over all blocks, and the sum at the last end is taken off again.
    running = F.coalesce(F.sum(F.when(F.col("ends") == 0, F.col("head")).otherwise(0)).over(earlier), F.lit(0))
    scanned = (
        found.withColumn("before", F.coalesce(F.sum("ends").over(earlier), F.lit(0)))
        .withColumn("running", running)
        .withColumn(
            "open",
            F.coalesce(F.last(F.when(F.col("ends") > 0, F.col("tail") - F.col("running")), True).over(earlier), F.lit(0)),
        )
        .withColumn("carried", F.col("open") + F.col("running"))
    )
    first = scanned.where(F.col("ends") > 0).select(
        "file", F.col("before").alias("ordinal"), (F.col("carried") + F.col("head")).alias("n_tokens")
    )
    inner = scanned.select("file", "before", F.posexplode("inner").alias("at", "n_tokens")).select(
        "file", (F.col("before") + F.col("at") + 1).alias("ordinal"), "n_tokens"
    )
    last = (
        scanned.groupBy("file")
        .agg(
            F.sum("ends").alias("ordinal"),
            F.max_by(
                F.when(F.col("ends") > 0, F.col("tail")).otherwise(F.col("carried") + F.col("head")),
                "block",
            ).alias("n_tokens"),
        )
        .where(F.col("n_tokens") > 0)
    )
    return first.unionByName(inner).unionByName(last)


def token_counts(
    docs: DataFrame, vocabulary: str, end_id: int, text_col: str = "text", id_col: str = "doc_id",
    **options,
) -> DataFrame:
    """(id, n_tokens) per row of ``docs``: written as token files and counted from
    them. A null text has no tokens; rows without an id and repeated rows each get
    their row; an empty table gives no rows; other columns are not read."""
    blocks, manifest = token_files(docs, vocabulary, end_id, text_col, id_col, **options)
    lengths = document_lengths(blocks, end_id, 2 if end_id < 1 << 16 else 4)
    return manifest.join(lengths, ["file", "ordinal"]).select(F.col("id").alias(id_col), "n_tokens")
