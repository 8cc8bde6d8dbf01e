"""A Merkle tree over a table, with a proof for every row, by time-forward processing.

Nodes are labelled so that children come before their parents: by level, then by
place. Children send their digests to their parents through a priority queue
ordered by the receiver's label. A second sweep goes the other way round: parents
send their children what is left of the proofs, the siblings above them.

The queue is external: a sweep works on ``SPAN`` levels of the trees in blocks of
``arity ** SPAN`` neighbouring nodes. Messages within a block go through a heap;
what leaves it, one digest up and one proof down, goes through Spark's sorted
shuffle to the next sweep. A source of any size is many blocks, and the number of
sweeps grows with the logarithm of the largest source.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratemark.llm.ordering import placed
from cratemark.llm.storage import stored

ARITY = 3
# 3 ** 8 nodes a block: some megabytes of digests and proofs in a task.
SPAN = 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(*values: Column) -> Column:
    """SHA-256 (lowercase hex) of values, each ``-`` if null, else its UTF-8 byte
    count, ``:`` and the value. Integers are decimal."""
    said = [v.cast("string") for v in values]
    framed = [
        F.when(v.isNull(), F.lit("-")).otherwise(
            F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)
        )
        for v in said
    ]
    return F.sha2(F.concat(*framed), 256)


# --- towards the roots ---------------------------------------------------------------

_NODES = "tree string, among bigint, place bigint, digest string"
_RUNS = "kind string, tree string, block bigint, level int, place bigint, among bigint, children array<string>"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _batched(rows: Iterator[dict], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _upwards(arity: int, span: int):
    """A task's blocks, node by node in the order of their places: the runs of
    siblings, and the node that tops each block."""
    schema = pa.schema(
        [("kind", pa.string()), ("tree", pa.string()), ("block", pa.int64()), ("level", pa.int32()),
         ("place", pa.int64()), ("among", pa.int64()), ("children", pa.list_(pa.string()))]
    )

    def sweep(rows: Iterator[dict]) -> Iterator[dict]:
        for (tree, block), nodes in groupby(rows, key=lambda r: (r["tree"], r["block"])):
            # Messages: the receiver's level and place, the sender's place, its digest.
            queue: list[tuple[int, int, int, str]] = []
            width, top = 0, 0
            for node in nodes:
                if not queue:
                    width = node["among"]
                    left = width
                    while left > 1 and top < span:
                        left, top = -(-left // arity), top + 1
                receiver = node["place"] // arity if top else node["place"]
                heapq.heappush(queue, (min(1, top), receiver, node["place"], node["digest"]))
            while queue:
                level, place = queue[0][:2]
                children = []
                while queue and queue[0][:2] == (level, place):
                    children.append(heapq.heappop(queue)[3])
                here = {"tree": tree, "block": block, "level": level, "place": place, "among": width}
                if level == 0:  # alone in its tree: it tops it as it is
                    yield {**here, "kind": "top", "children": children}
                    continue
                yield {**here, "kind": "run", "children": children}
                own = digest("".join(children))
                if level < top:
                    heapq.heappush(queue, (level + 1, place // arity, place, own))
                else:
                    yield {**here, "kind": "top", "children": [own]}

    return lambda batches: _batched(sweep(_rows(batches)), schema)


def _swept_up(nodes: DataFrame, arity: int, span: int) -> tuple[DataFrame, DataFrame]:
    """One sweep over ``nodes`` (tree, among, place, digest): the runs of siblings
    below the blocks' tops, and the tops, which are the nodes of the next sweep."""
    wide = arity**span
    blocks = nodes.withColumn("block", F.floor(F.col("place") / wide))
    swept = stored(
        blocks.repartition("tree", "block")
        .sortWithinPartitions("tree", "block", "place")
        .mapInArrow(_upwards(arity, span), _RUNS),
        "merkle-runs",
        partition_by="kind",
    )
    tops = swept.where(F.col("kind") == "top").select(
        "tree",
        F.ceil(F.col("among") / wide).alias("among"),
        F.col("block").alias("place"),
        F.col("children")[0].alias("digest"),
    )
    return swept.where(F.col("kind") == "run").drop("kind", "among"), tops


def _to_roots(nodes: DataFrame, arity: int, span: int) -> tuple[list[DataFrame], DataFrame]:
    """The runs of all sweeps, and the root of every tree: (tree, digest)."""
    sweeps = []
    while not sweeps or (nodes.agg(F.max("among")).first()[0] or 0) > 1:
        runs, nodes = _swept_up(nodes, arity, span)
        sweeps.append(runs)
    return sweeps, nodes.select("tree", "digest")


# --- back to the leaves --------------------------------------------------------------

# What a node is sent: the siblings from its own level up to the root, and for
# each of these levels its place among the siblings and their number with itself.
_SENT = "digest string, proof string, places array<int>, sizes array<int>, subroot string"


_MESSAGE = ("digest", "proof", "places", "sizes", "subroot")


def _downwards(arity: int, receives: bool, fields: Sequence[tuple[str, pa.DataType]]):
    """A task's blocks in the reverse order of labels. A block's rows are the
    message to its top, its runs from the top down, and, if it ``receives``,
    what waits at the base; a receiver takes its message out of the queue."""
    kept = [name for name, _ in fields]
    schema = pa.schema(
        [("tree", pa.string()), ("place", pa.int64()), ("digest", pa.string()), ("proof", pa.string()),
         ("places", pa.list_(pa.int32())), ("sizes", pa.list_(pa.int32())), ("subroot", pa.string()), *fields]
    )

    def sweep(rows: Iterator[dict]) -> Iterator[dict]:
        for _, block in groupby(rows, key=lambda r: (r["tree"], r["block"])):
            queue: list[tuple[int, int, tuple]] = []
            sent = None
            for row in block:
                place = row["place"]
                if row["turn"] == 0:
                    sent = tuple(row[name] for name in _MESSAGE)
                    continue
                # The first receiver of a block is its top.
                if sent is not None:
                    got, sent = sent, None
                else:
                    level, found, got = heapq.heappop(queue)
                    assert (-level, found) == (row["level"], place), "a message went astray"
                if row["turn"] == 2:
                    yield {**{name: row[name] for name in kept}, **_message(row["tree"], place, got)}
                    continue
                children = row["children"]
                for nth, child in enumerate(children):
                    siblings = "".join(children[:nth] + children[nth + 1 :])
                    message = (child, siblings + got[1], [nth, *got[2]], [len(children), *got[3]], got[4])
                    below = place * arity + nth
                    if row["level"] > 1 or receives:
                        heapq.heappush(queue, (1 - row["level"], below, message))
                    else:
                        yield _message(row["tree"], below, message)
            if sent is not None:  # a lone node: the top is the base
                yield _message(row["tree"], row["block"], sent)

    return lambda batches: _batched(sweep(_rows(batches)), schema)


def _message(tree, place: int, got: tuple) -> dict:
    return {"tree": tree, "place": place, **dict(zip(_MESSAGE, got))}


def _swept_down(runs: DataFrame, messages: DataFrame, arity: int, span: int, waiting: DataFrame | None = None) -> DataFrame:
    """The messages (tree, place and ``_MESSAGE``) to the nodes at the
    base of a sweep, from those to the tops of its blocks. With ``waiting`` (tree,
    place and other columns) each of its rows takes its message."""
    rows = messages.select(
        "tree", F.col("place").alias("block"), F.lit(0).alias("turn"), F.lit(None).cast("int").alias("level"),
        F.lit(None).cast("bigint").alias("place"), *_MESSAGE,
    ).unionByName(
        runs.withColumn("turn", F.lit(1)), allowMissingColumns=True
    )
    kept = []
    if waiting is not None:
        kept = [f for f in waiting.schema if f.name not in ("tree", "place")]
        base = waiting.withColumns(
            {"block": F.floor(F.col("place") / arity**span), "turn": F.lit(2), "level": F.lit(0)}
        )
        rows = rows.unionByName(base, allowMissingColumns=True)
    schema = f"tree string, place bigint, {_SENT}" + "".join(
        f", `{f.name}` {f.dataType.simpleString()}" for f in kept
    )
    fields = [(f.name, _arrow_type(f)) for f in kept]
    return (
        rows.repartition("tree", "block")
        .sortWithinPartitions("tree", "block", "turn", F.col("level").desc(), "place")
        .mapInArrow(_downwards(arity, waiting is not None, fields), schema)
    )


def _arrow_type(field) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(field.dataType)


# --- the manifest --------------------------------------------------------------------


def manifest(
    docs: DataFrame, columns: Sequence[str] = COLUMNS, source_col: str = "source", id_col: str = "doc_id",
    keep: Sequence[str] = (), arity: int = ARITY, span: int = SPAN,
) -> DataFrame:
    """Per row of ``docs``: id, the columns to ``keep``, ``leaf``, ``subroot``,
    ``root``, ``proof``, ``places`` and ``sizes``.

    A row's leaf is the digest of its ``columns``. The leaves of a source, ascending
    by id, are the base of a tree; while there are several nodes, every ``arity``
    consecutive ones become the digest of theirs, also a last run of fewer or one.
    What is left is the source's subroot, the leaf itself if there is only one.
    The subroots, ordered by source, make the root in the same way.

    ``proof`` has the digests of the siblings, level by level up to the root, left
    to right, 64 characters each. ``sizes`` tells how many nodes each run has, the
    row's own one at ``places``. ``folded`` computes the root from them.

    Nulls: a null source is a source, and comes first; rows without an id come
    first in their source. Rows with the same source and id are ordered by their
    leaf; wholly equal rows have the same leaf at different places. An empty table
    gives no rows. Texts are read by their digest only. Columns that are neither
    named nor kept are not read.
    """
    leaves = docs.select(
        docs[source_col].cast("string").alias("tree"),
        docs[id_col].alias("_id"),
        leaf_digest(*(docs[c] for c in columns)).alias("_leaf"),
        *[docs[c].alias(f"_kept_{c}") for c in keep],
    )
    ordered = stored(
        placed(leaves, [F.col("_id").asc_nulls_first(), F.col("_leaf")], ["tree"], "merkle-order"),
        "merkle-leaves",
    )
    lower, subroots = _to_roots(
        ordered.select("tree", "among", "place", F.col("_leaf").alias("digest")), arity, span
    )
    sources = stored(placed(subroots, [F.col("tree").asc_nulls_first()], name="merkle-sources"), "merkle-subroots")
    no_tree = F.lit(None).cast("string").alias("tree")
    upper, root = _to_roots(sources.select(no_tree, "among", "place", "digest"), arity, span)

    empty = F.array().cast("array<int>")
    messages = root.select(
        "tree", F.lit(0).cast("bigint").alias("place"), "digest", F.lit("").alias("proof"),
        empty.alias("places"), empty.alias("sizes"), F.lit(None).cast("string").alias("subroot"),
    )
    for runs in reversed(upper):
        messages = _swept_down(runs, messages, arity, span)
    # A source's place among the sources is known by its message; its name by ``sources``.
    named = sources.select(F.col("place").alias("_at"), F.col("tree").alias("source"))
    messages = stored(
        messages.join(named, F.col("place") == F.col("_at")).select(
            F.col("source").alias("tree"), F.lit(0).cast("bigint").alias("place"),
            *_MESSAGE[:-1], F.col("digest").alias("subroot"),
        ),
        "merkle-messages",
    )
    for runs in reversed(lower[1:]):
        messages = stored(_swept_down(runs, messages, arity, span), "merkle-messages")
    waiting = ordered.select("tree", "place", "_id", *[f"_kept_{c}" for c in keep])
    found = _swept_down(lower[0], messages, arity, span, waiting)
    return found.select(
        F.col("_id").alias(id_col),
        *[F.col(f"_kept_{c}").alias(c) for c in keep],
        F.col("digest").alias("leaf"),
        "subroot",
        root.select("digest").scalar().alias("root"),
        "proof",
        "places",
        "sizes",
    )


def folded(leaf: Column, proof: Column, places: Column, sizes: Column) -> Column:
    """The root that ``leaf`` and a row's proof lead to."""
    start = F.struct(leaf.alias("digest"), F.lit(0).alias("used"))

    def one_level(state: Column, run: Column) -> Column:
        before, others = run["places"] * 64, (run["sizes"] - 1) * 64
        siblings = F.substring(proof, state["used"] + 1, others)
        return F.struct(
            F.sha2(
                F.concat(
                    F.substring(siblings, F.lit(1), before), state["digest"], F.substring(siblings, before + 1, others)
                ),
                256,
            ).alias("digest"),
            (state["used"] + others).alias("used"),
        )

    return F.aggregate(F.arrays_zip(places.alias("places"), sizes.alias("sizes")), start, one_level)["digest"]
