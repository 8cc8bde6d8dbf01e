"""Benchmark decontamination as a prefix-filtered set join.

A window is so many consecutive words of a benchmark item (a shorter item is one
window). It is compared as the set of its shingles. Containment asked for is
whole, so one shingle is a sufficient prefix: a document that holds the window
holds every shingle of it, its rarest too. Documents are therefore joined on the
rarest shingle of each window only, where rarity is counted over all documents;
the place of that shingle fixes where the window would have to start, which the
length and position bounds check; and what is left is compared word by word.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratemark.llm.storage import fits, stored

# Letters and digits of ASCII, and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
SHINGLE = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words of a text in lower case (A-Z only); none for null."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def shingle_hashes(words: Column, length: int) -> Column:
    """Hash of the ``length`` words from each place on, as far as there are
    enough; words are hashed once each and shingles from those."""

    def combine(h: Column) -> Column:
        last = F.size(h) - length
        return F.when(
            last >= 0,
            F.transform(
                F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(length)]),
            ),
        ).otherwise(F.array().cast("array<bigint>"))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), combine)


def item_windows(
    items: DataFrame, item_col: str, text_col: str, window: int, shingle: int
) -> DataFrame:
    """The distinct windows of all items: w_id, words, n, step (the length of
    its shingles) and the items that have it."""
    words = items.select(
        F.coalesce(items[item_col].cast("string"), F.lit("")).alias("item"),
        words_of(items[text_col]).alias("words"),
    ).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - window + 1))
    windows = (
        words.select("item", "words", F.explode(starts).alias("at"))
        .select("item", F.slice("words", F.col("at"), F.lit(window)).alias("words"))
        .groupBy("words")
        .agg(F.collect_set("item").alias("items"))
    )
    size = F.size("words")
    return windows.select(
        F.sha2(F.array_join("words", " "), 256).alias("w_id"),
        "words",
        "items",
        size.alias("n"),
        # Windows too short for a shingle are compared by their single words.
        F.when(size >= shingle, shingle).otherwise(1).alias("step"),
    )


def _small(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df``, to be broadcast if rows of at most ``row_bytes`` fit."""
    return F.broadcast(df) if fits(df, row_bytes) else df


def contaminated_spans(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    window: int = WINDOW,
    shingle: int = SHINGLE,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(documents, hits, windows)``: every row of ``docs`` with a row number, the
    columns ``keep`` as a struct, and n_words; one row for each place where a window
    occurs: row, at (first word, from 0), n, w_id; and the windows: w_id, n, words,
    items.

    The words of the documents, most of the work, are found once and stored; shingles
    are hashed from them when they are read. Places go through a shuffle, if the windows are too many for a broadcast, as numbers only;
    then the words of a document with a candidate go once, whatever its length."""
    windows = stored(item_windows(items, item_col, item_text_col, window, shingle), "leak-windows")
    steps = sorted(r[0] for r in windows.select("step").distinct().collect())  # two at most
    words = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.struct(*[docs[c] for c in keep]).alias("kept"),
        words_of(docs[text_col]).alias("words"),
    )
    base = stored(words.withColumn("n_words", F.size("words")), "leak-documents")
    documents = base.select("row", "kept", F.col("n_words").cast("long"))
    if not steps:
        nothing = "row bigint, at int, n int, w_id string"
        return documents, docs.sparkSession.createDataFrame([], nothing), windows
    shingles = stored(_shingles(windows, steps), "leak-shingles")
    prefix = stored(_prefixes(shingles, base, steps), "leak-prefixes")

    # Places of prefix tokens alone, and where the window would have to start.
    places = reduce(
        DataFrame.unionByName,
        [
            base.select(
                "row",
                "n_words",
                F.lit(step).alias("step"),
                F.posexplode(shingle_hashes(F.col("words"), step)).alias("place", "hash"),
            )
            for step in steps
        ],
    )
    start = F.col("place") - F.col("offset")
    candidates = stored(
        places.join(_small(prefix, 128), ["step", "hash"])
        .where((start >= 0) & (start + F.col("n") <= F.col("n_words")))
        .select("row", start.alias("at"), "n", "w_id"),
        "leak-candidates",
    )

    # The words decide.
    involved = stored(candidates.select("row").distinct(), "leak-involved")
    texts = base.select("row", F.col("words").alias("all_words")).join(
        _small(involved, 16), "row", "left_semi"
    )
    own = windows.select("w_id", "words")
    if _bytes_of_words(own) < 32 << 20:
        own = F.broadcast(own)
    hits = (
        texts.join(_small(candidates, 128), "row")
        .select("row", "at", "n", "w_id", F.slice("all_words", F.col("at") + 1, F.col("n")).alias("all_words"))
        .join(own, "w_id")
        .where(F.col("all_words") == F.col("words"))
        .select("row", "at", "n", "w_id")
    )
    return documents, stored(hits, "leak-hits"), windows


def _bytes_of_words(windows: DataFrame) -> int:
    return windows.agg(F.sum(F.octet_length(F.array_join("words", " ")) + 128)).first()[0] or 0


def _shingles(windows: DataFrame, steps: list[int]) -> DataFrame:
    """Every shingle of every window: w_id, n, step, offset, hash."""
    of_step = [
        windows.where(F.col("step") == step).select(
            "w_id", "n", "step", F.posexplode(shingle_hashes(F.col("words"), step)).alias("offset", "hash")
        )
        for step in steps
    ]
    return reduce(DataFrame.unionByName, of_step)


def _prefixes(shingles: DataFrame, base: DataFrame, steps: list[int]) -> DataFrame:
    """The prefix of each window: its rarest shingle over all documents. A shingle
    that no document has makes its window impossible."""
    wanted = shingles.select("step", "hash").distinct()
    seen = reduce(
        DataFrame.unionByName,
        [
            base.select(F.lit(step).alias("step"), F.explode(shingle_hashes(F.col("words"), step)).alias("hash"))
            for step in steps
        ],
    )
    if fits(wanted, 64):
        seen = seen.join(F.broadcast(wanted), ["step", "hash"], "left_semi")
    # Counted before they are dealt out, so that a common shingle is one row of a task.
    counts = seen.groupBy("step", "hash").agg(F.count("*").alias("times"))
    ranked = Window.partitionBy("w_id").orderBy("times", "hash", "offset")
    return (
        shingles.join(counts, ["step", "hash"], "left")
        .withColumn("times", F.coalesce("times", F.lit(0)))
        .withColumn("_rank", F.row_number().over(ranked))
        .where((F.col("_rank") == 1) & (F.col("times") > 0))
        .select("w_id", "n", "step", "hash", "offset")
    )


def contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: the columns ``keep`` and n_words, n_hit (words within
    occurring windows), n_items and items (ids of the items with windows that
    occur, as strings, sorted).

    Nulls: a null text has no words, neither has an item with a null text; a null
    id of an item counts as an empty one. Rows of the same item are one item.
    Repeated documents each get their row. Empty tables: no documents, no rows;
    no items, no hits. Only the columns named are read.
    """
    documents, hits, windows = contaminated_spans(docs, items, **options)
    before = (
        Window.partitionBy("row")
        .orderBy("at", "n")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    end = F.col("at") + F.col("n")
    covered = F.greatest(
        F.lit(0), end - F.greatest(F.col("at"), F.coalesce(F.max(end).over(before), F.lit(0)))
    )
    n_hit = (
        hits.withColumn("covered", covered).groupBy("row").agg(F.sum("covered").alias("n_hit"))
    )
    found_items = (
        hits.select("row", "w_id")
        .distinct()
        .join(windows.select("w_id", "items"), "w_id")
        .select("row", F.explode("items").alias("item"))
        .groupBy("row")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    return (
        documents.join(n_hit, "row", "left")
        .join(found_items, "row", "left")
        .withColumn("n_hit", F.coalesce("n_hit", F.lit(0)).cast("long"))
        .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
        .select("kept.*", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items")
    )


def decontaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows in which any window occurs; all columns. Cases as
    in ``contamination``."""
    documents, hits, _ = contaminated_spans(docs, items, keep=tuple(docs.columns), **options)
    gone = stored(hits.select(F.col("row").alias("_gone")).distinct(), "leak-rows")
    small = F.broadcast(gone) if fits(gone, 64) else gone
    return documents.join(small, F.col("row") == F.col("_gone"), "left_anti").select("kept.*")
