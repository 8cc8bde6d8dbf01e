"""Line dedup over a suffix array of line ids, built by prefix doubling.

The documents are sequences of line ids. A suffix of such a sequence begins at
every line; round h ranks suffixes by their first h lines, from the ranks that the
round before gave to the two halves. Equal ranks are an interval of the suffix
array whose longest common prefix has at least h lines. Suffixes alone in their
interval are settled and leave; the rounds end when all have left.

The last interval of a suffix that holds an earlier one tells where the lines
were first; comparing the ranks of all rounds from there on, halving each time,
gives the exact length of the common run. A run is what is deleted: the lines of
the later copy, while its first occurrence stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratemark.llm.storage import stored

MIN_CHARS = 10
MIN_LINES = 1


def _joined(left: DataFrame, right: DataFrame, on: Column | list[str], how: str = "inner") -> DataFrame:
    """A join by sorting both sides. Stored tables of numbers are few bytes in a file,
    exploded ones few before that, but not in memory: Spark, which goes by these
    bytes, would broadcast them and so take them into the driver."""
    return left.join(right.hint("merge"), on, how)


def _in_order(df: DataFrame, keys: list[str | Column], name: str) -> DataFrame:
    """Adds ``name``, a number that rises with ``keys``: partitions hold ranges of
    the keys, and numbers rise within partitions and from one to the next."""
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return ranged.withColumn(name, F.monotonically_increasing_id())


def _ranked(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From blocks (row, line, pos, left, right): those in an interval of two or
    more with their rank (row, line, pos, rank), and what each interval has first
    (rank, first)."""
    intervals = stored(
        blocks.groupBy("left", "right")
        .agg(F.count("*").alias("n"), F.min("pos").alias("first"))
        .where(F.col("n") > 1)
        .drop("n"),
        "lines-intervals",
    )
    ranks = stored(_in_order(intervals, ["left", "right"], "rank"), "lines-ranks")
    named = ranks.select(F.col("left").alias("_l"), F.col("right").alias("_r"), "rank", "first")
    found = _joined(blocks, named, (F.col("left") == F.col("_l")) & (F.col("right") == F.col("_r")))
    return stored(found.select("row", "line", "pos", "rank", "first"), "lines-suffixes")


def repeated_runs(lines: DataFrame) -> DataFrame:
    """Left-maximal runs that occur earlier: row, line, n_lines, source_row,
    source_line.

    ``lines`` has row, line (from 0), the order of rows as ``order`` (ties go by
    row), and ``key1``, ``key2``, which together identify the text of a line.
    """
    keys = (
        lines.groupBy("key1", "key2")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .select(F.col("key1").alias("_k1"), F.col("key2").alias("_k2"))
    )
    # Lines that occur once end every run, so only the others go on.
    active = _joined(lines, keys, (F.col("key1") == F.col("_k1")) & (F.col("key2") == F.col("_k2")))
    active = stored(active.select("row", "line", "order", "key1", "key2"), "lines-active")
    placed = stored(
        _in_order(active, [F.col("order").asc_nulls_last(), "row", "line"], "pos"), "lines-placed"
    )
    suffixes = _ranked(
        placed.select("row", "line", "pos", F.col("key1").alias("left"), F.col("key2").alias("right"))
    )
    rounds = []
    while not suffixes.isEmpty():
        rounds.append(suffixes)
        ahead = suffixes.select(
            F.col("row").alias("_row"),
            (F.col("line") - (1 << (len(rounds) - 1))).alias("_line"),
            F.col("rank").alias("right"),
        )
        suffixes = _ranked(
            _joined(suffixes, ahead, (F.col("row") == F.col("_row")) & (F.col("line") == F.col("_line")))
            .select("row", "line", "pos", F.col("rank").alias("left"), "right")
        )
    if not rounds:
        return active.select(
            "row",
            "line",
            F.lit(0).alias("n_lines"),
            F.col("row").alias("source_row"),
            F.col("line").alias("source_line"),
        )

    later = None
    for level, found in enumerate(rounds):
        copies = found.where(F.col("pos") > F.col("first")).select(
            "row", "line", F.lit(level).alias("level"), "first"
        )
        later = copies if later is None else later.unionByName(copies)
    deepest = later.groupBy("row", "line").agg(
        F.max("level").alias("level"), F.max_by("first", "level").alias("first")
    )
    where = placed.select(
        F.col("pos").alias("_pos"), F.col("row").alias("source_row"), F.col("line").alias("source_line")
    )
    before = Window.partitionBy("row").orderBy("line")
    # The run of the line before, if it goes on with the same source, holds this one.
    goes_on = (
        (F.lag("line").over(before) == F.col("line") - 1)
        & (F.lag("source_row").over(before) == F.col("source_row"))
        & (F.lag("source_line").over(before) == F.col("source_line") - 1)
    )
    runs = stored(
        _joined(deepest, where, F.col("first") == F.col("_pos"))
        .withColumn("_inner", F.coalesce(goes_on, F.lit(False)))
        .where(~F.col("_inner"))
        .select("row", "line", "level", "source_row", "source_line")
        .withColumn("n_lines", F.pow(F.lit(2), F.col("level")).cast("int")),
        "lines-runs",
    )
    for level in range(len(rounds) - 2, -1, -1):
        # Half a round's lines more, if both go on alike.
        ranks = rounds[level].select(
            F.col("row").alias("_row"), F.col("line").alias("_line"), F.col("rank").alias("_rank")
        )
        open_runs = runs.where(F.col("level") > level)
        at = _joined(
            open_runs,
            ranks,
            (F.col("row") == F.col("_row")) & (F.col("line") + F.col("n_lines") == F.col("_line")),
        ).drop("_row", "_line")
        there = ranks.withColumnRenamed("_rank", "_source_rank")
        alike = (
            _joined(
                at,
                there,
                (F.col("source_row") == F.col("_row"))
                & (F.col("source_line") + F.col("n_lines") == F.col("_line"))
                & (F.col("_rank") == F.col("_source_rank")),
            )
            .select(F.col("row").alias("_row"), F.col("line").alias("_line"))
        )
        runs = stored(
            _joined(
                runs, alike, (F.col("row") == F.col("_row")) & (F.col("line") == F.col("_line")), "left"
            )
            .withColumn(
                "n_lines", F.col("n_lines") + F.when(F.col("_row").isNotNull(), 1 << level).otherwise(0)
            )
            .drop("_row", "_line"),
            "lines-runs",
        )
    return runs.drop("level")


def _lines(rows: DataFrame) -> DataFrame:
    """One row a line; two 64-bit hashes stand for its text."""
    return rows.select(
        "row", "order", F.posexplode(F.split("text", "\n")).alias("line", "_line")
    ).select(
        "row",
        "order",
        "line",
        F.xxhash64("_line").alias("key1"),
        F.xxhash64(F.lit(1), "_line").alias("key2"),
        F.length("_line").alias("chars"),
    )


def dedup_lines(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    min_chars: int = MIN_CHARS,
    min_lines: int = MIN_LINES,
    with_counts: bool = False,
) -> DataFrame:
    """``docs`` without the later copies of repeated line runs; all columns.

    A run goes if it has at least ``min_lines`` lines and ``min_chars`` characters,
    so that a lone bracket or "Yes." stays. The first occurrence, by id and line,
    stays. Lines are what line feeds separate; they are compared by two 64-bit
    hashes. What is left of a document are its other lines in their order: all
    documents stay, those that held nothing else as empty texts. ``with_counts`` adds
    n_lines and n_deleted (null and empty texts have 0 and 1 lines).

    Nulls: a null text stays null; rows without an id come after all others. Of
    rows with the same id one counts as the first. An empty table stays empty.
    Columns besides text and id are carried along whatever their names.
    """
    base = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            docs[id_col].alias("order"),
            docs[text_col].alias("text"),
            F.struct(*[docs[c] for c in docs.columns if c != text_col]).alias("rest")
            if len(docs.columns) > 1
            else F.struct(F.lit(1).alias("_none")).alias("rest"),
        ),
        "lines-documents",
    )
    lines = stored(_lines(base.where(F.col("text").isNotNull())), "lines-lines")
    runs = repeated_runs(lines)
    # A run's characters, from the lengths of its lines.
    each_line = runs.select(
        "row",
        F.col("line").alias("start"),
        "n_lines",
        F.explode(F.sequence(F.col("line"), F.col("line") + F.col("n_lines") - 1)).alias("line"),
    )
    of_run = (
        _joined(each_line, lines.select("row", "line", "chars"), ["row", "line"])
        .groupBy("row", "start", "n_lines")
        .agg(F.sum("chars").alias("chars"))
        .where((F.col("chars") >= min_chars) & (F.col("n_lines") >= min_lines))
    )
    spans = stored(
        of_run.groupBy("row")
        .agg(F.collect_list(F.struct("start", "n_lines")).alias("spans"))
        .withColumnRenamed("row", "_row"),
        "lines-spans",
    )
    joined = _joined(base, spans, F.col("row") == F.col("_row"), "left")
    gone = F.flatten(
        F.transform(
            "spans", lambda s: F.sequence(s["start"] + 1, s["start"] + s["n_lines"])
        )
    )
    split = F.split("text", "\n")
    staying = F.array_except(F.sequence(F.lit(1), F.size(split)), gone)
    kept = F.transform(
        F.array(F.struct(split.alias("lines"), staying.alias("at"))),
        lambda x: F.array_join(F.transform(x["at"], lambda i: F.get(x["lines"], i - 1)), "\n"),
    )[0]
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(kept)
    columns = [
        (text if c == text_col else F.col("rest").getField(c)).alias(c) for c in docs.columns
    ]
    if with_counts:
        n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(split))
        n_deleted = F.when(F.col("spans").isNull(), 0).otherwise(F.size(F.array_distinct(gone)))
        columns += [n_lines.cast("long").alias("n_lines"), n_deleted.cast("long").alias("n_deleted")]
    return joined.select(*columns)
