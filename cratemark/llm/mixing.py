"""Mixing sources to target weights by Pareto order sampling.

Every source gets a number of words; its documents then get whole copies for
certain, and the fractions left over are settled by one Pareto sample: with
``u`` uniform and ``p`` the fraction of a document, documents are ranked by

    (u / (1 - u)) / (p / (1 - p))

and taken from the lowest rank on until the words of the source are spent. The
size of the sample is thus fixed, though the probabilities may differ.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratemark.llm.storage import fits, stored

WORD = r"[^\x20\x09-\x0D]+"
CYCLE = (5, 2, 1)
MAX_COPIES = 3
REFILLS = 2
# In which order the documents of a source are taken.
_ORDER = ("_rank", "_draw", "_nth")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(*parts: Column) -> Column:
    """32 hexadecimal digits that depend on nothing but ``parts``: the same in
    every run and for every partitioning."""
    return F.md5(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def _uniform(digits: Column) -> Column:
    """Strictly between 0 and 1."""
    number = F.conv(F.substring(digits, 1, 13), 16, 10).cast("long")
    return (number + F.lit(0.5)) / F.lit(float(1 << 52))


def source_targets(
    sizes: DataFrame,
    weights: Mapping[str | None, float] | Sequence[float] = CYCLE,
    max_copies: int = MAX_COPIES,
    total: int | None = None,
) -> DataFrame:
    """Words for every source: columns source, source_size, target.

    ``sizes`` has the columns source and source_size, one row a source. A
    mapping names the weight of each source (1 for those it leaves out); a
    sequence is dealt to the sources by code point, null last, again and again.
    Together the targets make ``total`` words (all there are, if not given). A
    target stops at ``max_copies`` times the size of its source; what is left
    goes to the others by weight, until none is above.

    Windows without a partition see one row a source here: a mixture names its
    sources one by one, so there are few.
    """
    if isinstance(weights, Mapping):
        named = [(k, v) for k, v in weights.items() if k is not None]
        weight = F.coalesce(
            *[F.when(F.col("source") == k, float(v)) for k, v in named],
            F.when(F.col("source").isNull(), float(weights.get(None, 1))),
            F.lit(1.0),
        )
    else:
        place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
        dealt = F.array(*[F.lit(float(w)) for w in weights])
        weight = F.get(dealt, place % len(weights))
    everything = Window.partitionBy()
    filled = Window.orderBy("_full_at")
    upto = filled.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    all_words = F.sum("source_size").over(everything) if total is None else F.lit(total)
    capped = F.col("_full") + F.col("_full_at") * F.col("_open") <= F.col("_all")
    return (
        sizes.withColumn("_weight", weight)
        .withColumn("_most", max_copies * F.col("source_size"))
        .withColumn(
            "_full_at",
            F.coalesce(F.try_divide("_most", "_weight"), F.lit(float("inf"))),
        )
        .withColumn("_all", all_words)
        # Were the level such that this source is just full: what the full
        # sources hold by then, and the weight of the others.
        .withColumn("_full", F.sum("_most").over(upto))
        .withColumn("_open", F.sum("_weight").over(everything) - F.sum("_weight").over(upto))
        .withColumn("_capped", capped)
        .withColumn("_rest", F.col("_all") - F.coalesce(F.sum(F.when(F.col("_capped"), F.col("_most"))).over(everything), F.lit(0)))
        .withColumn("_shared", F.sum(F.when(~F.col("_capped"), F.col("_weight"))).over(everything))
        .select(
            "source",
            "source_size",
            F.when(F.col("_capped"), F.col("_most").cast("double"))
            .otherwise(
                F.coalesce(F.try_divide(F.col("_weight") * F.col("_rest"), F.col("_shared")), F.lit(0.0))
            )
            .alias("target"),
        )
    )


def _with_odds(docs: DataFrame, max_copies: int) -> DataFrame:
    """Adds to slim rows that know their source's plan: whole copies, rank and
    the bin of the rank. Ranks of equal fractions are spread evenly over bins."""
    expected = F.when(
        F.col("_source_size") > 0,
        F.least(F.lit(float(max_copies)), F.coalesce(F.try_divide(F.col("_target") * F.col("_w"), F.col("_weighted")), F.lit(0.0))),
    ).otherwise(F.lit(0.0))
    whole = F.floor(F.col("_expected")).cast("long")
    part = F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), F.col("_expected") - F.col("_whole")))
    u = _uniform(F.col("_draw"))
    spread = F.col("_rank") * F.col("_odds")
    return (
        docs.withColumn("_expected", expected)
        .withColumn("_whole", whole)
        .withColumn("_part", part)
        .withColumn("_rank", (u / (1 - u)) / (F.col("_part") / (1 - F.col("_part"))))
        .withColumn("_bin", F.floor(spread / (1 + spread) * F.col("_bins")).cast("long"))
    )


def _joined(docs: DataFrame, sources: DataFrame, few: bool) -> DataFrame:
    """Each row with what its source says; a few sources are broadcast, else the
    join is Spark's to plan, and adaptive execution splits a hot source."""
    right = F.broadcast(sources) if few else sources
    return docs.join(right, docs["_source"].eqNullSafe(right["_plan_source"]), "left").drop(
        "_plan_source"
    )


def _cut(docs: DataFrame, budget: Column, few: bool) -> DataFrame:
    """Per source, where its ranked documents have spent the budget.

    A running sum over all documents of a source would be one task for a hot
    source. Sums by bin come first, combined before the shuffle, then a running
    sum over the bins, and then one over the documents of the single bin where
    the budget ends. With as many bins as the root of the number of documents,
    no task of a source sees more than about that root.
    """
    by_source = Window.partitionBy("_source").orderBy("_bin")
    bins = (
        docs.groupBy("_source", "_bin")
        .agg(F.sum("_size").alias("_in_bin"), F.first(budget).alias("_budget"))
        .withColumn("_upto", F.sum("_in_bin").over(by_source))
    )
    last = (
        bins.where(F.col("_upto") > F.col("_budget"))
        .groupBy("_source")
        .agg(
            F.min("_bin").alias("_cut_bin"),
            F.min_by(F.col("_upto") - F.col("_in_bin"), "_bin").alias("_before"),
        )
    )
    last = last.withColumnRenamed("_source", "_cut_source")
    inside = docs.join(
        F.broadcast(last) if few else last,
        docs["_source"].eqNullSafe(F.col("_cut_source")) & (F.col("_bin") == F.col("_cut_bin")),
    )
    ranked = Window.partitionBy("_source").orderBy(*_ORDER)
    key = F.struct(*_ORDER)
    taken = (
        inside.withColumn("_sum", F.col("_before") + F.sum("_size").over(ranked))
        .groupBy("_source")
        .agg(
            F.first("_cut_bin").alias("_cut_bin"),
            F.max(F.when(F.col("_sum") <= budget, key)).alias("_cut_key"),
            (
                F.first(budget)
                - F.coalesce(F.max(F.when(F.col("_sum") <= budget, F.col("_sum"))), F.first("_before"))
            ).alias("_gap"),
        )
    )
    return taken.withColumnRenamed("_source", "_cut_source")


def _is_taken(number: int) -> Column:
    """Whether round ``number`` of the filling takes this row."""
    at = F.col(f"_cut_bin{number}")
    before = F.col("_bin") < at
    inside = (F.col("_bin") == at) & (
        F.struct(*_ORDER) <= F.col(f"_cut_key{number}")
    )
    small = F.col("_size") <= F.col(f"_room{number}")
    # No cut: everything that may be taken fits.
    open_ended = at.isNull() & F.col(f"_room{number}").isNotNull()
    return F.coalesce((open_ended | before | F.coalesce(inside, F.lit(False))) & small, F.lit(False))


def mix(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    source_col: str = "source",
    weights: Mapping[str | None, float] | Sequence[float] = CYCLE,
    max_copies: int = MAX_COPIES,
    total: int | None = None,
    doc_weight_col: str | None = None,
    refills: int = REFILLS,
    split_equal: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """How often the mixture takes each document: ``(plan, sources)``.

    ``sources`` says per source what ``plan_rows`` needs to decide about a row;
    ``plan`` has for every row of ``docs`` the columns id, size (words, 0 for a
    null text), source_size, target and copies.

    ``doc_weight_col`` makes some documents likelier than others of the same
    source: expected copies are proportional to it, ``max_copies`` at most. All
    are alike without it. Null weights count as 1.

    The words of a source end within a document. It is left out, and ``refills``
    more rounds, in the same order, take documents that still fit in.

    Nulls: a null source is a source of its own, a null id is an id. Rows with
    the same id and text share their draw, so they are taken or left together,
    which may leave a source of many such rows far from its target. With
    ``split_equal`` the words end between them: they are taken one after the other,
    as they are read, so that how many of them are taken is always the same.
    An empty table gives an empty plan; empty texts have size 0. Only the
    columns named are read, whatever others there are.
    """
    slim = stored(
        docs.select(*_slim_columns(docs, text_col, id_col, source_col, doc_weight_col, split_equal)),
        "mix-sizes",
    )
    totals = slim.groupBy("_source").agg(
        F.sum("_size").alias("source_size"),
        F.sum(F.col("_w") * F.col("_size")).alias("_weighted"),
        F.count("*").alias("_docs"),
    )
    totals = stored(totals, "mix-sources")
    few = fits(totals, 200)
    targets = source_targets(
        totals.select(F.col("_source").alias("source"), "source_size"), weights, max_copies, total
    )
    sources = (
        totals.join(
            targets.select("source", "target"), totals["_source"].eqNullSafe(targets["source"])
        )
        .withColumn("_mean", F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)))
        .withColumn("_rest", F.col("_mean") - F.floor("_mean"))
        .select(
            F.col("_source").alias("_plan_source"),
            F.col("source_size").alias("_source_size"),
            F.col("target").alias("_target"),
            F.col("_weighted"),
            F.greatest(F.lit(1), F.ceil(F.sqrt("_docs"))).alias("_bins"),
            F.coalesce(
                F.greatest(F.lit(1e-9), F.col("_rest") / F.greatest(F.lit(1e-9), 1 - F.col("_rest"))),
                F.lit(1.0),
            ).alias("_odds"),
        )
    )
    sources = stored(sources, "mix-targets")
    ranked = _with_odds(_joined(slim, sources, few), max_copies)
    spent = ranked.groupBy("_source").agg(F.sum(F.col("_whole") * F.col("_size")).alias("_spent"))
    sources = stored(
        sources.join(spent, F.col("_plan_source").eqNullSafe(F.col("_source")), "left")
        .withColumn("_room0", F.greatest(F.lit(0.0), F.col("_target") - F.coalesce("_spent", F.lit(0))))
        .drop("_source", "_spent"),
        "mix-rooms",
    )
    for number in range(refills + 1):
        open_rows = _with_odds(_joined(slim, sources, few), max_copies).where(
            # A document whose copies are all certain has nothing to draw, and one
            # that is larger than what is left cannot be taken.
            (F.col("_expected") > F.col("_whole")) & (F.col("_size") <= F.col(f"_room{number}"))
        )
        for earlier in range(number):
            open_rows = open_rows.where(~_is_taken(earlier))
        cut = _cut(open_rows, F.col(f"_room{number}"), few)
        sources = stored(
            sources.join(cut, F.col("_plan_source").eqNullSafe(F.col("_cut_source")), "left")
            .drop("_cut_source")
            .withColumnsRenamed(
                {
                    "_cut_bin": f"_cut_bin{number}",
                    "_cut_key": f"_cut_key{number}",
                    "_gap": f"_room{number + 1}",
                }
            ),
            f"mix-cut{number}",
        )
    return _planned(slim, sources, few, max_copies, refills), sources


def _slim_columns(docs, text_col, id_col, source_col, doc_weight_col, split_equal) -> list[Column]:
    weight = F.lit(1.0)
    if doc_weight_col is not None:
        given = F.coalesce(docs[doc_weight_col].cast("double"), F.lit(1.0))
        weight = F.greatest(F.lit(0.0), given)
    return [
        docs[id_col].alias("_id"),
        docs[source_col].alias("_source"),
        n_words(docs[text_col]).alias("_size"),
        draw(docs[id_col], docs[text_col]).alias("_draw"),
        (F.monotonically_increasing_id() if split_equal else F.lit(0).cast("long")).alias("_nth"),
        weight.alias("_w"),
    ]


def _planned(slim, sources, few, max_copies, refills) -> DataFrame:
    rows = _with_odds(_joined(slim, sources, few), max_copies)
    drawn = F.lit(False)
    for number in range(refills + 1):
        drawn = drawn | _is_taken(number)
    drawn = drawn & (F.col("_expected") > F.col("_whole"))
    return rows.withColumn("_copies", F.col("_whole") + F.when(drawn, 1).otherwise(0))


def mixing_plan(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Per row of ``docs``: id, size, source_size, target, copies; see ``mix``."""
    plan, _ = mix(docs, id_col=id_col, **options)
    return plan.select(
        F.col("_id").alias(id_col),
        F.col("_size").alias("size"),
        F.coalesce("_source_size", F.lit(0)).alias("source_size"),
        F.coalesce("_target", F.lit(0.0)).alias("target"),
        F.col("_copies").cast("long").alias("copies"),
    )


def mixture(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    source_col: str = "source",
    max_copies: int = MAX_COPIES,
    doc_weight_col: str | None = None,
    refills: int = REFILLS,
    split_equal: bool = False,
    **options,
) -> DataFrame:
    """The mixture itself: rows of ``docs``, each as often as it is taken.

    Texts stay where they are read: what the sources decided is joined to the
    rows, and nothing but slim rows was ever shuffled. Cases as in ``mix``.
    ``split_equal`` counts rows as they are read, here a second time, so ``docs``
    has to be a table that is read alike each time, as stored files are.
    """
    _, sources = mix(
        docs, text_col, id_col, source_col,
        max_copies=max_copies, doc_weight_col=doc_weight_col, refills=refills,
        split_equal=split_equal, **options,
    )
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("_row"),
        *_slim_columns(docs, text_col, id_col, source_col, doc_weight_col, split_equal),
    )
    planned = _planned(rows, sources, fits(sources, 400), max_copies, refills)
    copies = F.sequence(F.lit(1), F.col("_copies").cast("int"))
    return (
        planned.where(F.col("_copies") > 0)
        .select("_row", F.explode(copies).alias("_copy"))
        .select("_row.*")
    )
