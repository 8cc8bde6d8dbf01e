"""Places of rows in an order, without one task that sees them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratemark.llm.storage import stored

# A row's number within a written partition takes these low bits.
_BITS = 33


def placed(df: DataFrame, by: Sequence[Column], within: Sequence[str] = (), name: str = "placed") -> DataFrame:
    """``df`` with ``place``, from 0, in the order ``by`` among the rows with equal
    ``within`` columns (nulls are equal), and their number ``among``.

    Rows are dealt out in ranges of ``within`` and then ``by``, each sorted by the
    task that gets it, and written. A group may span many ranges: its places in a
    range follow from the rows it has in the ranges before. That table has a row
    for each range and each group, no matter how many rows there are. Rows alike
    in all of this are still split between ranges, by their number in the input,
    and come in that order. An empty table stays empty.
    """
    given = df.withColumn("_row", F.monotonically_increasing_id())
    order = [*(F.col(c).asc_nulls_first() for c in within), *by, F.col("_row")]
    ranged = stored(
        given.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("_row")
        .withColumn("_at", F.monotonically_increasing_id()),
        name,
    ).withColumn("_range", F.shiftright("_at", _BITS))
    parts = stored(
        ranged.groupBy("_range", *within).agg(F.count("*").alias("_rows"), F.min("_at").alias("_first")),
        f"{name}-ranges",
    )
    group = [F.col(c) for c in within] or [F.lit(0)]
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        F.col("_range").alias("_in"),
        *[F.col(c).alias(f"_of_{c}") for c in within],
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(Window.partitionBy(*group)).alias("among"),
    )
    same = F.col("_range") == F.col("_in")
    for c in within:
        same &= F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return ranged.join(starts, same).select(
        *df.columns, (F.col("_at") + F.col("_shift")).alias("place"), "among"
    )
