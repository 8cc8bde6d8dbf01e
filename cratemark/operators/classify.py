"""Category of a track from its audio features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.rules import DEFAULT_LABEL, RULES, Rule, category_column, labels


def classify(
    features: DataFrame, rules: Sequence[Rule] = RULES, default: str = DEFAULT_LABEL
) -> DataFrame:
    """``features`` with a ``category`` column. Never null."""
    return features.withColumn("category", category_column(rules, default))


def category_domain(
    spark: SparkSession, rules: Sequence[Rule] = RULES, default: str = DEFAULT_LABEL
) -> DataFrame:
    """The labels in order: ``position`` from 1, ``category``.

    A relation of literals, so that Spark knows how small it is and, in a join,
    moves it and never the data.
    """
    found = labels(rules, default)
    rows = ", ".join(f"({i}, :label{i})" for i in range(1, len(found) + 1))
    return spark.sql(
        f"SELECT position, category FROM VALUES {rows} AS domain(position, category)",
        args={f"label{i}": label for i, label in enumerate(found, start=1)},
    )
