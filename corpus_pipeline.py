"""A corpus from raw documents to a weighted mixture, stage by stage.

Each stage takes all that its predecessor kept and passes the columns of
``documents`` on. ``run`` writes every stage to the shared folder, so that a lost
executor never costs more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cratemark.llm import decontaminate, linededup, mixing, simhash, toxicity
from cratemark.llm.queries import held_out
from cratemark.llm.storage import stored


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the trained model does not call toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels.where(~held_out(F.col("doc_id"))))
    return toxicity.without_toxic(docs, model)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later copies of repeated lines."""
    return linededup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of the sources takes them."""
    return mixing.mixture(docs, split_equal=True)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_stage),
    ("near-duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

# Scores, hashes and random draws of these stages have no SQL equivalent.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
