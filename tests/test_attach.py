"""The join, also with a hot id."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import cratemark as cm
from cratemark.schemas import FEATURES, RESULT_COLUMNS, TRACKS

TRACK_ROWS = [
    ("a", "single", "A", "2020", "X"),
    ("a", "single", "A", "2020", "X"),
    ("b", "album", "B", "2021", "Y"),
    (None, "album", "no id", "2022", "Z"),
    ("only here", "album", "C", "2023", "Z"),
]


def feature(track_id, energy=0.2):
    return (track_id, 0.1, energy, -5.0, 0.1, 0.5, 0.0, 0.1, 0.1, 90.0, 1000)


FEATURE_ROWS = [feature("a"), feature("b"), feature("b", 0.3), feature(None), feature("stale")]


@pytest.fixture
def tracks(spark):
    return spark.createDataFrame(TRACK_ROWS, TRACKS)


@pytest.fixture
def features(spark):
    return cm.classify(spark.createDataFrame(FEATURE_ROWS, FEATURES))


def test_inner_join_with_duplicates_and_nulls(tracks, features):
    joined = cm.attach_features(tracks, features)
    assert joined.columns == list(RESULT_COLUMNS)
    got = Counter((r.track_id, r.energy) for r in joined.collect())
    assert got == {("a", 0.2): 2, ("b", 0.2): 1, ("b", 0.3): 1}


def test_keys_of_other_types_are_cast(spark):
    tracks = spark.createDataFrame([(1, "n")], "track_id int, name string")
    features = spark.createDataFrame([(1, 0.5), (2, 0.5)], "track_id bigint, energy double")
    joined = cm.attach_features(tracks, features)
    assert [tuple(r) for r in joined.collect()] == [("1", "n", 0.5)]


HASH_BELOW = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
SKEW_SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
}


@pytest.mark.parametrize("strategy", ["SortMergeJoin", "ShuffledHashJoin"])
def test_plain_join_splits_a_hot_id_at_run_time(spark, tmp_path, strategy):
    """A third of the tracks is one hit: no task gets all of it."""
    hit = F.when(F.col("id") % 3 == 0, "hit").otherwise(F.col("id").cast("string"))
    name = F.repeat(F.sha2(F.col("id").cast("string"), 256), 2)
    ids = spark.range(0, 60_000, 1, 16)
    cm.write_table(ids.select(hit.alias("track_id"), name.alias("name")), str(tmp_path / "t"))
    cm.write_table(
        ids.select(hit.alias("track_id"), F.lit(0.5).alias("energy")).distinct(), str(tmp_path / "f")
    )
    hashed = "10MB" if strategy == "ShuffledHashJoin" else "0"
    settings = {**SKEW_SETTINGS, HASH_BELOW: hashed}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = cm.attach_features(
            spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "f"))
        )
        per_task = joined.groupBy(F.spark_partition_id().alias("task")).agg(
            F.count_if(F.col("track_id") == "hit").alias("hits"),
            F.count(F.lit(1)).alias("rows"),
            F.max("name").alias("name"),  # keeps the wide column in the shuffle
        )
        tasks = per_task.collect()
        plan = per_task._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)
    assert sum(t.rows for t in tasks) == 60_000 and sum(t.hits for t in tasks) == 20_000
    assert max(t.hits for t in tasks) < 10_000
    assert f"{strategy}(skew=true)" in plan
