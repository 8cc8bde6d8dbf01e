"""The category cascade: every label, every edge, nulls and NaN."""

import itertools
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import cratemark as cm
from cratemark.functions.rules import DEFAULT_LABEL, RULES, labels

TESTED = ("energy", "tempo", "acousticness", "speechiness", "danceability", "valence")
NEUTRAL = dict.fromkeys(TESTED, 0.0) | {"acousticness": 0.5}
DDL = ", ".join(f"{name} double" for name in TESTED)


def expected(energy, tempo, acousticness, speechiness, danceability, valence):
    """The cascade in plain Python; a comparison with a missing value is false
    and NaN is above every number, as in Spark."""

    def above(x, bound):
        return x is not None and (math.isnan(x) or x > bound)

    def below(x, bound):
        return x is not None and not math.isnan(x) and x < bound

    def between(x, low, high):
        return above(x, low) and below(x, high)

    loud = above(energy, 0.6)
    if above(energy, 0.7) and above(tempo, 120) and below(acousticness, 0.3):
        return "Metal🤘"
    if above(acousticness, 0.7) and below(energy, 0.5) and below(tempo, 100):
        return "Classic🏛️"
    if above(speechiness, 0.8):
        return "Podcast🎧"
    if above(speechiness, 0.4):
        return "Vocal🎤"
    if loud and above(tempo, 120) and above(danceability, 0.7):
        return "Electro⚡"
    if loud and between(tempo, 100, 140) and above(danceability, 0.5):
        return "HipHop🎤"
    if above(valence, 0.5) and between(danceability, 0.5, 0.7) and between(energy, 0.4, 0.6):
        return "Soul🎷"
    if loud and between(tempo, 100, 140) and between(danceability, 0.5, 0.7):
        return "Rock🎸"
    return "Other🦦"


def categories(spark, rows):
    frame = spark.createDataFrame([tuple(r) for r in rows], DDL).coalesce(1)
    return [r.category for r in cm.classify(frame).collect()]


@pytest.mark.parametrize(
    ("values", "label"),
    [
        ({"energy": 0.71, "tempo": 121, "acousticness": 0.29}, "Metal🤘"),
        ({"acousticness": 0.71, "energy": 0.49, "tempo": 99}, "Classic🏛️"),
        ({"speechiness": 0.81}, "Podcast🎧"),
        ({"speechiness": 0.41}, "Vocal🎤"),
        ({"energy": 0.61, "tempo": 121, "danceability": 0.71}, "Electro⚡"),
        ({"energy": 0.61, "tempo": 101, "danceability": 0.51}, "HipHop🎤"),
        ({"valence": 0.51, "danceability": 0.6, "energy": 0.5}, "Soul🎷"),
        ({}, "Other🦦"),
        # on a threshold, the comparison fails
        ({"energy": 0.7, "tempo": 121, "acousticness": 0.29}, "Other🦦"),
        ({"energy": 0.71, "tempo": 120, "acousticness": 0.29}, "Other🦦"),
        ({"energy": 0.71, "tempo": 121, "acousticness": 0.3}, "Other🦦"),
        ({"acousticness": 0.7, "energy": 0.49, "tempo": 99}, "Other🦦"),
        ({"acousticness": 0.71, "energy": 0.5, "tempo": 99}, "Other🦦"),
        ({"acousticness": 0.71, "energy": 0.49, "tempo": 100}, "Other🦦"),
        ({"speechiness": 0.8}, "Vocal🎤"),
        ({"speechiness": 0.4}, "Other🦦"),
        ({"energy": 0.6, "tempo": 121, "danceability": 0.71}, "Other🦦"),
        ({"energy": 0.61, "tempo": 120, "danceability": 0.71}, "HipHop🎤"),
        ({"energy": 0.61, "tempo": 121, "danceability": 0.7}, "HipHop🎤"),
        ({"energy": 0.61, "tempo": 100, "danceability": 0.51}, "Other🦦"),
        ({"energy": 0.61, "tempo": 140, "danceability": 0.6}, "Other🦦"),
        ({"energy": 0.61, "tempo": 101, "danceability": 0.5}, "Other🦦"),
        ({"valence": 0.5, "danceability": 0.6, "energy": 0.5}, "Other🦦"),
        ({"valence": 0.51, "danceability": 0.5, "energy": 0.5}, "Other🦦"),
        ({"valence": 0.51, "danceability": 0.7, "energy": 0.5}, "Other🦦"),
        ({"valence": 0.51, "danceability": 0.6, "energy": 0.4}, "Other🦦"),
        ({"valence": 0.51, "danceability": 0.6, "energy": 0.6}, "Other🦦"),
        # a missing value fails its test and the cascade goes on
        (dict.fromkeys(TESTED), "Other🦦"),
        ({"speechiness": None, "energy": 0.65, "tempo": 130, "danceability": 0.6}, "HipHop🎤"),
        ({"energy": math.nan, "tempo": 121, "acousticness": 0.29}, "Metal🤘"),
        ({"energy": 0.71, "tempo": 121, "acousticness": math.nan, "speechiness": 0.5}, "Vocal🎤"),
    ],
)
def test_label(spark, values, label):
    row = {**NEUTRAL, **values}
    row = [None if row[n] is None else float(row[n]) for n in TESTED]
    assert categories(spark, [row]) == [label]
    assert expected(*row) == label


def test_grid_matches_plain_python_and_rock_never_wins(spark):
    steps = (
        (0.0, 0.4, 0.45, 0.5, 0.6, 0.65, 0.7, 0.75, None),
        (99.0, 100.0, 110.0, 120.0, 130.0, 140.0, None),
        (0.2, 0.3, 0.7, 0.8, None),
        (0.3, 0.4, 0.6, 0.8, 0.9, None),
        (0.5, 0.6, 0.7, 0.8, None),
        (0.5, 0.6, None),
    )
    rows = list(itertools.product(*steps))
    got = categories(spark, rows)
    assert got == [expected(*row) for row in rows]
    assert set(got) == set(labels()) - {"Rock🎸"}


maybe = st.none() | st.floats(0, 1)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(maybe, st.none() | st.floats(60, 200), maybe, maybe, maybe, maybe),
        min_size=50,
        max_size=100,
    )
)
def test_random_rows_match_plain_python(spark, rows):
    assert categories(spark, rows) == [expected(*row) for row in rows]


def test_domain_in_order_and_byte_exact(spark):
    rows = cm.category_domain(spark).orderBy("position").collect()
    assert [r.position for r in rows] == list(range(1, 10))
    assert [r.category for r in rows] == labels()
    assert labels()[-1] == DEFAULT_LABEL
    assert labels()[1] == "Classic\U0001f3db️"


def test_rules_are_data(spark):
    rules = (("fast", (("tempo", ">", 100.0),)),)
    frame = spark.createDataFrame([(101.0,), (100.0,), (None,)], "tempo double").coalesce(1)
    got = [r.category for r in cm.classify(frame, rules, "slow").collect()]
    assert got == ["fast", "slow", "slow"]
    assert len(RULES) == 8
