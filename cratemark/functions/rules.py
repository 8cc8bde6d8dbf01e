"""The category rules, as data, and the column expression made from them."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Test = tuple[str, str, float]
Rule = tuple[str, tuple[Test, ...]]

# Labels, thresholds and their order. The first rule whose tests
# all hold gives the label; every comparison is strict. "Classic" ends in the
# variation selector U+FE0F. "Rock" asks for more than "HipHop" does and comes
# later, so it never wins; it stays because its label is part of the domain.
RULES: tuple[Rule, ...] = (
    ("Metal🤘", (("energy", ">", 0.7), ("tempo", ">", 120.0), ("acousticness", "<", 0.3))),
    ("Classic🏛️", (("acousticness", ">", 0.7), ("energy", "<", 0.5), ("tempo", "<", 100.0))),
    ("Podcast🎧", (("speechiness", ">", 0.8),)),
    ("Vocal🎤", (("speechiness", ">", 0.4),)),
    ("Electro⚡", (("energy", ">", 0.6), ("tempo", ">", 120.0), ("danceability", ">", 0.7))),
    (
        "HipHop🎤",
        (("energy", ">", 0.6), ("tempo", ">", 100.0), ("tempo", "<", 140.0), ("danceability", ">", 0.5)),
    ),
    (
        "Soul🎷",
        (
            ("valence", ">", 0.5),
            ("danceability", ">", 0.5),
            ("danceability", "<", 0.7),
            ("energy", ">", 0.4),
            ("energy", "<", 0.6),
        ),
    ),
    (
        "Rock🎸",
        (
            ("energy", ">", 0.6),
            ("tempo", ">", 100.0),
            ("tempo", "<", 140.0),
            ("danceability", ">", 0.5),
            ("danceability", "<", 0.7),
        ),
    ),
)
DEFAULT_LABEL = "Other🦦"
EVERY_CATEGORY = "all"

_COMPARE = {">": operator.gt, "<": operator.lt}


def labels(rules: Sequence[Rule] = RULES, default: str = DEFAULT_LABEL) -> list[str]:
    """The category domain in order; the default comes last."""
    return [label for label, _ in rules] + [default]


def all_hold(tests: Sequence[Test]) -> Column:
    """Conjunction of comparisons. A null operand makes it not hold."""
    return reduce(operator.and_, (_COMPARE[op](F.col(c), F.lit(x)) for c, op, x in tests))


def category_column(rules: Sequence[Rule] = RULES, default: str = DEFAULT_LABEL) -> Column:
    """First-match-wins cascade as one CASE expression."""
    (label, tests), *rest = rules
    cascade = F.when(all_hold(tests), F.lit(label))
    for label, tests in rest:
        cascade = cascade.when(all_hold(tests), F.lit(label))
    return cascade.otherwise(F.lit(default))
