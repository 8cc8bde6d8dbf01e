"""Toxicity: a support vector machine on a gapped subsequence kernel.

The kernel counts what four characters two sentences have in common, in order but
not necessarily next to each other: between two of them one character may be
skipped. An occurrence weighs the product of its skips, where skipping a letter
costs most, and skipping a space or an inserted sign little, so that "i.d-i o.t"
still holds most of "idiot". The kernel is normalised by the weight that each
sentence has in all.

Nyström landmarks (telling words of the labelled texts, and sentences) turn the
kernel into a few hundred coordinates, in which a linear machine with squared hinge
loss is trained. As labels are given to documents while insults are in sentences,
training goes in rounds: the sentence that scores highest speaks for its document.

A linear function of the coordinates is linear in the four-character subsequences
too, so the trained machine is one table with a weight for each of them, and a
text is scored by adding up table entries.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Labelled documents of each class that training takes: those with the least
# hashes of their ids. The only bound; statistics and scores know no other.
TRAIN_DOCS = 1000
WORD_LANDMARKS = 256
SENTENCE_LANDMARKS = 96
ROUNDS = 4
PENALTY = 0.0001
# A longer sentence is cut into pieces of this many characters.
PIECE = 80
# A sentence counts as having this weight at least (about that of 50 letters), so
# that a few shared characters do not make a short one alike.
LEAST_MASS = 100.0

_CLASSES, _BITS = 32, 5
_OTHER, _SPACE = 0, 1
_STEPS = [(a, b, c) for a in (1, 2) for b in (1, 2) for c in (1, 2)]
_PAD = 8


def _class_table() -> np.ndarray:
    """Character classes of code points below 0x10000: letters of ASCII each
    their own, all other letters one of four, digits and signs that stand in for
    letters as those letters."""
    table = np.zeros(1 << 16, dtype=np.uint8)
    for code in range(1 << 16):
        sign = chr(code)
        if "a" <= sign <= "z":
            table[code] = 2 + code - ord("a")
        elif sign.isspace():
            table[code] = _SPACE
        elif code > 127 and sign.isalpha():
            table[code] = 28 + code % 4
    for sign, letter in zip("013457@$", "oieastas"):
        table[ord(sign)] = 2 + ord(letter) - ord("a")
    return table


_TABLE = _class_table()
# What skipping one character costs, by its class.
_SKIP = np.full(_CLASSES, 0.5, dtype=np.float32)
_SKIP[_OTHER], _SKIP[_SPACE] = 0.95, 0.8


def _codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.minimum(points, 0xFFFF).astype(np.uint16)


def sentence_starts(points: np.ndarray) -> np.ndarray:
    """Where sentences begin: after a line feed, and after a full stop, question
    or exclamation mark that white space follows; long ones also in between."""
    if not len(points):
        return np.zeros(1, dtype=np.int64)
    ends = points == 10
    stops = (points == 46) | (points == 33) | (points == 63)
    ends[:-1] |= stops[:-1] & (_TABLE[points[1:]] == _SPACE)
    starts = np.concatenate([[0], np.flatnonzero(ends[:-1]) + 1])
    lengths = np.diff(np.concatenate([starts, [len(points)]]))
    if lengths.max() > PIECE:
        more = [
            np.arange(s + PIECE, s + n, PIECE) for s, n in zip(starts[lengths > PIECE], lengths[lengths > PIECE])
        ]
        starts = np.sort(np.concatenate([starts, *more]))
    return starts


def _occurrences(
    classes: np.ndarray, left: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, weights) of the subsequences from each place on, by the pattern of
    skips. ``left`` is how many characters of its sentence each place has from
    there on: one that would reach further weighs nothing. ``classes`` ends with
    ``_PAD`` places more, which begin none."""
    n = len(left)
    wide = classes.astype(np.int32)
    skip = _SKIP[classes]
    pairs = {1: (wide[:-1] << _BITS) | wide[1:], 2: (wide[:-2] << _BITS) | wide[2:]}
    for a, b, c in _STEPS:
        ids = (pairs[a][:n] << (2 * _BITS)) | pairs[c][a + b : a + b + n]
        weights = (left > a + b + c).astype(np.float32)
        for at, step in ((0, a), (a, b), (a + b, c)):
            if step == 2:
                weights *= skip[at + 1 : at + 1 + n]
        yield ids, weights


def _padded(points: np.ndarray) -> np.ndarray:
    return np.concatenate([_TABLE[points], np.full(_PAD, _SPACE, dtype=np.uint8)])


def _mass(ids: np.ndarray, weights: np.ndarray) -> float:
    """The kernel of a sentence with itself, but ``LEAST_MASS`` at least."""
    _, place = np.unique(ids, return_inverse=True)
    sums = np.bincount(place, weights)
    return max(LEAST_MASS, float((sums * sums).sum()))


@dataclass(frozen=True)
class Model:
    """``table`` weighs subsequences; ``slope`` and ``offset`` make a share of
    1 out of the highest margin of a document."""

    table: np.ndarray
    bias: float
    slope: float
    offset: float

    def margins(self, points: np.ndarray, starts: np.ndarray) -> np.ndarray:
        if not len(points):
            return np.full(1, self.bias)
        found = np.zeros(len(points), dtype=np.float32)
        mass = np.zeros(len(points), dtype=np.float32)
        ends = np.append(starts[1:], len(points))
        left = np.repeat(ends, np.diff(np.append(starts, len(points)))) - np.arange(len(points))
        for ids, weights in _occurrences(_padded(points), left):
            found += weights * self.table[ids]
            mass += weights * weights
        sums = np.add.reduceat(found, starts, dtype=np.float64)
        masses = np.add.reduceat(mass, starts, dtype=np.float64)
        return sums / np.sqrt(np.maximum(masses, LEAST_MASS)) + self.bias

    def highest(self, points: np.ndarray, starts: np.ndarray) -> tuple[float, int]:
        """The highest margin, and its sentence. ``margins`` takes every
        subsequence of a sentence for a different one; where one comes again and
        again, the sentence weighs more, and its margin is nearer to the bias. That
        is looked up for leading sentences that could count as toxic."""
        margins, exact = self.margins(points, starts), set()
        while True:
            at = int(np.argmax(margins))
            if at in exact or margins[at] < -0.25 or not len(points):
                return float(margins[at]), at
            exact.add(at)
            ids, weights = _Landmarks.occurrences(_piece(points, starts, at))
            found = float((weights * self.table[ids]).sum())
            margins[at] = min(margins[at], found / np.sqrt(_mass(ids, weights)) + self.bias)

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margins + self.offset, -30.0, 30.0)))


# --- training -----------------------------------------------------------------


class _Landmarks:
    """Nyström coordinates: kernel values with the landmarks, whitened."""

    def __init__(self, texts: list[str]) -> None:
        vectors = [self._vector(_codes(t)) for t in texts]
        ids = np.unique(np.concatenate([v[0] for v in vectors]))
        self.ids = ids
        self.column = np.full(_CLASSES**4, len(ids), dtype=np.int32)
        self.column[ids] = np.arange(len(ids))
        # One row more, of zeros, for subsequences that no landmark has.
        self.rows = np.zeros((len(ids) + 1, len(texts)), dtype=np.float32)
        for k, (own, weights) in enumerate(vectors):
            np.add.at(self.rows[:, k], self.column[own], weights)
        gram = self.rows.T.astype(np.float64) @ self.rows
        values, vectors_ = np.linalg.eigh(gram)
        kept = values > 1e-3 * values.max()
        self.whiten = vectors_[:, kept] / np.sqrt(values[kept])

    @staticmethod
    def occurrences(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left = len(points) - np.arange(len(points))
        ids, weights = zip(*_occurrences(_padded(points), left))
        ids, weights = np.concatenate(ids), np.concatenate(weights)
        return ids[weights > 0], weights[weights > 0]

    @classmethod
    def _vector(cls, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, weights = cls.occurrences(points)
        return ids, weights / np.sqrt(_mass(ids, weights))

    def coordinates(self, points: np.ndarray) -> np.ndarray:
        ids, weights = self._vector(points)
        at = self.column[ids]
        held = at < len(self.ids)
        return (weights[held] @ self.rows[at[held]]) @ self.whiten

    def table(self, w: np.ndarray) -> np.ndarray:
        table = np.zeros(_CLASSES**4, dtype=np.float32)
        table[self.ids] = (self.rows[:-1] @ (self.whiten @ w)).astype(np.float32)
        return table


def _fit_machine(x: np.ndarray, y: np.ndarray, penalty: float) -> tuple[np.ndarray, float]:
    """Squared hinge loss by Newton's method; classes weigh the same."""
    x = np.hstack([x, np.ones((len(x), 1))])
    each = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    ridge = penalty * np.eye(x.shape[1]) / x.shape[0] ** 0.5
    ridge[-1, -1] = 1e-9
    w, active = np.zeros(x.shape[1]), None
    for _ in range(30):
        inside = y * (x @ w) < 1
        if active is not None and (inside == active).all():
            break
        active = inside
        own = x[active] * each[active, None]
        w = np.linalg.solve(own.T @ x[active] + ridge, own.T @ y[active])
    return w[:-1], float(w[-1])


def _fit_share(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic curve through the highest margins, by Newton's method; targets
    are drawn in a little, as usual."""
    n, p = (y < 0).sum(), (y > 0).sum()
    target = np.where(y > 0, (p + 1.0) / (p + 2.0), 1.0 / (n + 2.0))
    each = np.where(y > 0, 0.5 / p, 0.5 / n)
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    v = np.array([1.0, 0.0])
    for _ in range(50):
        share = 1.0 / (1.0 + np.exp(-np.clip(x @ v, -30, 30)))
        slope = x.T @ (each * (share - target)) + 1e-6 * v
        bend = (x * (each * share * (1 - share))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        v = v - step * min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return float(v[0]), float(v[1])


def fit(texts: list[str], toxic: list[int]) -> Model:
    """Train on documents with labels. Without both labels: a constant model that
    calls nothing toxic, or everything if all labels are 1."""
    y = np.where(np.array(toxic) > 0, 1.0, -1.0)
    if not len(y) or (y > 0).all() or (y < 0).all():
        all_toxic = bool(len(y)) and y[0] > 0
        return Model(np.zeros(_CLASSES**4, np.float32), 0.0, 0.0, 30.0 if all_toxic else -30.0)
    docs = [_codes(t) for t in texts]
    starts = [sentence_starts(d) for d in docs]
    # Documents by word: of the toxic ones, and of the others for those words.
    counts = Counter(w for t, k in zip(texts, y) if k > 0 for w in _words(t))
    counts = {w: k for w, k in counts.items() if k > 1}
    others = Counter(w for t, k in zip(texts, y) if k < 0 for w in _words(t) & counts.keys())
    n_toxic, n_other = (y > 0).sum(), (y < 0).sum()
    odds = {
        w: np.log((k + 0.1) / (n_toxic + 1)) - np.log((others[w] + 0.5) / (n_other + 1))
        for w, k in counts.items()
    }
    telling = sorted(counts, key=lambda w: (-odds[w] * counts[w] ** 0.5, w))[:WORD_LANDMARKS]
    rng = np.random.default_rng(0)
    any_of = rng.permutation(len(texts))
    sentences = []
    for k in any_of[: SENTENCE_LANDMARKS]:
        at = rng.integers(len(starts[k]))
        sentences.append("".join(map(chr, _piece(docs[k], starts[k], at))))
    landmarks = _Landmarks([f" {w} " for w in telling] + [s for s in sentences if s.strip()] or [" "])
    # First guess: the place of the most telling word.
    chosen = [_first_guess(t, s, odds) for t, s in zip(texts, starts)]
    negatives: list[tuple[int, int]] = []
    known: dict[tuple[int, int], np.ndarray] = {}
    spelled: dict[tuple[int, int], np.ndarray | None] = {}
    model = None
    for _ in range(ROUNDS):
        negatives = sorted(
            {*negatives}
            | {(k, int(a)) for k in np.flatnonzero(y < 0) for a in (chosen[k], rng.integers(len(starts[k])))}
        )
        positives = [(k, chosen[k]) for k in np.flatnonzero(y > 0)]
        for k, a in positives + negatives:
            if (k, a) not in known:
                known[k, a] = landmarks.coordinates(_piece(docs[k], starts[k], a))
        # The same sentences with their most telling word spelled with gaps.
        gapped = []
        for k, a in positives:
            if (k, a) not in spelled:
                text = _gapped("".join(map(chr, _piece(docs[k], starts[k], a))), odds, rng)
                spelled[k, a] = None if text is None else landmarks.coordinates(_codes(text))
            if spelled[k, a] is not None:
                gapped.append(spelled[k, a])
        x = np.stack([known[key] for key in positives + negatives] + gapped)
        labels = np.concatenate(
            [np.ones(len(positives)), -np.ones(len(negatives)), np.ones(len(gapped))]
        )
        w, bias = _fit_machine(x, labels, PENALTY)
        model = Model(landmarks.table(w), bias, 1.0, 0.0)
        highest, chosen = zip(*(model.highest(d, s) for d, s in zip(docs, starts)))
    slope, offset = _fit_share(np.array(highest), y)
    return Model(model.table, model.bias, slope, offset)


def _words(text: str) -> set[str]:
    return set(re.findall(r"\w+", text.lower()))


def _piece(points: np.ndarray, starts: np.ndarray, at: int) -> np.ndarray:
    return points[starts[at] : starts[at + 1] if at + 1 < len(starts) else len(points)]


def _gapped(text: str, odds: dict[str, float], rng: np.random.Generator) -> str | None:
    """The text with signs put into its most telling word: between all letters, or
    at one place. None if no word tells."""
    found = max(re.finditer(r"\w{3,}", text), key=lambda m: odds.get(m[0], -9.0), default=None)
    if found is None or odds.get(found[0], -9.0) < 2.0:
        return None
    word, sign = found[0], str(rng.choice(list(".-*_ ")))
    at = int(rng.integers(1, len(word)))
    word = sign.join(word) if rng.integers(3) else word[:at] + sign + word[at:]
    return text[: found.start()] + word + text[found.end() :]


def _first_guess(text: str, starts: np.ndarray, odds: dict[str, float]) -> int:
    lowered = text.lower()
    best = max(re.finditer(r"\w+", lowered), key=lambda m: odds.get(m[0], -9.0), default=None)
    return 0 if best is None else int(np.searchsorted(starts, best.start(), side="right") - 1)


def train(
    docs: DataFrame,
    labels: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    label_col: str = "toxic",
    most_docs: int = TRAIN_DOCS,
) -> Model:
    """A model from the labelled rows of ``docs``, at most ``most_docs`` of each
    label, chosen by a hash of the id. Rows without a label or id teach nothing;
    several labels of an id count as the highest, of several texts the least counts."""
    wanted = (
        labels.select(labels[id_col].alias("_id"), labels[label_col].cast("int").alias("_label"))
        .where(F.col("_id").isNotNull() & F.col("_label").isNotNull())
        .groupBy("_id")
        .agg(F.max("_label").alias("_label"))
        .withColumn("_place", F.xxhash64("_id"))
    )
    picked = None
    for one in (F.col("_label") > 0, F.col("_label") <= 0):
        # No more than most_docs rows a label, so a broadcast has a fixed bound.
        some = wanted.where(one).orderBy("_place", "_id").limit(most_docs)
        picked = some if picked is None else picked.unionByName(some)
    sample = docs.select(docs[id_col].alias("_doc"), docs[text_col].alias("_text")).join(
        F.broadcast(picked), F.col("_doc") == F.col("_id")
    )
    # One text of each id, so that repeated ids do not grow what is trained on.
    texts = sample.groupBy("_place", "_id", "_label").agg(F.min(F.coalesce("_text", F.lit(""))).alias("_text"))
    found = texts.repartition(1).mapInArrow(_trained(fit), "model binary").first()
    return fit([], []) if found is None else pickle.loads(bytes(found["model"]))


def _trained(fit: Callable[[list[str], list[int]], Model]):
    """The model of a bounded sample, in a task: texts, and the memory that training
    takes, are no burden to the driver, which gets one table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: (r["_place"], str(r["_id"])))
        model = fit([r["_text"] for r in rows], [r["_label"] for r in rows])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    return run


def scorer(spark: SparkSession, model: Model) -> Callable[[Column], Column]:
    """Column function that scores texts. A null text counts as empty. Only texts
    go to Python; each is scored by itself."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def toxic_score(texts: pd.Series) -> pd.Series:
        own = shared.value
        return pd.Series(own.scores(np.array([_highest(own, t or "") for t in texts])))

    return toxic_score


def score(
    docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """Per row of ``docs``: the columns ``keep`` and score, 0 to 1: the highest of
    its sentences. Whole texts are read; a null text counts as empty. Every row
    is scored by itself, so repeated rows, hot sources and empty tables need no
    care; other columns are not read."""
    toxic_score = scorer(docs.sparkSession, model)
    return docs.select(*[docs[c] for c in keep], toxic_score(docs[text_col]).alias("score"))


def without_toxic(
    docs: DataFrame, model: Model, text_col: str = "text", limit: float = 0.5
) -> DataFrame:
    """Rows of ``docs`` that score below ``limit``, with all their columns."""
    return docs.where(scorer(docs.sparkSession, model)(docs[text_col]) < limit)


def _highest(model: Model, text: str, stretch: int = 1 << 18) -> float:
    """The highest margin of a text, some sentences at a time."""
    points = _codes(text)
    starts = sentence_starts(points)
    if len(points) <= stretch:
        return model.highest(points, starts)[0]
    best, at = -np.inf, 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + stretch)))
        end = starts[to] if to < len(starts) else len(points)
        part, _ = model.highest(points[starts[at] : end], starts[at:to] - starts[at])
        best, at = max(best, part), to
    return best
