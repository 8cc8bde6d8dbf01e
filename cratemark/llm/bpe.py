"""Byte-pair encoding by tree concatenation, and decoding.

A text is cut into leaves without regard to words. The leaves are encoded each on
its own, and neighbours are put together in pairs until one is left. At a join,
what lies around the cut is encoded anew, in a window that grows until it agrees
with both sides: on the left it begins where a word begins or with a token that
comes out as before, on the right it comes upon a word's beginning, or within a
long word upon a token, that the right side has too. Pairs of tokens that stand
side by side in an encoding are right wherever they occur together, so the left
side up to the window, the window, and the right side from there on are the
encoding of the whole.

Where a vocabulary's words end at spaces, a leaf is the stretches between its spaces
side by side. A worker remembers the tokens of stretches, so that the library encodes
only those of a leaf that are new to it.

Texts beyond ``SPREAD`` characters are cut into pieces that different tasks encode,
each by its own tree; one task per text then joins the pieces, for which it
encodes nothing but windows.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, compress, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters of a leaf, and of a piece that a task gets of a longer text.
LEAF = 4096
SPREAD = 1 << 16
# Tokens on either side of a cut that the first window has.
WINDOW = 8
# Longer than any word that the pattern takes for its first characters: within a
# word, from here on, its kind is that of its characters.
FIXED_WORD = 4
# Stretches between spaces, and their characters, that a worker remembers.
REMEMBERED = 1 << 18
REMEMBERED_CHARS = 1 << 22

# Words that neither hold white space nor depend on what is beyond it, as tokenizer
# files have them, and a normaliser that changes no more of ASCII than white space
# and capitals.
_APART = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
_PLAIN = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
_GAPS = re.compile(r"[\t-\r ]{2,}|[\t-\r]")
_SPACES = re.compile(" {2,}")


@dataclass
class Node:
    """Tokens of ``text[start:end]``: ids, where each begins and ends in the text,
    and whether it is the first of a word."""

    start: int
    end: int
    ids: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def cut(self, i: int, j: int) -> tuple[np.ndarray, ...]:
        return self.ids[i:j], self.begins[i:j], self.ends[i:j], self.first[i:j]

    def moved(self, by: int) -> Node:
        return Node(self.start + by, self.end + by, self.ids, self.begins + by, self.ends + by, self.first)


def _together(start: int, end: int, *parts: tuple[np.ndarray, ...]) -> Node:
    return Node(start, end, *(np.concatenate(arrays) for arrays in zip(*parts)))


_NOTHING = (np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))


class Stretches:
    """Tokens of the stretches between spaces that a worker has met: those of one
    stretch after the other, and which are whose."""

    def __init__(self, text):
        self.text = text
        self.number: dict[str, int] = {}
        self.chars = 0
        self.starts = np.zeros(1, np.int64)
        self.uses = np.zeros(0, np.int64)
        self.tokens = tuple(a[:0].astype(np.int32) for a in _NOTHING[:3]) + _NOTHING[3:]

    def forget(self) -> None:
        """All that were not used more than once lately; if that is too few, all."""
        keep = self.uses > 1
        number = dict(zip(compress(self.number, keep), range(len(keep))))
        chars = sum(map(len, number))
        if 2 * len(number) > REMEMBERED or 2 * chars > REMEMBERED_CHARS:
            keep[:], number, chars = False, {}, 0
        counts = np.diff(self.starts)
        held = np.repeat(keep, counts)
        self.number, self.chars = number, chars
        self.starts = np.append(0, np.cumsum(counts[keep]))
        self.uses = np.zeros(len(number), np.int64)
        self.tokens = tuple(a[held] for a in self.tokens)

    def learn(self, stretches: list[str]) -> None:
        """Encode new ones, many in one text with spaces between."""
        sizes = np.array([len(s) for s in stretches], dtype=np.int64)
        at = np.cumsum(sizes + 1) - sizes - 1
        found = self.text.encode(" ".join(stretches), add_special_tokens=False)
        ids = np.array(found.ids, dtype=np.int32)
        offsets = np.fromiter(chain.from_iterable(found.offsets), np.int64, 2 * len(ids)).reshape(-1, 2)
        words = np.array(found.word_ids, dtype=np.int64)
        first = np.append(True, words[1:] != words[:-1])[: len(ids)]
        owner = np.searchsorted(at, offsets[:, 0], side="right") - 1
        begins, ends = (offsets - at[owner][:, None]).T
        new = ids, begins.astype(np.int32), ends.astype(np.int32), first
        self.tokens = tuple(np.concatenate(two) for two in zip(self.tokens, new))
        counts = np.bincount(owner, minlength=len(stretches))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)])
        self.number.update(zip(stretches, range(len(self.number), len(self.number) + len(stretches))))
        self.uses = np.append(self.uses, np.zeros(len(stretches), np.int64))
        self.chars += int(sizes.sum())

    def of(self, texts: list[str]) -> list[tuple[np.ndarray, ...]]:
        """Tokens of texts, as ``Encoder`` has them."""
        if len(self.number) > REMEMBERED or self.chars > REMEMBERED_CHARS:
            self.forget()
        split = [t.split(" ") for t in texts]
        flat = list(chain.from_iterable(split))
        numbers = list(map(self.number.get, flat))
        new = [i for i, n in enumerate(numbers) if n is None]
        if new:
            self.learn(list(dict.fromkeys(flat[i] for i in new)))
            for i in new:
                numbers[i] = self.number[flat[i]]
        numbers = np.array(numbers, dtype=np.int64)
        self.uses += np.bincount(numbers, minlength=len(self.uses))
        # Where each stretch begins in its text.
        many = np.array([len(s) for s in split], dtype=np.int64)
        sizes = np.fromiter(map(len, flat), np.int64, len(flat)) + 1
        begins = np.cumsum(sizes) - sizes
        begins -= np.repeat(begins[np.cumsum(many) - many], many)
        starts = self.starts[numbers]
        counts = self.starts[numbers + 1] - starts
        ends = np.cumsum(counts)
        at = np.arange(ends[-1]) + np.repeat(starts - ends + counts, counts)
        shift = np.repeat(begins, counts)
        ids, left, right, first = (a[at] for a in self.tokens)
        columns = ids, left + shift, right + shift, first
        cuts = np.append(0, ends[np.cumsum(many) - 1])
        return [tuple(a[i:j] for a in columns) for i, j in zip(cuts, cuts[1:])]


class Encoder:
    """The parts of a tokenizer file that a tree needs: one tokenizer for text whose
    characters are normalised already, and two for single words, of which one
    leaves the end of the word open."""

    def __init__(self, vocabulary: str):
        # A task has one core; the library would start a thread for each of the machine.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(vocabulary, encoding="utf-8") as file:
            parts = json.load(file)
        self.whole = Tokenizer.from_file(vocabulary)
        self.whole.no_padding()
        self.whole.no_truncation()
        plain = ("single_word", "lstrip", "rstrip", "normalized")
        if any(added[flag] for added in parts["added_tokens"] for flag in plain):
            raise ValueError(f"{vocabulary} has added tokens that are not plain strings")
        self.added = {added["content"]: added["id"] for added in parts["added_tokens"]}
        names = sorted(self.added, key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.plain = parts["normalizer"] == _PLAIN
        self.normal: dict[str, str] = {}
        parts |= {"normalizer": None, "added_tokens": [], "post_processor": None, "padding": None, "truncation": None}
        self.text = Tokenizer.from_str(json.dumps(parts))
        model = parts["model"]
        apart = parts["pre_tokenizer"] == _APART and not any(
            model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "ignore_merges")
        )
        self.stretches = Stretches(self.text) if apart else None
        as_bytes = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        parts["pre_tokenizer"] = as_bytes
        self.word = Tokenizer.from_str(json.dumps(parts))
        parts["model"] = {**parts["model"], "end_of_word_suffix": None}
        self.open_word = Tokenizer.from_str(json.dumps(parts))

    def parts(self, text: str) -> Iterator[int | str]:
        """The special tokens of a text, as ids, and the normalised text between."""
        for part in self._special.split(text) if self._special else [text]:
            if part in self.added:
                yield self.added[part]
            elif part:
                yield self.normalised(part)

    def normalised(self, text: str) -> str:
        """As the tokenizer's normaliser does. If that is plain, the library is asked
        only for stretches with more than ASCII: no character of theirs composes with
        white space of ASCII."""
        if not self.plain:
            return self.whole.normalizer.normalize_str(text) if self.whole.normalizer else text
        text = _GAPS.sub(" ", text)
        if text.isascii():
            return text.lower()
        found = []
        for stretch in text.split(" "):
            if stretch.isascii():
                found.append(stretch.lower())
                continue
            known = self.normal.get(stretch)
            if known is None:
                if len(self.normal) >= REMEMBERED >> 2:
                    self.normal.clear()
                known = self.whole.normalizer.normalize_str(stretch)
                if len(stretch) < 256:
                    self.normal[stretch] = known
            found.append(known)
        # Other white space has become spaces too.
        return _SPACES.sub(" ", " ".join(found))

    def _tokens(self, encoding, at: int, alone: bool = False) -> tuple[np.ndarray, ...]:
        """Arrays of an encoding; of a text that is not joined to any, only the ids."""
        ids = np.array(encoding.ids, dtype=np.int32)
        if alone or not len(ids):
            return ids, *_NOTHING[1:]
        offsets = np.array(encoding.offsets, dtype=np.int64) + at
        words = np.array(encoding.word_ids, dtype=np.int64)
        first = np.append(True, words[1:] != words[:-1])
        return ids, offsets[:, 0], offsets[:, 1], first

    def _one_word(self, text: str, start: int, end: int, is_open: bool) -> tuple[np.ndarray, ...]:
        one = (self.open_word if is_open else self.word).encode(text[start:end], add_special_tokens=False)
        return self._tokens(one, start)

    def _settled(self, text: str, tokens: tuple[np.ndarray, ...], end: int, is_open: bool) -> tuple[np.ndarray, ...]:
        """``tokens`` with the end of the last word open, if it touches an open end."""
        ids, begins, ends, first = tokens
        if not is_open or not len(ids) or ends[-1] < end:
            return tokens
        last = int(np.flatnonzero(first)[-1])
        word = self._one_word(text, int(begins[last]), end, True)
        return tuple(np.concatenate([old[:last], new]) for old, new in zip(tokens, word))

    def leaves(self, spans: list[tuple[str, int, int, bool, bool]]) -> list[Node]:
        """Every (text, start, end, whether the end is open, whether this is all of the
        text), encoded on its own."""
        texts = [t[a:b] for t, a, b, *_ in spans]
        if self.stretches is None:
            found = self.text.encode_batch(texts, add_special_tokens=False)
            tokens = [self._tokens(one, s[1], s[4]) for one, s in zip(found, spans)]
        else:
            few = self.stretches.of(texts) if texts else []
            tokens = [(ids, begins + s[1], ends + s[1], first) for (ids, begins, ends, first), s in zip(few, spans)]
        return [
            Node(a, b, *own) if whole else Node(a, b, *self._settled(t, own, b, is_open))
            for (t, a, b, is_open, whole), own in zip(spans, tokens)
        ]

    def _kind(self, char: str) -> str:
        """A character before which ``char`` goes on with the same word."""
        for before in ("a", "!"):
            if self.text.pre_tokenizer.pre_tokenize_str(before + char)[0][1] == (0, 2):
                return before
        return ""

    def window(self, text: str, start: int, end: int, is_open: bool, within: bool) -> tuple[np.ndarray, ...] | None:
        """Tokens of ``text[start:end]``. ``within`` a word, the text goes on with it;
        None if there is no telling how."""
        at, head = start, _NOTHING
        if within:
            kind = self._kind(text[start])
            if not kind:
                return None
            words = self.text.pre_tokenizer.pre_tokenize_str(kind + text[start:end])
            at = start + words[0][1][1] - 1
            head = self._one_word(text, start, at, is_open and at == end)
            head[3][0] = False
        rest = self._tokens(self.text.encode(text[at:end], add_special_tokens=False), at)
        return tuple(np.concatenate(two) for two in zip(head, self._settled(text, rest, end, is_open)))

    def joined(self, text: str, left: Node, right: Node, is_open: bool) -> Node:
        """The tokens of two neighbours' text. ``is_open`` tells whether more text
        follows the whole."""
        n, m, size = len(left.ids), len(right.ids), WINDOW
        while True:
            i, start, within = _beginning(left, n - size)
            j, end = _ending(right, size)
            tokens = self.window(text, start, end, is_open or end < len(text), within)
            if tokens is not None and (not within or _same(tokens, 0, left, i)):
                if j == m:
                    return _together(left.start, right.end, left.cut(0, i), tokens)
                met = _meeting(tokens, right, j, start, within)
                if met is not None:
                    u, v = met
                    return _together(
                        left.start, right.end, left.cut(0, i), tuple(a[:u] for a in tokens), right.cut(v, m)
                    )
            size *= 2

    def trees(self, texts: list[tuple[str, bool]], leaf: int, beside: bool = False) -> list[Node]:
        """Every (text, whether more follows), encoded by its own tree; all leaves in
        one call. ``beside`` says that they are pieces of longer texts."""
        spans, counts = [], []
        for text, is_open in texts:
            pieces = max(1, -(-len(text) // leaf))
            edges = [len(text) * p // pieces for p in range(pieces + 1)]
            counts.append(pieces)
            alone = pieces == 1 and not beside
            spans += [(text, a, b, is_open or b < len(text), alone) for a, b in zip(edges, edges[1:])]
        nodes = self.leaves(spans)
        out, at = [], 0
        for (text, is_open), count in zip(texts, counts):
            out.append(self.tree(text, nodes[at : at + count], is_open))
            at += count
        return out

    def tree(self, text: str, nodes: list[Node], is_open: bool = False) -> Node:
        while len(nodes) > 1:
            pairs = [nodes[p : p + 2] for p in range(0, len(nodes), 2)]
            nodes = [self.joined(text, *pair, is_open) if len(pair) == 2 else pair[0] for pair in pairs]
        return nodes[0]


def _beginning(left: Node, i: int) -> tuple[int, int, bool]:
    """Where a window begins on the left side: the token, its place in the text, and
    whether that is within a word."""
    low = max(0, i - WINDOW)
    if i > 0:
        heads = np.flatnonzero(left.first[low : i + 1])
        if len(heads):
            i = low + int(heads[-1])
            return i, int(left.begins[i]), False
        # Within a long word, at a token that begins with a character.
        while i > 0 and left.begins[i] < left.ends[i - 1]:
            i -= 1
        word = np.flatnonzero(left.first[:i])
        if i > 0 and not left.first[i] and left.begins[i] - left.begins[word[-1]] >= FIXED_WORD:
            return i, int(left.begins[i]), True
        if i > 0:
            i = int(word[-1])
            return i, int(left.begins[i]), False
    return 0, left.start, False


def _ending(right: Node, j: int) -> tuple[int, int]:
    """Up to which token of the right side a window goes, and where that ends."""
    m = len(right.ids)
    while j < m and right.begins[j] < right.ends[j - 1]:
        j += 1
    return (j, int(right.ends[j - 1])) if j < m else (m, right.end)


def _same(tokens: tuple[np.ndarray, ...], u: int, node: Node, v: int) -> bool:
    ids, begins, ends, _ = tokens
    return (
        len(ids) > u and ids[u] == node.ids[v] and begins[u] == node.begins[v] and ends[u] == node.ends[v]
    )


def _meeting(tokens: tuple[np.ndarray, ...], right: Node, j: int, start: int, within: bool) -> tuple[int, int] | None:
    """The first token of a window, and the one of the right side, from which on the
    right side stands."""
    _, begins, _, first = tokens
    places: dict[int, int] = {}
    word, words = right.start, []
    for v in range(j):
        if right.first[v]:
            word = int(right.begins[v])
        words.append(word)
        places.setdefault(int(right.begins[v]), v)
    # A word that a window begins within has begun long before.
    word = start - FIXED_WORD if within else start
    for u in range(len(begins)):
        here = int(begins[u])
        if first[u]:
            word = here
        v = places.get(here)
        if v is None or first[u] != right.first[v]:
            continue
        if first[u]:
            return u, v
        long_enough = min(here - word, here - words[v]) >= FIXED_WORD
        if long_enough and (u == 0 or tokens[2][u - 1] <= here) and _same(tokens, u, right, v):
            return u, v
    return None


_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """The encoder of a tokenizer file, once per Python worker."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *(len(r) for r in rows)]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))


def _encoded(vocabulary: str, leaf: int):
    """Texts whose task encodes them as a whole."""

    def of(texts: list[str]) -> list[np.ndarray]:
        encode = encoder(vocabulary)
        parts = [list(encode.parts(text)) for text in texts]
        found = iter(encode.trees([(p, False) for own in parts for p in own if isinstance(p, str)], leaf))
        out = []
        for own in parts:
            ids = [next(found).ids if isinstance(p, str) else np.array([p], np.int32) for p in own]
            out.append(np.concatenate([np.zeros(0, np.int32), *ids]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                few = batch.slice(at, 256)
                ids = of([t or "" for t in few.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([few.column(0), _lists(ids)], ["id", "ids"])

    return run


_PIECES = "row bigint, part int, piece int, special int, text string, more boolean"
_NODES = f"{_PIECES}, ids array<int>, begins array<int>, ends array<int>, first array<boolean>"


def _cut(vocabulary: str, spread: int):
    """Long texts as special tokens and pieces of normalised text."""
    names = ["row", "id", "part", "piece", "special", "text", "more"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            for n in range(batch.num_rows):
                ids = batch.column(1).slice(n, 1)
                row = batch.column(0)[n].as_py()
                for part, own in enumerate(encode.parts(batch.column(2)[n].as_py())):
                    if isinstance(own, int):
                        cuts = [(0, own, None, False)]
                    else:
                        starts = range(0, len(own), spread)
                        cuts = [(k, None, own[a : a + spread], a + spread < len(own)) for k, a in enumerate(starts)]
                    for piece, special, text, more in cuts:
                        values = [[row], None, [part], [piece], [special], [text], [more]]
                        types = [pa.int64(), None, pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.bool_()]
                        arrays = [ids if v is None else pa.array(v, t) for v, t in zip(values, types)]
                        yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def _piece_nodes(vocabulary: str, leaf: int):
    """Pieces with their tokens, each encoded by its own tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            texts, more = batch.column("text").to_pylist(), batch.column("more").to_pylist()
            nodes = encode.trees([(t or "", m) for t, m in zip(texts, more)], leaf, True)
            arrays = [_lists([getattr(n, name).astype(np.int32) for n in nodes]) for name in ("ids", "begins", "ends")]
            flags = [_lists([n.first.astype(np.int32) for n in nodes]).cast(pa.list_(pa.bool_()))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *arrays, *flags], [*batch.schema.names, "ids", "begins", "ends", "first"]
            )

    return run


def _whole(vocabulary: str):
    """One text from the nodes of all its pieces."""

    def run(pieces: pa.Table) -> pa.Table:
        encode = encoder(vocabulary)
        pieces = pieces.sort_by([("part", "ascending"), ("piece", "ascending")])
        rows = pieces.drop_columns(["row", "id"]).to_pylist()
        ids = [np.zeros(0, np.int32)]
        for _, same in groupby(rows, key=lambda r: r["part"]):
            own = list(same)
            if own[0]["special"] is not None:
                ids.append(np.array([own[0]["special"]], np.int32))
                continue
            nodes, start = [], 0
            for r in own:
                arrays = (np.array(r[k], np.int64) for k in ("ids", "begins", "ends"))
                nodes.append(Node(0, len(r["text"]), *arrays, np.array(r["first"], bool)).moved(start))
                start += len(r["text"])
            ids.append(encode.tree("".join(r["text"] for r in own), nodes).ids.astype(np.int32))
        return pa.table({"id": pieces.column("id").slice(0, 1), "ids": _lists([np.concatenate(ids)])})

    return run


def encoded(
    docs: DataFrame, vocabulary: str, text_col: str = "text", id_col: str = "doc_id",
    leaf: int = LEAF, spread: int = SPREAD,
) -> DataFrame:
    """Per row of ``docs``: id and ``ids``, the token ids of the text, as the tokenizer
    of the file ``vocabulary`` encodes it without adding special tokens. The file is
    a path that all executors can open; its model is byte-level BPE. Strings of its
    special tokens in a text are these tokens, as in the library.

    Nulls: a null or empty text has no tokens. Rows without an id and repeated rows
    each have their row; an empty table gives no rows; other columns are not read.
    Very long texts are encoded by many tasks. The joined tokens of a text are one
    row, hence one task's.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    is_long = F.coalesce(F.length("text"), F.lit(0)) > spread
    result = f"id {id_type}, ids array<int>"
    short = texts.where(~is_long).mapInArrow(_encoded(vocabulary, leaf), result)
    long = (
        texts.where(is_long)
        .select(F.monotonically_increasing_id().alias("row"), "id", "text")
        .mapInArrow(_cut(vocabulary, spread), _PIECES.replace("part", f"id {id_type}, part", 1))
        .repartition("row", "part", "piece")
        .mapInArrow(_piece_nodes(vocabulary, leaf), _NODES.replace("part", f"id {id_type}, part", 1))
        .groupBy("row")
        .applyInArrow(_whole(vocabulary), result)
    )
    return short.unionByName(long).select(F.col("id").alias(id_col), "ids")


def decoded(tokens: DataFrame, vocabulary: str, ids_col: str = "ids") -> DataFrame:
    """``tokens`` with ``decoded``, the text that the tokenizer makes of the ids, special
    tokens included. Null ids, and ids that the vocabulary lacks, stand for nothing.

    A tokenizer without a decoder puts its tokens side by side with spaces between,
    which is a join of strings; one with a decoder is asked itself.
    """
    schema = T.StructType([*tokens.schema, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = encoder(vocabulary).whole
        names = pa.array([whole.id_to_token(i) for i in range(whole.get_vocab_size())], pa.string())
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                few = batch.slice(at, 256)
                lists = few.column(few.schema.names.index(ids_col))
                if whole.decoder is None:
                    texts = _side_by_side(lists, names)
                else:
                    own = [[i for i in ids or () if i is not None] for ids in lists.to_pylist()]
                    texts = pa.array(whole.decode_batch(own, skip_special_tokens=False), pa.string())
                yield pa.RecordBatch.from_arrays([*few.columns, texts], [*few.schema.names, "decoded"])

    return tokens.mapInArrow(run, schema)


def _side_by_side(lists: pa.Array, names: pa.Array) -> pa.Array:
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    ids = lists.flatten()
    known = pc.and_(pc.greater_equal(ids, 0), pc.less(ids, len(names))).fill_null(False)
    kept = names.take(ids.filter(known))
    there = np.concatenate([[0], np.cumsum(known.to_numpy(zero_copy_only=False))])
    ends = there[np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)].astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), kept), " ")
