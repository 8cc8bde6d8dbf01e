import hashlib
import os
import random

import pytest

from cratemark.llm import bpe
from cratemark.llm import queries as llm_queries

VOCABULARY = llm_queries.WORD_VOCABULARY
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no public vocabulary here")

# What meets at cuts: words, contractions, digits, signs, marks that compose, characters
# of several bytes, words longer than any window, special tokens whole and in part.
PIECES = [
    "the", "ing", "'s", "'", "'ll", "ll", "'re", "!!", "!!'s", "don't", " ", "\n", "  ", "日本", "é", "é",
    "J̌", "Σ", "İ", "1", "23", "٣", "<|endoftext|>", "<|startoftext|>", "<|end", "x" * 30, "ab" * 20, "!" * 25,
    "'" * 9, "😀", "😀" * 12, "‍", "aaaa", "-", "_", "</w>", "Ünï", "xyzzy" * 9,
]


def library(text):
    return bpe.encoder(VOCABULARY).whole.encode(text or "", add_special_tokens=False).ids


def by_tree(text, leaf):
    encode, ids = bpe.encoder(VOCABULARY), []
    for part in encode.parts(text):
        ids += [part] if isinstance(part, int) else encode.trees([(part, False)], leaf)[0].ids.tolist()
    return ids


@pytest.mark.parametrize("leaf", [1, 2, 3, 7, 20])
def test_trees_are_the_library(leaf):
    rng = random.Random(leaf)
    for _ in range(150):
        few = rng.sample(PIECES, rng.choice([2, 4, 12]))
        text = "".join(rng.choice(few) for _ in range(rng.randrange(60)))
        assert by_tree(text, leaf) == library(text), (leaf, text)


@pytest.mark.parametrize("text", ["a" * 5000, "lol" * 3000, "!?" * 2000, "日本語" * 1500, "'" * 3000, " " * 3000])
def test_words_longer_than_leaves(text):
    assert by_tree(text, 64) == by_tree(text, 1000) == library(text)


def test_only_windows_are_encoded_again(monkeypatch):
    text = "".join(random.Random(1).choice("abcdefghij") for _ in range(20_000))
    seen = []
    window = bpe.Encoder.window
    monkeypatch.setattr(
        bpe.Encoder, "window", lambda self, t, start, end, *a: seen.append(end - start) or window(self, t, start, end, *a)
    )
    assert by_tree(text, 500) == library(text)
    assert len(seen) >= 39 and sum(seen) < len(text) / 4


def test_rows(spark):
    texts = ["The quick brown fox", "", None, "é'" * 400, "<|endoftext|>" * 3, "x" * 900, "The quick brown fox"]
    texts += ["word's 12 " * 90 + "<|endoftext|>" + "!" * 300 + "J̌ " * 200, "  " * 300]
    rows = [(None if n == 3 else n // 2, t, "p") for n, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part string").repartition(3)
    tokens = bpe.encoded(docs, VOCABULARY, leaf=32, spread=100)
    found = bpe.decoded(tokens, VOCABULARY).collect()
    whole = bpe.encoder(VOCABULARY).whole
    expected = [(i, library(t), whole.decode(library(t), skip_special_tokens=False)) for i, t, _ in rows]
    assert sorted(str((r.doc_id, r.ids, r.decoded)) for r in found) == sorted(map(str, expected))
    assert bpe.decoded(bpe.encoded(docs.limit(0), VOCABULARY), VOCABULARY).collect() == []


def test_decoding_nulls(spark):
    frame = spark.createDataFrame([(1, None), (2, []), (3, [None, 343, -1, 10**9, 343])], "n int, ids array<int>")
    found = {r.n: r.decoded for r in bpe.decoded(frame, VOCABULARY).collect()}
    assert found == {1: "", 2: "", 3: "x</w> x</w>"}


def test_query_against_the_library(spark):
    found = {r.doc_id: r for r in llm_queries.op12_bpe(spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(docs)
    whole = bpe.encoder(VOCABULARY).whole
    for r in docs:
        ids = library(r.text)
        text = whole.decode(ids, skip_special_tokens=False)
        joined = " ".join(map(str, ids))
        own = found[r.doc_id]
        assert own.n_tokens == len(ids)
        assert own.ids_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert own.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_stretches_are_encoded_once(monkeypatch):
    encode = bpe.Encoder(VOCABULARY)
    seen = []
    learn = bpe.Stretches.learn
    monkeypatch.setattr(bpe.Stretches, "learn", lambda self, new: seen.extend(new) or learn(self, new))
    monkeypatch.setattr(bpe, "REMEMBERED", 40)
    rng = random.Random(3)
    often = ["the", "don't", "ing,", "é'!1", "日本", ""]
    for turn in range(90):
        text = " ".join(rng.choice([*often, f"w{turn}x{n}'s"]) for n in range(12))
        assert encode.trees([(text, False)], 4096)[0].ids.tolist() == library(text)
        assert len(encode.stretches.number) <= 40 + 12 and len(encode.stretches.tokens[0]) < 1000
    assert len(set(seen)) > 90
    # What is used again and again is not forgotten with the others.
    assert all(seen.count(word) == 1 for word in often)


def test_normalised_as_the_library_does():
    encode = bpe.encoder(VOCABULARY)
    signs = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000] + ["😀", "\U0001d15e"]
    rng = random.Random(4)
    texts = [f"A {c}́ B{c}\t{c}\n {c}" for c in signs]
    texts += ["".join(rng.choice(["A", " ", "\n", " ", "é", "e", "́", "Σ", "\x1c"]) for _ in range(9)) for _ in range(900)]
    for text in texts:
        assert encode.normalised(text) == encode.whole.normalizer.normalize_str(text), repr(text)


def test_other_tokenizers_ask_the_library(tmp_path):
    # Words that take the space before them are not looked up between spaces.
    from tokenizers import Tokenizer, models, pre_tokenizers

    names = [*pre_tokenizers.ByteLevel.alphabet(), "Ġa", "Ġab"]
    own = Tokenizer(models.BPE({n: i for i, n in enumerate(names)}, [("Ġ", "a"), ("Ġa", "b")]))
    own.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    own.save(str(path := tmp_path / "own.json"))
    encode = bpe.Encoder(str(path))
    assert encode.stretches is None and not encode.plain
    text = "ab ab A  ab"
    assert encode.trees([(encode.normalised(text), False)], 4096)[0].ids.tolist() == own.encode(text).ids
