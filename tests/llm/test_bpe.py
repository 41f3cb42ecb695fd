from __future__ import annotations

import random

import numpy as np
import pytest

from tillwork.llm import bpe

tokenizers = pytest.importorskip("tokenizers")

PARTS = ["a", "b", "e", "aa", "aaa", "th", "the", "ing", "!", "!!", "...", "1", "22", "'s", "'ll", " ", "\n", "<|endoftext|>", "<|startoftext|>", "<|", "é",
         "e\u0301", "ß", "Σ", "ΑΣ", "İ", "中", "😀", "\u200d", "\xa0", "\x00", "\x1c", "haha", "....", "abababab", "lololol", "oooooo", "\u0558"]


@pytest.fixture(scope="module")
def both():
    path = bpe.vocabulary_path()
    return tokenizers.Tokenizer.from_file(path), bpe.Coder(path)


def same(both, texts):
    library, coder = both
    for text, theirs, words in zip(texts, library.encode_batch(texts, add_special_tokens=False), coder.encode(texts)):
        assert np.frombuffer(b"".join(word[2] for word in words), np.int32).tolist() == theirs.ids, text
        assert " ".join(word[1] for word in words) == library.decode(theirs.ids, skip_special_tokens=False)
        assert " ".join(word[0] for word in words) == " ".join(map(str, theirs.ids))


def test_random_texts_as_the_library(both):
    rng = random.Random(1)
    same(both, ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(4_000)])


def test_random_words_as_the_library(both):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(1, 16))) for _ in range(30_000)]
    same(both, [" ".join(words[k : k + 60]) for k in range(0, len(words), 60)])


def test_every_character_of_the_basic_plane(both):
    same(both, [f"a{chr(k)}b {chr(k)}1{chr(k)}" for k in range(0x10000) if not 0xD800 <= k < 0xE000])


def test_whole_and_long_texts_on_spark(spark, both, prose):
    texts = [None, "", " ", prose(1, 20_000), "a" * 50_000, "Hello World<|endoftext|>again"]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path = bpe.vocabulary_path()
    library, _ = both
    for row in bpe.decode(bpe.encode(documents, path), path).collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["ids"] == ids and row["decoded"] == library.decode(ids, skip_special_tokens=False)
    assert sorted(map(str, bpe.round_trip(documents, path).collect())) == sorted(map(str, bpe.decode(bpe.encode(documents, path), path).collect()))
