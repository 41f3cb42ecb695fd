from __future__ import annotations

import functools
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillwork.llm import packing


@functools.cache
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.vocabulary_path())


@functools.cache
def ids_of(text):
    """The whole text at once by the library."""
    coder = library()
    return [*coder.encode(text or "", add_special_tokens=False).ids, 0]


@pytest.fixture(scope="module")
def documents(prose):
    rng = random.Random(13)
    found = [(k, prose(k, rng.choice([1, 20, 60, 200, 500, 1_500]))) for k in range(250)]
    found += [(300, None), (301, ""), (302, " \n "), (303, "a <|endoftext|> b  c\n\n d"), (304, "é中文 " * 3_000), (None, "no id"), (None, None)]
    return found + [found[2], found[2], (2, "other text"), (305, "x" * 5_000), (306, prose(6, 60_000)), (307, "1 2 " * 30_000)]


def check(rows, documents, capacity):
    """Every piece is there once, in order, and sequences are filled without gaps."""
    expected = defaultdict(int)
    for doc_id, text in documents:
        ids = ids_of(text)
        first = len(ids) % capacity or capacity
        bounds = [0, *range(min(first, len(ids)), len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
            expected[doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    found, places = defaultdict(int), defaultdict(list)
    for row in rows:
        found[row["doc_id"], row["piece"], row["start"], row["length"], row["ids_crc32"]] += 1
        places[row["sequence_id"]].append((row["offset"], row["length"]))
    assert found == expected
    for one in places.values():
        end = 0
        for offset, length in sorted(one):
            assert offset == end
            end += length
        assert end <= capacity
    return len(places)


@pytest.mark.parametrize(("capacity", "shard"), [(2_048, 8_000), (2_048, 40), (64, 8_000), (1, 8_000)])
def test_pieces_and_places(spark, documents, monkeypatch, capacity, shard):
    monkeypatch.setattr(packing, "SHARD", shard)
    monkeypatch.setattr(packing, "HELD", 3_000)
    chosen = documents if capacity > 1 else documents[:12]
    docs = spark.createDataFrame(chosen, "doc_id long, text string").withColumn("offset", F.lit("clash")).repartition(3)
    packed = packing.pack(docs, packing.vocabulary_path(), capacity).drop("clash").cache()
    n = check(packed.collect(), chosen, capacity)
    total = packed.agg(F.sum("length")).first()[0]
    if shard > 40:
        assert n <= 1.01 * -(-total // capacity) + 1
    joined = {row["sequence_id"]: row["ids"] for row in packing.sequences(packed).collect()}
    for row in packed.where("piece = 0").collect():
        assert joined[row["sequence_id"]][row["offset"] : row["offset"] + row["length"]] == row["ids"]
    packed.unpersist()


def test_each_piece_goes_where_the_sum_of_squares_is_smallest():
    rng = random.Random(5)
    sequences = packing.Sequences(20)
    for _ in range(300):
        size = rng.randint(1, 20)
        before = sequences.count.copy()

        def total(gap):
            after = before.copy()
            if gap < 20:
                after[gap] -= 1
            if gap > size:
                after[gap - size] += 1
            return int((after**2).sum())

        choices = [gap for gap in range(size, 20) if before[gap]] or [20]
        number, offset = sequences.place(size)
        assert total(20 - offset) == min(map(total, choices))
        assert [len(one) for one in sequences.open] == sequences.count.tolist()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", "'s", "'", " ", "  ", "\n", "\t", "1", "é", "中", "\u00a0", "\u2003", "<|endoftext|>", "<|end", "-", "...", "🙂", "\0", "ab" * 40]), max_size=30))
def test_ids_are_those_of_the_library(parts):
    text = "".join(parts)
    (found,) = packing.encode([text], packing.vocabulary_path())
    assert found.tolist() == ids_of(text)


def test_ids_of_every_character():
    every = [chr(one) for one in range(0x110000) if not 0xD800 <= one < 0xE000]
    texts = ["".join(f"a{one}b {one}{one} 1{one}'s  {one}\n" for one in every[low : low + 50]) for low in range(0, len(every), 50)]
    expected = library().encode_batch_fast(texts, add_special_tokens=False)
    for one, found in zip(expected, packing.encode(texts, packing.vocabulary_path())):
        assert found.tolist()[:-1] == one.ids


def test_very_long_texts():
    for text in ("z" * 1_000_000, " " * 1_000_000, "a" + "\n" * 500_000 + "b", "#-" * 500_000):
        (found,) = packing.encode([text], packing.vocabulary_path())
        assert found.tolist() == ids_of(text)


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        packing.coding(packing.vocabulary_path("word_bpe_49k.json"))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(docs, packing.vocabulary_path()).collect() == []
