from __future__ import annotations

import random

import numpy as np
import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillwork.llm import arrays, lexical_search


@pytest.fixture(scope="module")
def documents(prose):
    rng = random.Random(12)
    found = [(k, prose(k % 150, rng.randint(1, 200)) + f" rare{k % 30} x{k}") for k in range(300)]
    found += [(400 + k, "Same_text here: SAME text") for k in range(50)]
    found += [(500, None), (501, ""), (502, "... -- !"), (503, "É é 中文 naïve"), (None, "rare3 rare3"), (None, "same text"), (7, "rare3")]
    return found + [(504, "ban der " * 40_000), (505, "q" * 100_000 + " rare4"), found[3], found[3]]


@pytest.fixture(scope="module")
def items(prose):
    found = [(k, prose(k, 30) + f" rare{k} rare{k}") for k in range(25)] + [(30, "SAME"), (31, None), (32, ""), (33, "not there")]
    found += [(34, "é naïve"), (35, "q" * 100_000), (36, "rare3 " * 50), (None, "rare4"), (0, prose(3, 12)), (30, "SAME")]
    return found + [(37, "ban " + prose(9, 400))]


def frames(spark, documents, items):
    docs = spark.createDataFrame(documents, "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("item", F.lit(1))
    return docs.repartition(3), spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit("clash"))


@pytest.mark.parametrize(("block", "coordinates", "batch"), [(10**6, 1024, 10**6), (2_000, 16, 3_000)])
def test_ranks_as_by_brute_force(spark, documents, items, monkeypatch, block, coordinates, batch):
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", block)
    monkeypatch.setattr(lexical_search, "COORDINATES", coordinates)
    monkeypatch.setattr(lexical_search, "BATCH_BYTES", batch)
    found = lexical_search.search(*frames(spark, documents, items))
    assert found.schema.simpleString() == "struct<item_id:bigint,rank:int,doc_id:bigint,score:bigint>"
    expected = plain.best_documents(documents, items)
    assert sorted(map(str, (tuple(row) for row in found.collect()))) == sorted(map(str, expected))
    assert {row[1] for row in expected} == set(range(1, 21))


def test_text_ids_of_items(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a c")], "doc_id int, text string")
    found = lexical_search.search(docs, spark.createDataFrame([("x", "a b")], "item_id string, text string")).collect()
    assert [(row["item_id"], row["rank"], row["doc_id"]) for row in found] == [("x", 1, 1), ("x", 2, 2)]


@pytest.mark.parametrize(("docs", "items"), [([], []), ([(1, "a")], []), ([], [(1, "a")]), ([(1, None)], [(1, "a")])])
def test_empty_tables(spark, docs, items):
    assert lexical_search.search(*frames(spark, docs, items)).collect() == []


def test_bounds_spare_most_exact_scores(prose):
    """Bounds never lie below a score, and few documents are scored exactly once the best are known."""
    block = lexical_search.Block([(0, prose(1, 20) + " needle thread")])
    texts = [prose(10 + k, 60) + (" needle thread" if k % 40 == 0 else "") for k in range(2_000)]
    holding = np.zeros(block.size, np.int64)
    for *_, terms, _ in block.occurrences(pa.array(texts)):
        holding += np.bincount(terms, minlength=block.size)
    scorer = lexical_search.Scorer(block, 2_000, 2_000 * 60, lexical_search.weights(2_000, holding))
    for low in range(0, 2_000, 100):
        scorer.take(pa.array(texts[low : low + 100]), list(range(low, low + 100)))
    assert [one[2] % 40 for one in scorer.best[0]] == [0] * 20
    assert scorer.n_scored < 1_000


def test_terms_with_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(arrays, "word_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64))
    block = lexical_search.Block([(0, "ab cd ef abcdefghij abcdefghik")])
    (_, _, sizes, _, terms, counts), *_ = block.occurrences(pa.array(["cd xx ef cd abcdefghik abcdefghil"]))
    assert sizes.tolist() == [6] and dict(zip(terms.tolist(), counts.tolist())) == {1: 2, 2: 1, 4: 1}


def test_word_hashes_know_no_family_of_collisions():
    """Words of two letters by the parity of the bits of their places: sums of powers modulo 2^64 take them for equal."""
    letters = np.array([bin(k).count("1") % 2 for k in range(4_096)], np.uint8) + 97
    for size in (1_024, 2_048, 4_096):
        data = np.concatenate([letters[:size], 195 - letters[:size], letters[:size]])
        starts = np.arange(3) * size
        found = arrays.word_hashes(data, starts, starts + size)
        assert found[0] == found[2] != found[1]
    words = [b"", b"\0", b"\0\0", b"a", b"a\0", b"\0a", b"abcdefgh", b"abcdefgh\0", b"abcdefgha", b"bcdefgha", b"abcdefghabcdefgh"]
    sizes = np.array([len(one) for one in words])
    ends = np.cumsum(sizes)
    assert len(set(arrays.word_hashes(np.frombuffer(b"".join(words), np.uint8), ends - sizes, ends).tolist())) == len(words)
