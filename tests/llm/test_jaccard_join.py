from __future__ import annotations

import random

import numpy as np
import plain
import pytest

from tillwork.llm import components, jaccard_join, tables


def result(df):
    return {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in df.collect()}


def varied(prose, groups, members, edits):
    """Groups of near copies whose members differ from their base, and from each other, by random edits."""
    rng = random.Random(11)
    found = []
    for group in range(groups):
        base = prose(1000 + group, 150).split()
        for _ in range(members):
            words = list(base)
            for _ in range(rng.randint(0, edits)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
            found.append(" ".join(words))
    rng.shuffle(found)
    return list(enumerate(found))


def test_components_as_by_brute_force(spark, corpus):
    documents = spark.createDataFrame(corpus, "doc_id long, text string").repartition(4)
    assert result(jaccard_join.join(spark, documents)) == plain.near_groups(corpus)


def test_long_words_of_two_letters_are_told_apart(spark):
    """Sums of powers modulo 2^64 take such words for equal, whatever the odd base."""
    letters = "".join("ab"[bin(k).count("1") % 2] for k in range(4_096))
    swapped = letters.translate(str.maketrans("ab", "ba"))
    documents = [(1, letters[:2_048]), (2, swapped[:2_048]), (3, letters), (4, swapped), (5, letters[:2_048].upper()), (6, swapped + " x")]
    found = result(jaccard_join.join(spark, spark.createDataFrame(documents, "doc_id long, text string")))
    assert found == plain.near_groups(documents)
    assert {key: one for key, (_, one) in found.items()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1, 6: 6}


def test_an_id_with_differing_texts_links_with_whatever_they_link_with(spark, prose):
    """Ids 5 and 9: the smallest id of a class is that of two classes; 20 has words and none; 30 has none at all."""
    documents = [(5, prose(1, 40)), (5, prose(2, 40)), (9, prose(2, 40) + " x"), (7, prose(1, 40) + " y"), (12, prose(3, 40)), (9, prose(3, 40))]
    documents += [(20, ""), (20, prose(4, 40)), (18, prose(4, 40) + " z"), (30, None), (30, " "), (40, prose(5, 40)), (41, prose(5, 40)), (5, prose(1, 40))]
    documents += [(60 + k % 3, prose(100 + k % 7, 30)) for k in range(20)] + [(2, prose(6, 40))]
    found = jaccard_join.join(spark, spark.createDataFrame(documents, "doc_id long, text string").repartition(3)).collect()
    expected = plain.near_components(documents)
    assert len(found) == len(documents)
    assert {(row["doc_id"], row["component_id"]) for row in found} == set(expected.items())
    assert expected[7] == expected[9] == expected[12] == 5 and expected[20] == 18 and expected[30] == 30
    sizes = sorted((row["doc_id"], row["n_shingles"]) for row in found)
    assert sizes == sorted((doc_id, len(plain.shingles(text))) for doc_id, text in documents)


def test_members_with_a_partner_as_by_all_pairs():
    rng = np.random.default_rng(4)
    for _ in range(200):
        count = rng.integers(1, 30)
        token = np.sort(rng.integers(0, 4, count).astype(np.uint64))
        size = rng.integers(1, 40, count)
        order = np.lexsort((size, token))
        token, size = token[order], size[order].astype(np.int64)
        left = size - rng.integers(0, np.maximum(size // 4, 1))
        found = jaccard_join._partnered(token, size, left)
        for a in range(count):
            pairs = [
                b for b in range(count)
                if a != b and token[a] == token[b] and 180 * min(left[a], left[b]) >= 80 * (size[a] + size[b])
            ]
            assert found[a] == bool(pairs)


@pytest.mark.parametrize("listed", [65_536, 0])
def test_a_shared_passage_brings_nobody_together(spark, prose, monkeypatch, listed):
    """A passage of 85 % of each document: where its shingles are listed as frequent, no text travels; the result is the same without."""
    monkeypatch.setattr(jaccard_join, "FREQUENT", max(listed, 1))
    written, cut = {}, tables.cut

    def noting(session, df, label):
        found = cut(session, df, label)
        written[label] = found.count()
        return found

    monkeypatch.setattr(tables, "cut", noting)
    passage = prose(1, 60)
    count = 3_000 if listed else 300
    documents = [(k, f"{passage} " + " ".join(f"u{k}x{j}" for j in range(10))) for k in range(count)]
    documents += [(5_000 + k, prose(50, 60) + f" tail{k}") for k in range(20)]
    found = result(jaccard_join.join(spark, spark.createDataFrame(documents, "doc_id long, text string")))
    assert all(found[k][1] == k for k in range(count)) and all(found[5_000 + k][1] == 5_000 for k in range(20))
    if listed:
        assert written["meetings"] == 19 and written["near"] == 20


@pytest.mark.parametrize(("shard", "tree"), [(1_000, 10_000), (4, 10_000), (4, 10)])
def test_large_groups_are_cut_without_losing_links(spark, prose, monkeypatch, shard, tree):
    monkeypatch.setattr(jaccard_join, "SHARD", shard)
    monkeypatch.setattr(jaccard_join, "TREE", tree)
    documents = varied(prose, 3, 25, 6)
    expected = plain.near_groups(documents)
    assert len(set(expected.values())) > 3  # some members are too far from all others
    assert result(jaccard_join.join(spark, spark.createDataFrame(documents, "doc_id long, text string"))) == expected


def test_bound_never_loses_a_link(prose):
    rng = random.Random(2)
    base = prose(9, 400).split()
    texts = []
    for _ in range(60):
        words = list(base[: rng.randint(200, 400)])
        for _ in range(rng.randint(0, 30)):
            words[rng.randrange(len(words))] = f"v{rng.random()}"
        texts.append(" ".join(words))
    import pyarrow as pa

    sets = list(jaccard_join.shingle_sets(pa.array(texts)))
    forest = jaccard_join.CountForest([jaccard_join.count_vector(one) for one in sets], [len(one) for one in sets])
    some = 0
    for k, one in enumerate(sets):
        near = set(forest.near(forest.vectors[k], len(one)).tolist())
        for j, other in enumerate(sets):
            exact = 100 * len(np.intersect1d(one, other)) >= 80 * len(np.union1d(one, other))
            assert exact == jaccard_join.linked(one, other)
            some += exact and j != k
            if exact:
                assert j in near
    assert some


def test_components_of_chains_stars_and_cycles(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    random.Random(1).shuffle(links)
    found = components.connected(spark, spark.createDataFrame(links, "a long, b long"))
    expected = {k: 0 for k in range(41)} | {k: 100 for k in range(100, 130)} | {k: 200 for k in (200, 201, 202)}
    rows = [tuple(row) for row in found.collect()]
    assert dict(rows) == expected and len(rows) == len(expected)
    assert components.connected(spark, spark.createDataFrame([], "a long, b long")).count() == 0
