from __future__ import annotations

import random

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from tillwork.llm import filter_audit, tables

COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


@pytest.fixture(scope="module")
def documents(prose):
    rng = random.Random(11)
    found = []
    for k in range(160):
        text = prose(k % 40, rng.choice([40, 99, 100, 130]))
        text = text.upper() if rng.random() < 0.3 else text
        text += rng.choice(["", "", " 5% off", " a|b"])
        found.append((k + 1, text, rng.choice(["en", "de", "fr", None, ""])))
    words = [f"w{k}" for k in range(120)]
    found += [(200 + k, " ".join(words[: 80 + k]) + " w1" * (20 - k), "en") for k in range(12)]
    found += [(300, "A" + "b" * 9, "en"), (301, "A" + "b" * 8, "en"), (302, None, None), (303, "", "en"), (304, "É" * 50, "en")]
    found += [(None, found[0][1], "en"), (None, None, None), (5, found[9][1], "de"), (5, found[4][1], "en"), found[7], found[7]]
    return found + [(400, "xy " * 30_000, "en"), (401, "z" * 200_000, "de")]


@pytest.fixture(scope="module")
def labels():
    return [(k, k % 2, k % 3 % 2) for k in range(1, 90)] + [(1, 0, 1), (2, None, None), (None, 1, 1), (10**9, 1, 1), (5, 1, 1)]


def frames(spark, documents, labels):
    docs = spark.createDataFrame(documents, "doc_id long, text string, lang string").withColumn("failures", F.lit("clash"))
    return docs.withColumn("part", F.lit(1)).repartition(5), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("share", [1_000, 8, 1])
def test_audit_as_by_brute_force(spark, documents, labels, monkeypatch, share):
    """Also with most keys joined as frequent ones."""
    monkeypatch.setattr(tables, "SHARE", share)
    docs, known = frames(spark, documents, labels)
    found = filter_audit.audit(filter_audit.survivors(filter_audit.mark(docs, known))).collect()
    expected = plain.filter_audit(documents, labels)
    assert len(found) == len(expected) == 600 * 4
    assert {(row["part"], row["filter_order"], row["step"]): tuple(row[name] for name in COLUMNS) for row in found} == expected


def test_many_parts_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "PARTS", 3)
    rows = [(k, "a b", f"p{k % 20}") for k in range(400)]
    docs, known = frames(spark, rows, [(1, 1, 1)])
    found = filter_audit.survivors(filter_audit.mark(docs, known)).where("subset = 0 and label = 0").collect()
    assert {row["part"]: row["n"] for row in found} == {f"p{k}": 20 for k in range(20)}


@pytest.mark.parametrize("size", [0, 1, 2, 3, 7, 1_000])
def test_bit_counts(size):
    words = np.random.default_rng(size).integers(0, 2**32, size, np.uint64).astype(np.uint32)
    assert filter_audit.bit_counts(words).tolist() == [int((words >> np.uint32(k) & 1).sum()) for k in range(32)]


def test_empty_table(spark):
    docs, known = frames(spark, [], [])
    assert filter_audit.audit(filter_audit.survivors(filter_audit.mark(docs, known))).collect() == []
