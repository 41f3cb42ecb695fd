"""Held-out accuracy of the trained operators, and their models' shapes."""

from __future__ import annotations

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwork.llm import language_id, quality_classifier, tables

FOLDER = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


@needs_data
def test_languages_of_held_out_documents(spark):
    truth = tables.read(spark, FOLDER, "documents").select("doc_id", "lang")
    rows = language_id.op6(spark, FOLDER).join(truth, "doc_id").where("held_out").collect()
    assert len(rows) > 100
    assert np.mean([row["lang"] == row["lang_pred"] for row in rows]) > 0.98
    assert all(0 <= row["score"] <= 1 for row in rows)


@needs_data
def test_quality_of_held_out_documents(spark):
    truth = tables.read(spark, FOLDER, "labels").select("doc_id", "quality")
    rows = quality_classifier.op10(spark, FOLDER).join(truth, "doc_id").where("held_out").collect()
    good = [row["predicted"] for row in rows if row["quality"] == 1]
    bad = [row["predicted"] for row in rows if row["quality"] == 0]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.2
    assert all(0 <= row["score"] <= 1 for row in rows)


@pytest.mark.parametrize("count", [1, 2, 3, 4, 7, 20])
def test_codewords_differ(count):
    codes = language_id.codewords(count)
    assert len({tuple(code) for code in codes.tolist()}) == count
    if count > 1:
        assert (np.abs(codes.sum(0)) < count).all()  # every bit separates some languages


def _plain_language(model, text):
    """Bit by bit and language by language, trigram by trigram."""
    raw = "".join(one.lower() if "A" <= one <= "Z" else one for one in text).encode()
    grams = [int.from_bytes(raw[k : k + 3], "little") * 0x9E3779B1 % 2**32 >> 32 - language_id.BUCKET_BITS for k in range(len(raw) - 2)]
    bits = [float(weights[grams].astype(float).sum()) / max(len(grams), 1) * min(len(grams), language_id._EVIDENCE) + bias for weights, bias in zip(model.weights, model.bias)]
    losses = [sum(trust * math.log1p(math.exp(-code * bit)) for code, bit, trust in zip(codes, bits, model.trust)) for codes in model.codes.tolist()]
    odds = [math.exp(min(losses) - one) for one in losses]
    ordered = sorted(odds, reverse=True)
    return model.languages[odds.index(max(odds))], max(odds) / sum(odds), (ordered[0] - ordered[1]) / sum(odds)


@pytest.mark.parametrize("count", [2, 3, 6])
def test_decoding_as_by_brute_force(spark, prose, count):
    """Random classifiers, so that texts come near to several codewords."""
    rng = np.random.default_rng(count)
    codes = language_id.codewords(count)
    size = codes.shape[1]
    model = language_id.Model(
        [f"l{k}" for k in range(count)], codes, rng.normal(0, 0.5, (size, 1 << language_id.BUCKET_BITS)).astype(np.float32), rng.normal(0, 1, size), rng.dirichlet(np.ones(size))
    )
    texts = [prose(k, 1 + k % 40) for k in range(60)] + ["É é", "x", "ab", "ABC abc", "word " * 3_000, "中文 a"]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {row["doc_id"]: row for row in language_id.predict(documents, model).collect()}
    for k, text in enumerate(texts):
        name, score, lead = _plain_language(model, text)
        assert found[k]["lang_pred"] == name and abs(found[k]["score"] - score) < 1e-6
        if abs(lead - language_id.AMBIGUOUS_MARGIN) > 1e-6:
            assert found[k]["ambiguous"] == (lead < language_id.AMBIGUOUS_MARGIN)
    assert len({row["lang_pred"] for row in found.values()}) > 1


def test_equally_near_codewords_go_to_the_first_name(spark):
    model = language_id.Model(["aa", "bb"], language_id.codewords(2), np.zeros((1, 1 << language_id.BUCKET_BITS), np.float32), np.zeros(1), np.ones(1))
    row = language_id.predict(spark.createDataFrame([(1, "some text")], "doc_id long, text string"), model).first()
    assert (row["lang_pred"], row["score"], row["ambiguous"]) == ("aa", 0.5, True)


def test_languages_without_letters_and_without_training(spark):
    documents = spark.createDataFrame(
        [(1, "ab cd", "xx"), (2, "12 34 !!", "xx"), (3, "", "xx"), (4, None, "xx"), (5, "é", "xx"), (6, "中", None)], "doc_id long, text string, lang string"
    )
    model = language_id.train(documents)
    found = {row["doc_id"]: (row["lang_pred"], row["score"] > 0) for row in language_id.predict(documents, model).collect()}
    assert found == {1: ("xx", True), 2: ("und", False), 3: ("und", False), 4: ("und", False), 5: ("xx", True), 6: ("xx", True)}
    none = language_id.train(documents.limit(0))
    assert {row["lang_pred"] for row in language_id.predict(documents, none).collect()} == {"und"}


def test_quality_without_labels_is_the_prior(spark):
    documents = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = quality_classifier.train(documents, spark.createDataFrame([], "doc_id long, quality int"))
    assert [row["score"] for row in quality_classifier.score(documents, model).collect()] == pytest.approx([0.5, 0.5])


def test_scorer_separates_positives_hidden_in_unlabelled():
    rng = np.random.default_rng(0)
    positive = rng.normal(1, 1, (400, 4))
    unlabelled = np.vstack([rng.normal(1, 1, (600, 4)), rng.normal(-2, 1, (400, 4))])
    weights, bias = quality_classifier.fit_scorer(positive, unlabelled, 0.6)
    predicted = unlabelled @ weights + bias > 0
    assert predicted[:600].mean() > 0.9 and predicted[600:].mean() < 0.1


def test_risk_and_gradient_as_by_plain_sums_and_differences():
    rng = np.random.default_rng(3)
    positive, unlabelled = rng.normal(0.5, 1, (30, 5)), rng.normal(0, 1, (50, 5))
    signs = set()
    for prior in (0.2, 0.6, 0.95):
        for _ in range(8):
            weights = rng.normal(0, 2, 5)

            def part(k):
                def loss(rows, sign):
                    return sum(1 / (1 + np.exp(sign * float(row @ weights))) for row in rows) / len(rows)

                return prior * loss(positive, 1) if k == 0 else loss(unlabelled, -1) - prior * loss(positive, -1)

            parts = quality_classifier.risk(positive, unlabelled, weights, prior)
            assert np.allclose(parts, (part(0), part(1)))
            signs.add(parts[1] >= 0)

            def target(at):
                both = quality_classifier.risk(positive, unlabelled, at, prior)
                return sum(both) if parts[1] >= 0 else -both[1]

            steps = 1e-5 * np.eye(5)
            slopes = [(target(weights + one) - target(weights - one)) / 2e-5 for one in steps]
            assert np.allclose(quality_classifier.risk_gradient(positive, unlabelled, weights, prior), slopes, atol=1e-7)
    assert signs == {True, False}


def test_a_table_in_which_every_row_is_labelled(spark, prose):
    """Labels of the unlabelled sample are not looked at, so there is one; scores differ and are in the right order."""
    rows = [(k, prose(k, 80).capitalize() + ".", 1) for k in range(120)] + [(200 + k, "$$ ## " * 30 + prose(k, 5), 0) for k in range(60)]
    documents = spark.createDataFrame([row[:2] for row in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(row[0], row[2]) for row in rows], "doc_id long, quality int")
    scores = {row["doc_id"]: row["score"] for row in quality_classifier.score(documents, quality_classifier.train(documents, labels)).collect()}
    assert min(scores[k] for k in range(120)) > max(scores[200 + k] for k in range(60))
    assert max(scores[200 + k] for k in range(60)) < 0.3 < min(scores[k] for k in range(120))


def test_repeated_ids_do_not_multiply_what_is_collected(spark, prose, monkeypatch):
    monkeypatch.setattr(quality_classifier, "POSITIVES", 40)
    monkeypatch.setattr(quality_classifier, "UNLABELLED", 50)
    seen, matrices = quality_classifier.fit_scorer, []

    def noting(positive, unlabelled, prior):
        matrices.append((len(positive), len(unlabelled)))
        return seen(positive, unlabelled, prior)

    monkeypatch.setattr(quality_classifier, "fit_scorer", noting)
    rows = [(1, prose(k % 7, 30)) for k in range(2_000)] + [(k, prose(k, 40)) for k in range(2, 300)]
    labels = [(1, 1)] * 500 + [(1, 0)] * 3 + [(k, k % 2) for k in range(2, 300)]
    quality_classifier.train(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int"))
    assert matrices == [(40, 50)]


def test_features_do_not_depend_on_neighbours():
    texts = [b"Hello world. ", b"", b"A A A A | # 12\n\nx", "é ü".encode()]
    offsets = np.cumsum([0, *map(len, texts)])
    together = quality_classifier.features(np.frombuffer(b"".join(texts), np.uint8), offsets)
    for k, text in enumerate(texts):
        alone = quality_classifier.features(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        assert np.allclose(together[k], alone[0])


def test_folds_are_those_of_the_text_of_the_id(spark):
    import zlib

    rows = spark.range(100).select("id", tables.fold("id", 4).alias("fold")).where(F.col("id") >= 0).collect()
    assert all(row["fold"] == zlib.crc32(str(row["id"]).encode()) % 4 for row in rows)
