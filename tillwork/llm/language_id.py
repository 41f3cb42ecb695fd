"""Language identification by error-correcting output codes.

Each language gets a binary codeword. For every code bit a binary classifier over hashed byte trigrams (A-Z
lower-cased) separates the languages with a 1 from those with a 0: its weights are smoothed log-odds of counts.
A text's bit values are mean weights over all of its trigrams. Decoding adds, per language, the logistic loss of
each bit weighted by how reliable that bit was on the training rows, and takes the smallest total. The score is the
decoded probability; texts whose two best codewords are close are flagged as ambiguous.

Training reads about ``PER_LANGUAGE`` labelled texts of each language, chosen by a hash of the id. Prediction reads whole texts. The model's size depends on the languages only and travels in the tasks.

Defined results: null, empty and letterless texts are ``und`` with score 0; without any training row so is every
text; texts too short for a trigram are decoded from the language frequencies; texts of any length are read whole; of equally near codewords the
first language by name is taken, and the text is ambiguous; repeated rows are judged one by
one; an empty table gives no rows; other columns are carried, but for those
that bear the name of an added one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm import arrays, tables

PER_LANGUAGE = 4_000
BUCKET_BITS = 14
UNDETERMINED = "und"
AMBIGUOUS_MARGIN = 0.05
ADDED = ("lang_pred", "score", "ambiguous")
_SMOOTHING = 0.5
_EVIDENCE = 60  # trigrams that count as independent evidence
_CHUNK = 500_000


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray  # languages x bits, -1 or 1
    weights: np.ndarray  # bits x buckets
    bias: np.ndarray  # bits
    trust: np.ndarray  # bits


def codewords(count: int) -> np.ndarray:
    """One row of -1 and 1 per class: all splits for few classes, else the best of many random codes."""
    if count < 2:
        return np.ones((count, 1), np.int8)
    if count <= 4:
        bits = np.arange(1, 2 ** (count - 1))
        return np.array([[1 if row == 0 or not split >> (row - 1) & 1 else -1 for split in bits] for row in range(count)], np.int8)
    size = 15 * int(np.ceil(np.log2(count)))
    best, distance = None, -1
    for seed in range(200):
        code = np.random.default_rng(seed).choice(np.array([-1, 1], np.int8), (count, size))
        apart = (size - code.astype(int) @ code.T.astype(int)) // 2
        np.fill_diagonal(apart, size)
        usable = (np.abs(code.sum(0)) < count).all()
        if usable and apart.min() > distance:
            best, distance = code, apart.min()
    return best


def buckets(data: np.ndarray) -> np.ndarray:
    """The bucket of the trigram that starts at each place."""
    low = arrays.LOWER[data].astype(np.uint32)
    gram = low[:-2] | low[1:-1] << np.uint32(8) | low[2:] << np.uint32(16)
    return (gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)


def _row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums over the trigrams that lie within each row."""
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    first = np.minimum(offsets[:-1], len(values))
    return total[np.clip(offsets[1:] - 2, first, len(values))] - total[first]


def bit_values(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """rows x bits: the summed evidence of up to ``_EVIDENCE`` trigrams."""
    grams = np.maximum(np.diff(offsets) - 2, 0)
    values = np.zeros((len(grams), len(model.bias)))
    if len(data) > 2:
        places = buckets(data)
        for bit, weights in enumerate(model.weights):
            values[:, bit] = _row_sums(weights[places], offsets)
    return values / np.maximum(grams, 1)[:, None] * np.minimum(grams, _EVIDENCE)[:, None] + model.bias


def decode(model: Model, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row the nearest codeword's number, its probability and its lead over the next."""
    margins = values[:, None, :] * model.codes[None, :, :]
    losses = (np.logaddexp(0, -margins) * model.trust).sum(2)
    odds = np.exp(losses.min(1, keepdims=True) - losses)
    odds /= odds.sum(1, keepdims=True)
    best = odds.argmax(1)
    ordered = np.sort(odds, axis=1)
    lead = ordered[:, -1] - (ordered[:, -2] if odds.shape[1] > 1 else 0)
    return best, odds.max(1), lead


def _training_rows(labelled: DataFrame, per_language: int) -> DataFrame:
    """All rows of small languages; of a large one those whose id hashes into the share that leaves ``per_language``."""
    usable = labelled.where("lang is not null and text is not null")
    counts = usable.groupBy("lang").agg(F.count("*").alias("rows"))
    # One row per language.
    shares = F.broadcast(counts.select("lang", F.least(F.lit(1.0), F.lit(float(per_language)) / F.col("rows")).alias("share")))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    return usable.join(shares, "lang").where(place < F.col("share")).select("lang", "text")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(language, bucket, count); bucket -1 counts the documents."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        languages = np.array(batch.column(0).to_pylist(), object)
        for first, end, data, offsets in arrays.text_chunks(batch.column(1), _CHUNK):
            places = buckets(data) if len(data) > 2 else np.zeros(0, np.uint32)
            for k, language in enumerate(languages[first:end]):
                total = totals.setdefault(language, np.zeros((1 << BUCKET_BITS) + 1, np.int64))
                total[:-1] += np.bincount(places[offsets[k] : max(offsets[k + 1] - 2, offsets[k])], minlength=1 << BUCKET_BITS)
                total[-1] += 1
    for language, total in totals.items():
        places = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([language] * len(places)), pa.array(np.where(places == 1 << BUCKET_BITS, -1, places)), pa.array(total[places])],
            ["lang", "bucket", "count"],
        )


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Fit on ``labelled(doc_id, text, lang)``. The driver gets one count per language and bucket."""
    rows = _training_rows(labelled, per_language)
    found = (
        rows.mapInArrow(_counts, "lang string, bucket bigint, count bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("count").alias("count"))
        .toPandas()
    )
    languages = sorted(found["lang"].unique())
    counts, documents = np.zeros((len(languages), 1 << BUCKET_BITS)), np.zeros(len(languages))
    for language, bucket, count in found.itertuples(index=False):
        if bucket < 0:
            documents[languages.index(language)] = count
        else:
            counts[languages.index(language), bucket] = count
    codes = codewords(len(languages))
    weights, bias = np.zeros((codes.shape[1], 1 << BUCKET_BITS)), np.zeros(codes.shape[1])
    for bit in range(codes.shape[1]) if len(languages) > 1 else ():
        odds = []
        for side in (1, -1):
            chosen = counts[codes[:, bit] == side].sum(0) + _SMOOTHING
            odds.append((np.log(chosen / chosen.sum()), np.log(documents[codes[:, bit] == side].sum())))
        weights[bit], bias[bit] = odds[0][0] - odds[1][0], odds[0][1] - odds[1][1]
    model = Model(languages, codes, weights.astype(np.float32), bias, np.ones(codes.shape[1]))
    if len(languages) > 1:
        wrong = rows.mapInArrow(_errors(model), "bit int, rows bigint, wrong bigint").groupBy("bit").agg(F.sum("rows").alias("n"), F.sum("wrong").alias("wrong"))
        for row in wrong.collect():
            rate = (row["wrong"] + 1) / (row["n"] + 2)
            model.trust[row["bit"]] = max(0.5 * np.log((1 - rate) / rate), 0.05)
        model.trust /= model.trust.sum()
    return model


def _errors(model: Model):
    """Per bit, how many training rows fall on the wrong side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {language: k for k, language in enumerate(model.languages)}
        rows, wrong = 0, np.zeros(len(model.bias), np.int64)
        for batch in batches:
            languages = np.array([number[one] for one in batch.column(0).to_pylist()], np.int64)
            for first, end, data, offsets in arrays.text_chunks(batch.column(1), _CHUNK):
                wrong += (bit_values(model, data, offsets) * model.codes[languages[first:end]] <= 0).sum(0)
            rows += len(languages)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(wrong)), pa.int32()), pa.array(np.full(len(wrong), rows, np.int64)), pa.array(wrong)],
            ["bit", "rows", "wrong"],
        )

    return run


def _has_letter(texts: pa.Array, data: np.ndarray, offsets: np.ndarray, first: int) -> np.ndarray:
    latin = np.concatenate(([0], np.cumsum(((data | 32) >= 97) & ((data | 32) <= 122))))
    found = latin[offsets[1:]] > latin[offsets[:-1]]
    for k in np.flatnonzero(~found & (np.diff(offsets) > 0)).tolist():
        found[k] = any(one.isalpha() for one in texts[first + k].as_py())
    return found


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with ``lang_pred``, ``score`` and ``ambiguous``; one pass, no shuffle."""
    documents = tables.without(documents, ADDED)
    schema = documents.select(
        "*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("ambiguous")
    ).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            names, scores, unclear = [], [], []
            for first, end, data, offsets in arrays.text_chunks(texts, _CHUNK):
                lettered = _has_letter(texts, data, offsets, first) & bool(model.languages)
                if model.languages:
                    best, score, lead = decode(model, bit_values(model, data, offsets))
                else:
                    best, score, lead = np.zeros((3, end - first))
                names += [model.languages[int(k)] if sure else UNDETERMINED for k, sure in zip(best, lettered)]
                scores.append(np.where(lettered, score, 0.0))
                unclear.append(lettered & (lead < AMBIGUOUS_MARGIN))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(names, pa.string()),
                    pa.array(np.concatenate(scores) if scores else [], pa.float64()),
                    pa.array(np.concatenate(unclear) if unclear else [], pa.bool_()),
                ],
                [*batch.schema.names, "lang_pred", "score", "ambiguous"],
            )

    return documents.mapInArrow(run, schema)


def learning_rows(documents: DataFrame) -> DataFrame:
    """The rows that may be learnt from: the fold 2 of 4 is held out."""
    return documents.where(tables.fold("doc_id", 4) != 2).select("doc_id", "text", "lang")


def op6(spark: SparkSession, folder: str) -> DataFrame:
    """The predicted language of every document."""
    documents = tables.read(spark, folder, "documents")
    model = train(learning_rows(documents))
    rows = documents.select("doc_id", F.coalesce(tables.fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "text")
    return predict(rows, model).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")
