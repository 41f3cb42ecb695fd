"""Quality classifier by positive-unlabelled learning with the non-negative risk estimator.

A linear scorer over text statistics is fitted to trusted positives (``quality`` 1) against unlabelled text, a sample of all learning
rows whose labels are not looked at. The risk is ``prior * E_p[l(f)] + max(0, E_u[l(-f)] - prior * E_p[l(-f)])`` with the sigmoid loss; where the second part
turns negative, the step goes up its gradient, as the non-negative estimator prescribes. The class prior is estimated from
the labelled learning rows, smoothed. A two-parameter scaling on the labelled learning rows turns the
scorer into probabilities.

The fit reads at most ``POSITIVES`` positives, as many negatives and ``UNLABELLED`` unlabelled rows (the first in order of a hash of the
id, one text per id); their statistics, of fixed length, are what the driver holds. Scoring is one pass over whole texts.

Defined results: null and empty texts are scored like any other, from statistics that are all zero; texts of any length are read whole;
without positives every score is the prior; labels of unknown rows are ignored, repeated labels count once each in the prior and a
row with both labels is in both samples; of an id with differing texts the one with the smallest hash is learned from;
equal scores are equal verdicts, there are no other ties; repeated rows are scored one by one; an empty table gives no rows; other columns are carried, but for ``score``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm import arrays, tables

POSITIVES = 6_000
UNLABELLED = 12_000
THRESHOLD = 0.3
_CLASSES = 16
_STATISTICS = 10
_STEPS = 1_500
_CHUNK = 500_000

#: Byte classes: upper case, lower case, digits, beyond ASCII, space, line end, and the marks one by one or in kinds.
_CLASS = np.full(256, 15, np.uint8)
for _number, _members in enumerate(
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", bytes(range(128, 256)), b" ", b"\n",
     b".,;:", b"!?", b"#", b"*", b"$", b"%&", b"|", b"<>{}[]()", b"\"'-")
):
    _CLASS[list(_members)] = _number


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float
    prior: float


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per row: shares of byte classes, of pairs of neighbouring classes, and word statistics."""
    rows = len(offsets) - 1
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(rows), sizes)
    kind = _CLASS[data].astype(np.int64)
    single = np.bincount(row * _CLASSES + kind, minlength=rows * _CLASSES).reshape(rows, _CLASSES)
    pair = kind[:-1] * _CLASSES + kind[1:] if len(kind) else kind
    inside = row[:-1] == row[1:] if len(row) else np.zeros(0, bool)
    pairs = np.bincount(
        row[:-1][inside] * _CLASSES**2 + pair[inside], minlength=rows * _CLASSES**2
    ).reshape(rows, _CLASSES**2) if len(row) else np.zeros((rows, _CLASSES**2))
    total = np.maximum(sizes, 1)[:, None]
    return np.hstack([np.sqrt(single / total), np.sqrt(pairs / total), _word_statistics(data, offsets)]).astype(np.float32)


def _word_statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    rows = len(offsets) - 1
    starts, ends, row = arrays.words_of(data, offsets, arrays.NOT_SPACE)
    out = np.zeros((rows, _STATISTICS))
    if not len(starts):
        return out
    count = np.bincount(row, minlength=rows)
    least = np.maximum(count, 1)
    lengths = (ends - starts).astype(np.float64)
    hashes = arrays.slice_hashes(arrays.LOWER[data], starts, ends)
    mean = np.bincount(row, lengths, rows) / least
    out[:, 0] = np.log1p(count)
    out[:, 1] = mean
    out[:, 2] = np.sqrt(np.maximum(np.bincount(row, lengths**2, rows) / least - mean**2, 0))
    order = np.lexsort((hashes, row))
    again = np.concatenate(([False], (hashes[order][1:] == hashes[order][:-1]) & (row[order][1:] == row[order][:-1])))
    out[:, 3] = np.bincount(row[order], again, rows) / least
    next_to = np.concatenate(([False], (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])))
    out[:, 4] = np.bincount(row, next_to, rows) / least
    upper = (data[starts] >= 65) & (data[starts] <= 90)
    out[:, 5] = np.bincount(row, upper, rows) / least
    last = data[ends - 1]
    out[:, 6] = np.bincount(row, ~((last | 32 >= 97) & (last | 32 <= 122) | (last >= 128)), rows) / least
    out[:, 7] = np.bincount(row, last == 46, rows) / least
    out[:, 8] = np.bincount(row, lengths == 1, rows) / least
    lines, line_ends, line_row = arrays.words_of(data, offsets, _NOT_LINE_END)
    line = arrays.slice_hashes(data, lines, line_ends)
    order = np.lexsort((line, line_row))
    again = np.concatenate(([False], (line[order][1:] == line[order][:-1]) & (line_row[order][1:] == line_row[order][:-1])))
    out[:, 9] = np.bincount(line_row[order], again, rows) / np.maximum(np.bincount(line_row, minlength=rows), 1)
    return out


_NOT_LINE_END = np.ones(256, bool)
_NOT_LINE_END[10] = False


def _sigmoid(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -40, 40)))


def risk(positive: np.ndarray, unlabelled: np.ndarray, weights: np.ndarray, prior: float) -> tuple[float, float]:
    """The two parts of the risk under sigmoid losses, l(f) = s(-f) and l(-f) = s(f): that of positives, and that of negatives.

    The second one is estimated from unlabelled rows less the positives among them, and may turn out negative.
    """
    p, u = _sigmoid(positive @ weights), _sigmoid(unlabelled @ weights)
    return float(prior * (1 - p).mean()), float(u.mean() - prior * p.mean())


def risk_gradient(positive: np.ndarray, unlabelled: np.ndarray, weights: np.ndarray, prior: float) -> np.ndarray:
    """Where to step down from: the gradient of both parts, or, where the second is negative, against that part alone."""
    p, u = _sigmoid(positive @ weights), _sigmoid(unlabelled @ weights)
    slope_p, slope_u = (p * (1 - p)) @ positive / len(p), (u * (1 - u)) @ unlabelled / len(u)
    if u.mean() - prior * p.mean() >= 0:
        return slope_u - 2 * prior * slope_p
    return prior * slope_p - slope_u


def fit_scorer(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk, by full gradients with adaptive steps."""
    size = positive.shape[1]
    weights, first, second = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    positive = np.hstack([positive, np.ones((len(positive), 1))])
    unlabelled = np.hstack([unlabelled, np.ones((len(unlabelled), 1))])
    for step in range(1, _STEPS + 1):
        gradient = risk_gradient(positive, unlabelled, weights, prior) + 1e-4 * np.append(weights[:-1], 0)
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        weights = weights - 0.03 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return weights[:-1], float(weights[-1])


def _scaling(scores: np.ndarray, quality: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic fit of the labels on the scores, with smoothed targets."""
    positives, negatives = (quality == 1).sum(), (quality == 0).sum()
    if not positives or not negatives:
        return 1.0, 0.0
    target = np.where(quality == 1, (positives + 1) / (positives + 2), 1 / (negatives + 2))
    spread = scores.std() or 1.0
    x = np.stack([scores / spread, np.ones(len(scores))], 1)
    beta = np.zeros(2)
    for _ in range(50):
        p = _sigmoid(x @ beta)
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        move = np.linalg.solve(curve, x.T @ (target - p))
        beta += np.clip(move, -2, 2)
    return float(max(beta[0], 1e-3) / spread), float(beta[1])


def train(documents: DataFrame, labels: DataFrame) -> Model:
    """Fit on ``documents(doc_id, text)`` with ``labels(doc_id, quality)``, both already limited to learning rows."""
    known = labels.where("quality is not null and doc_id is not null").select("doc_id", F.col("quality").cast("int").alias("quality"))
    seen = known.agg(F.count("*"), F.sum((F.col("quality") == 1).cast("long"))).first()
    prior = ((seen[1] or 0) + 1) / (seen[0] + 2)
    order = F.xxhash64(F.col("doc_id"), F.lit(10))

    def first(rows: DataFrame, limit: int) -> DataFrame:
        return rows.select("doc_id").distinct().orderBy(order, "doc_id").limit(limit)

    # Trusted negatives only scale the scores; they are in no term of the risk. The unlabelled sample is one of all rows: what is
    # known of their labels stays hidden, so that it has the distribution which the risk and the prior speak of.
    kinds = ((known.where("quality = 1"), POSITIVES, 1), (known.where("quality = 0"), POSITIVES, 0), (documents.where("doc_id is not null"), UNLABELLED, -1))
    samples = [first(rows, limit).withColumn("quality", F.lit(kind)) for rows, limit, kind in kinds]
    chosen = samples[0].unionByName(samples[1]).unionByName(samples[2])
    # Of an id with several texts one is read, so what is collected keeps to the limits.
    texts = documents.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi").groupBy("doc_id")
    texts = texts.agg(F.min_by("text", F.coalesce(F.xxhash64("text"), F.lit(0))).alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text").mapInArrow(
        _feature_rows, "doc_id bigint, quality int, features binary"
    )
    found = rows.collect()
    found.sort(key=lambda row: (row["doc_id"], row["quality"], row["features"]))
    quality = np.array([row["quality"] for row in found], int)
    width = _CLASSES + _CLASSES**2 + _STATISTICS
    matrix = np.array([np.frombuffer(row["features"], np.float32) for row in found], float).reshape(-1, width)
    mean, scale = np.zeros(width), np.ones(width)
    if not (quality == 1).any() or not (quality < 0).any():
        return Model(mean, scale, np.zeros(width), 0.0, 0.0, float(np.log(prior / (1 - prior))), prior)
    mean = matrix.mean(0)
    scale = np.maximum(matrix.std(0), 1e-3)
    matrix = np.clip((matrix - mean) / scale, -8, 8)
    weights, bias = fit_scorer(matrix[quality == 1], matrix[quality < 0], prior)
    sure = quality >= 0
    slope, shift = _scaling(matrix[sure] @ weights + bias, quality[sure])
    return Model(mean, scale, weights, bias, slope, shift, prior)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for _, _, data, offsets in arrays.text_chunks(batch.column(2), _CHUNK):
            found += [one.tobytes() for one in features(data, offsets)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], ["doc_id", "quality", "features"])


def score(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with ``score``; one pass, no shuffle."""
    documents = tables.without(documents, ("score",))
    schema = documents.select("*", F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0)]
            for _, _, data, offsets in arrays.text_chunks(batch.column(batch.schema.get_field_index("text")), _CHUNK):
                values = np.clip((features(data, offsets) - model.mean) / model.scale, -8, 8)
                found.append(_sigmoid(model.slope * (values @ model.weights + model.bias) + model.shift))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(found))], [*batch.schema.names, "score"])

    return documents.mapInArrow(run, schema)


def op10(spark: SparkSession, folder: str) -> DataFrame:
    """The quality score of every document; the fold 0 of 5 is held out."""
    documents = tables.read(spark, folder, "documents")
    labels = tables.read(spark, folder, "labels")
    learning = tables.fold("doc_id", 5) != 0
    model = train(documents.where(learning).select("doc_id", "text"), labels.where(learning))
    rows = documents.select("doc_id", F.coalesce(tables.fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "text")
    return score(rows, model).select(
        "doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
