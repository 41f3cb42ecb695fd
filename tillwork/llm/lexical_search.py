"""Ranked lexical search: every document against every benchmark item, with hashed max-sketches.

Terms are runs of ASCII letters, digits and characters beyond ASCII, only A-Z lower-cased. The score of a document sums
``weight * saturation`` over the terms of the item, in integers; see ``impacts``.

1. One pass counts documents, terms and, for the terms of the items only, the documents that hold each.
2. In a second pass every document folds the impacts of its terms into a sketch: a term is hashed to one of ``COORDINATES``, and
   a coordinate keeps the largest impact that falls on it. A sketch looked up at an item's coordinates is an
   upper bound of the score; the bounds of a batch of documents for all items are one matrix product.
3. Per item, the documents of a batch are scored exactly in descending order of their bounds until a bound falls below the
   lowest of the best ``TOP`` so far. Words are found by hash and verified on their bytes, so collisions change nothing.

Each task hands on its best ``TOP`` per item; these are ranked in two steps, first within parts of an item. There is no shuffle of texts
or terms. Items are taken in blocks of bounded bytes and number; each block is broadcast and has its own two passes over the documents.

Defined results: a null or empty text has no term, is not counted and never found, and such an item finds nothing; rows that repeat an
id are documents each; documents without an id are counted, and ranked after all others of their score; equal rows of the benchmark are one
item, differing texts of one item id are items each; ties go to the smaller id; texts of any length are read whole;
empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, IntegerType, LongType, StructType

from tillwork.llm import arrays, tables

TOP = 20
COORDINATES = 1_024
BLOCK_BYTES = 1_000_000
BLOCK_ITEMS = 2_000
#: Documents of about so many bytes get their bounds at once.
BATCH_BYTES = 2_000_000
#: Parts of an item's rows that are ranked on their own first.
PARTS = 32
_STEP = 16  # documents scored between two looks at the threshold
_BITS = 20
_SLACK = 1 + 1e-9  # bounds are sums of doubles


class Terms:
    """The distinct terms of a block, found in texts by hash and verified on their bytes."""

    def __init__(self, terms: list[bytes]):
        self.data = np.frombuffer(b"".join(terms), np.uint8)
        sizes = np.array([len(one) for one in terms], np.int64)
        ends = np.cumsum(sizes)
        hashes = arrays.word_hashes(self.data, ends - sizes, ends)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes, self.starts, self.ends = hashes[self.order], (ends - sizes)[self.order], ends[self.order]
        self.likely = np.zeros(1 << _BITS, bool)
        self.likely[hashes >> np.uint64(64 - _BITS)] = True
        repeats = np.unique(hashes, return_counts=True)[1]
        self.alike = int(repeats.max()) if len(repeats) else 0

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words are terms, and the numbers of these terms."""
        hashes = arrays.word_hashes(data, starts, ends)
        words = np.flatnonzero(self.likely[hashes >> np.uint64(64 - _BITS)])
        nearest = np.searchsorted(self.hashes, hashes[words])
        terms = np.full(len(words), -1, np.int64)
        for k in range(self.alike):
            near = np.minimum(nearest + k, len(self.hashes) - 1)
            open_ = np.flatnonzero((self.hashes[near] == hashes[words]) & (terms < 0))
            at, known = words[open_], near[open_]
            sure = arrays.same_bytes(data, starts[at], ends[at], self.data, self.starts[known], self.ends[known])
            terms[open_[sure]] = self.order[known[sure]]
        return words[terms >= 0], terms[terms >= 0]


class Block:
    """Items with the numbers of their terms and how often each occurs."""

    def __init__(self, rows: list[tuple[object, str]]):
        numbers: dict[bytes, int] = {}
        self.ids, self.needs = [], []
        for item_id, text in rows:
            data = arrays.LOWER[np.frombuffer((text or "").encode(), np.uint8)]
            starts, ends, _ = arrays.words_of(data, np.array([0, len(data)]), arrays.ALNUM)
            if len(starts):
                raw = data.tobytes()
                found = [numbers.setdefault(raw[a:b], len(numbers)) for a, b in zip(starts.tolist(), ends.tolist())]
                self.ids.append(item_id)
                self.needs.append(np.unique(np.array(found), return_counts=True))
        self.terms = Terms(list(numbers))
        self.size = len(numbers)

    def occurrences(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Per run of rows: first and end row, terms of each row, then row, term and frequency of the block's terms."""
        for first, end, data, offsets in arrays.text_chunks(texts, BATCH_BYTES):
            data = arrays.LOWER[data]
            starts, ends, rows = arrays.words_of(data, offsets, arrays.ALNUM)
            words, terms = self.terms.find(data, starts, ends)
            keys, counts = np.unique(rows[words] * self.size + terms, return_counts=True)
            sizes = np.bincount(rows, minlength=end - first)
            yield first, end, sizes, keys // max(self.size, 1), keys % max(self.size, 1), counts


def blocks(benchmark: DataFrame) -> Iterator[Block]:
    """The distinct items in parts of bounded size, split by a hash."""
    items = benchmark.select("item_id", F.col("text").alias("words")).where("words is not null").distinct()
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()
    count = max(size // BLOCK_BYTES, n // BLOCK_ITEMS) + 1
    for part in range(count):
        chosen = items if count == 1 else items.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(count)) == part)
        yield Block([tuple(row) for row in chosen.orderBy("item_id", "words").collect()])


def statistics(documents: DataFrame, block: Block) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms with repeats, and documents per term of the block."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(block.size + 2, np.int64)
        for batch in batches:
            for _, _, sizes, _, terms, _ in block.occurrences(batch.column(0)):
                totals[-2] += np.count_nonzero(sizes)
                totals[-1] += sizes.sum()
                totals[:-2] += np.bincount(terms, minlength=block.size)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(totals))), pa.array(totals)], ["term", "n"])

    rows = documents.select("text").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    totals = np.zeros(block.size + 2, np.int64)
    for term, n in rows.collect():
        totals[term] = n
    return int(totals[-2]), int(totals[-1]), totals[:-2]


def weights(n_documents: int, holding: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df + 1))) for df in holding.tolist()], np.int64)


def impacts(weight: np.ndarray, frequency: np.ndarray, length: np.ndarray) -> np.ndarray:
    return weight * ((1_000_000_000 * frequency) // (1_000 * frequency + 12 * length))


class Scorer:
    """The best documents of one task for every item of a block."""

    def __init__(self, block: Block, n_documents: int, n_terms: int, weight: np.ndarray):
        self.block, self.n_documents, self.n_terms, self.weight = block, n_documents, n_terms, weight
        spread = arrays.mix(np.arange(block.size, dtype=np.uint64) + np.uint64(1))
        self.coordinate = (spread % np.uint64(COORDINATES)).astype(np.int64)
        self.lookups = np.zeros((COORDINATES, len(block.ids)))
        for item, (terms, repeats) in enumerate(block.needs):
            np.add.at(self.lookups[:, item], self.coordinate[terms], repeats)
        self.best: list[list[tuple[int, bool, object]]] = [[] for _ in block.ids]
        self.threshold = np.ones(len(block.ids))
        self.n_scored = 0

    def take(self, texts: pa.Array, ids: list[object]) -> None:
        for first, end, sizes, rows, terms, counts in self.block.occurrences(texts):
            if not len(rows):
                continue
            length = np.array([75 + 25 * n * self.n_documents // self.n_terms for n in sizes.tolist()], np.int64)
            value = impacts(self.weight[terms], counts, length[rows])
            sketches = np.zeros((end - first, COORDINATES))
            np.maximum.at(sketches, (rows, self.coordinate[terms]), value)
            bounds = (sketches @ self.lookups) * _SLACK
            keys = rows * self.block.size + terms
            for item in np.flatnonzero((bounds >= self.threshold).any(0)).tolist():
                self._rescore(item, bounds[:, item], keys, value, ids[first:end])

    def _rescore(self, item: int, bounds: np.ndarray, keys: np.ndarray, value: np.ndarray, ids: list[object]) -> None:
        """Exact scores by descending bound, until the bound falls below the threshold."""
        terms, repeats = self.block.needs[item]
        likely = np.flatnonzero(bounds >= self.threshold[item])
        likely = likely[np.argsort(-bounds[likely], kind="stable")]
        best = self.best[item]
        for low in range(0, len(likely), _STEP):
            rows = likely[low : low + _STEP]
            rows = rows[bounds[rows] >= self.threshold[item]]
            if not len(rows):
                break
            wanted = rows[:, None] * self.block.size + terms
            places = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            scores = (np.where(keys[places] == wanted, value[places], 0) * repeats).sum(1)
            self.n_scored += len(rows)
            best += [(-score, ids[row] is None, ids[row]) for row, score in zip(rows.tolist(), scores.tolist()) if score > 0]
            best.sort(key=_order)
            del best[TOP:]
            if len(best) == TOP:
                self.threshold[item] = -best[-1][0]


def _order(one: tuple[int, bool, object]) -> tuple:
    return one[:2] if one[1] else one


def search_block(documents: DataFrame, block: Block, id_type: DataType) -> DataFrame:
    """item_id, rank, doc_id and score of the best documents of each item of the block."""
    n_documents, n_terms, holding = statistics(documents, block)
    weight = weights(n_documents, holding)
    schema = StructType().add("item", IntegerType()).add("item_id", id_type).add("score", LongType()).add("doc_id", documents.schema["doc_id"].dataType)
    types = to_arrow_schema(schema)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(block, n_documents, n_terms, weight)
        for batch in batches:
            scorer.take(batch.column(1), batch.column(0).to_pylist())
        rows = [(item, block.ids[item], -score, doc_id) for item, best in enumerate(scorer.best) for score, _, doc_id in best]
        for low in range(0, len(rows), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(one, kind) for one, kind in zip(zip(*rows[low : low + 10_000]), types.types)], schema=types)

    scored = documents.select("doc_id", "text").mapInArrow(score, schema)
    best = [F.desc("score"), F.asc_nulls_last("doc_id")]
    within = Window.partitionBy("item", F.pmod(F.xxhash64("doc_id", "score"), F.lit(PARTS))).orderBy(*best)
    first = scored.withColumn("place", F.row_number().over(within)).where(F.col("place") <= TOP).drop("place")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*best)))
    return ranked.where(F.col("rank") <= TOP).select("item_id", "rank", "doc_id", "score")


def search(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The best documents of every item."""
    spark, id_type = documents.sparkSession, benchmark.schema["item_id"].dataType
    found = None
    for block in blocks(benchmark):
        part = search_block(documents, block, id_type)
        if found is None:
            found = part
        else:
            found = found.unionByName(tables.cut(spark, part, "search-block"))
    return found


def op12(spark: SparkSession, folder: str) -> DataFrame:
    """The best documents of every benchmark item over all documents."""
    documents = tables.read(spark, folder, "documents").select("doc_id", "text")
    return search(documents, tables.read(spark, folder, "benchmark").select("item_id", "text"))


OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents WHERE text IS NOT NULL
), items AS (
  SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)
), needs AS (
  SELECT i, item_id, term, count(*) AS c FROM (SELECT i, item_id, unnest(w) AS term FROM items) GROUP BY ALL
), totals AS (
  SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM docs WHERE len(w) > 0
), tf AS (
  SELECT r, term, CAST(count(*) AS BIGINT) AS f FROM (SELECT r, unnest(w) AS term FROM docs)
  WHERE term IN (SELECT term FROM needs) GROUP BY ALL
), df AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight
  FROM tf, totals GROUP BY term
), lengths AS (
  SELECT r, doc_id, 75 + (25 * CAST(len(w) AS BIGINT) * n) // l AS m FROM docs, totals WHERE len(w) > 0
), scores AS (
  SELECT i, item_id, doc_id, r, CAST(sum(c * weight * ((1000000000 * f) // (1000 * f + 12 * m))) AS BIGINT) AS score
  FROM needs JOIN tf USING (term) JOIN df USING (term) JOIN lengths USING (r) GROUP BY i, item_id, doc_id, r
), ranked AS (
  SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
