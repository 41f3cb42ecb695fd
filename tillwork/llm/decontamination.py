"""Benchmark decontamination: a broadcast hash set of normalised windows, scanned over the documents.

Texts are lower-cased (A-Z only) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. A benchmark
item gives its runs of ``WINDOW`` consecutive words, a shorter one its whole sequence. Document windows are
looked up by hash; each hit is verified on the words themselves, so a hash collision changes nothing.

Benchmark sets beyond ``BLOCK_BYTES`` are scanned in several blocks, each broadcast on its own with a written pass over
the documents, so what is broadcast never grows. There is no shuffle.

Defined results: a null or empty text has no words and no hits; a null or empty benchmark text gives no
window; an item without an id marks words but is not listed; items that share a window are all
listed; texts of any length are read whole; repeated rows are judged one by one; an
empty benchmark leaves every document clean; further columns of the documents are
carried, but for one named ``decontamination``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm import arrays, tables

WINDOW = 10
BLOCK_BYTES = 2_000_000
_BITS = 20
_STATE = "struct<n_words:bigint,hits:binary,items:array<string>>"


class WindowSet:
    """The windows of one benchmark block, by length in words."""

    def __init__(self, items: list[tuple[object, str]], window: int = WINDOW):
        self.by_length: dict[int, dict[int, dict[bytes, set[str]]]] = {}
        for item_id, text in items:
            data = arrays.LOWER[np.frombuffer((text or "").encode(), np.uint8)]
            starts, ends, _ = arrays.words_of(data, np.array([0, len(data)]), arrays.ALNUM)
            size = min(window, len(starts))
            if not size:
                continue
            hashes = arrays.window_hashes(arrays.word_hashes(data, starts, ends), size)
            known = self.by_length.setdefault(size, {})
            for k, value in enumerate(hashes.tolist()):
                names = known.setdefault(value, {}).setdefault(_joined(data, starts, ends, k, size), set())
                if item_id is not None:
                    names.add(str(item_id))
        self.sorted = {size: np.array(sorted(known), np.uint64) for size, known in self.by_length.items()}
        self.filters = {}
        for size, values in self.sorted.items():
            self.filters[size] = np.zeros(1 << _BITS, bool)
            self.filters[size][values >> np.uint64(64 - _BITS)] = True

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[set[str]]]:
        """Word starts, word ends, their rows, which words are hit, and the item ids per row."""
        data = arrays.LOWER[data]
        starts, ends, rows = arrays.words_of(data, offsets, arrays.ALNUM)
        hit = np.zeros(len(starts), bool)
        found: list[set[str]] = [set() for _ in range(len(offsets) - 1)]
        hashes = arrays.word_hashes(data, starts, ends) if self.sorted and len(starts) else None
        for size, values in self.sorted.items():
            if len(starts) < size:
                continue
            windows = arrays.window_hashes(hashes, size)
            places = np.flatnonzero(
                self.filters[size][windows >> np.uint64(64 - _BITS)] & (rows[size - 1 :] == rows[: len(windows)])
            )
            nearest = np.minimum(np.searchsorted(values, windows[places]), len(values) - 1)
            places = places[values[nearest] == windows[places]]
            sure = []
            for k in places.tolist():
                names = self.by_length[size][int(windows[k])].get(_joined(data, starts, ends, k, size))
                if names is not None:
                    sure.append(k)
                    found[rows[k]] |= names
            hit |= arrays.covered(np.array(sure, np.int64), size, len(starts))
        return starts, ends, rows, hit, found


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: int, size: int) -> bytes:
    return b" ".join(data[starts[k] : ends[k]].tobytes() for k in range(first, first + size))


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[object, str]]]:
    """The benchmark in parts of bounded size, split by a hash of the text."""
    benchmark = benchmark.select(F.col("item_id").alias("item"), F.col("text").alias("words")).where("words is not null")
    total = benchmark.select(F.sum(F.octet_length("words"))).first()[0] or 0
    count = total // BLOCK_BYTES + 1
    for block in range(count):
        part = benchmark if count == 1 else benchmark.where(F.pmod(F.xxhash64("words"), F.lit(count)) == block)
        yield [tuple(row) for row in part.collect()]


def mark(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``documents`` with the column ``decontamination``: word count, byte spans of hit words, item ids.

    ``hits`` holds pairs of 64-bit byte offsets into the UTF-8 text, one per hit word, in order.
    """
    marked = tables.without(documents, ("decontamination",)).withColumn("decontamination", F.lit(None).cast(_STATE))
    schema = marked.schema
    for number, items in enumerate(_blocks(benchmark)):
        if number:  # one pass at a time, so that a task never holds two blocks
            marked = tables.cut(marked.sparkSession, marked, "decontamination")
        marked = marked.mapInArrow(_scanner(WindowSet(items, window)), schema)
    return marked


def _scanner(windows: WindowSet):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("decontamination")
            before = batch.column(at).to_pylist()
            after = []
            for first, end, data, offsets in arrays.text_chunks(batch.column(batch.schema.get_field_index("text"))):
                starts, ends, rows, hit, found = windows.scan(data, offsets)
                bounds = arrays.row_ranges(rows, end - first)
                for k in range(end - first):
                    a, b = bounds[k], bounds[k + 1]
                    chosen = hit[a:b]
                    spans = np.stack([starts[a:b][chosen], ends[a:b][chosen]], 1) - offsets[k]
                    old, names = before[first + k], found[k]
                    if old is not None:
                        earlier = np.frombuffer(old["hits"], np.int64).reshape(-1, 2)
                        spans, names = np.unique(np.concatenate([earlier, spans]), axis=0), names | set(old["items"])
                    after.append({"n_words": int(b - a), "hits": spans.astype(np.int64).tobytes(), "items": sorted(names)})
            state = pa.array(after, batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), state)

    return scan


def remove_spans(marked: DataFrame) -> DataFrame:
    """The documents with hit words cut out; one that loses more than half of its words goes.

    Words between two hit words that follow each other go with what separates them. Documents
    without hits keep their text as it is.
    """
    columns = [name for name in marked.columns if name != "decontamination"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = batch.column(at).to_pylist()
            states = batch.column(batch.schema.get_field_index("decontamination")).to_pylist()
            keep = []
            for k, state in enumerate(states):
                spans = np.frombuffer(state["hits"], np.int64).reshape(-1, 2)
                keep.append(2 * len(spans) <= state["n_words"])
                if len(spans) and keep[-1]:
                    texts[k] = _without(texts[k].encode(), spans)
            rest = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            yield rest.filter(pa.array(keep, pa.bool_())).select(columns)

    return marked.mapInArrow(cut, marked.drop("decontamination").schema)


def _without(text: bytes, spans: np.ndarray) -> str:
    """Cut the spans; what stands between two of them goes too if it holds no word."""
    parts, end = [], 0
    for first, last in spans.tolist():
        between = text[end:first]
        if not end or arrays.ALNUM[arrays.LOWER[np.frombuffer(between, np.uint8)]].any():
            parts.append(between)
        end = last
    return b"".join([*parts, text[end:]]).decode()


def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Word and hit counts and the items found, for every document."""
    marked = mark(tables.read(spark, folder, "documents").select("doc_id", "text"), tables.read(spark, folder, "benchmark"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            states = batch.column(1).to_pylist()
            hits = [len(state["hits"]) // 16 for state in states]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([state["n_words"] for state in states], pa.int64()),
                    pa.array(hits, pa.int64()),
                    pa.array([len(state["items"]) for state in states], pa.int64()),
                    pa.array([hashlib.sha256(",".join(state["items"]).encode()).hexdigest() for state in states]),
                    pa.array([n > 0 for n in hits], pa.bool_()),
                ],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return marked.select("doc_id", "decontamination").mapInArrow(
        digest, "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"
    )


OP3_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size,
    array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS win
  FROM item_words, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i)
  WHERE len(w) > 0
), sizes AS (SELECT DISTINCT size FROM item_windows
), doc_windows AS (
  SELECT doc_id, size, i, array_to_string(list_slice(w, i, i + size - 1), ' ') AS win
  FROM words, sizes, unnest(range(1, greatest(len(w) - size + 1, 0) + 1)) AS t(i)
), hits AS (
  SELECT d.doc_id, d.size, d.i, b.item_id FROM doc_windows d JOIN item_windows b ON d.size = b.size AND d.win = b.win
), hit_words AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(0, size)) AS t(k) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT w.doc_id, CAST(coalesce(len(w.w), 0) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit,
  coalesce(t.n_items, 0) AS n_items, sha256(coalesce(t.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM words w LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items t USING (doc_id)
"""
