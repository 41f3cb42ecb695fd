"""Filter interaction audit: what each filter removes, alone and after others, for every order of the filters.

Every document fails some of the five filters. Its truth-table survival word has bit s set where it passes all filters of
subset s, so 32 bits answer for every subset at once. Words are added up bit by bit with carry-save adders (three words
become a sum and a carry plane, half as many words a level), per part and label, in the tasks; only 32 counts a part, label
and task travel. All figures of all orders follow from these subset survivors.

Texts are read once: the failure bits and a SHA-256 digest of each text are written as a small table. Whether a text
is that of a smaller id takes the smallest id per digest, aggregated in the map tasks, and a join on the digest. Keys that hold more
than one in ``tables.SHARE`` of all rows are at most as many, so they are joined by broadcast and the shuffled rest has no hot key.

Defined results: a null text is the empty text, and a copy of it; a null or empty language is the part with the empty name; a document
without an id is no copy, makes no other a copy, and has no label; rows that repeat an id are documents each, and copies of
smaller ids only; a document is good or toxic if any of its label rows says so; texts of any length are read whole; there are no ties,
since counts have no order; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm import tables

#: Letters of the filters, in the order of the failure bits.
FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
#: Parts that a task adds up before it hands its counts on.
PARTS = 10_000
LABELS = ("all", "good", "toxic")
_SPACE = r"[\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: The survival word of each set of failures.
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if s & failed == 0) for failed in range(SUBSETS)], np.uint32)


def failures(documents: DataFrame) -> DataFrame:
    """doc_id, part, digest of the text and the failure bits of the filters that one text decides (A to D)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    cut = documents.select(
        "doc_id",
        F.coalesce(F.col("lang"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.array_remove(F.split(text, _SPACE), "").alias("words"),
        F.length(text).alias("n_chars"),
        F.length(F.translate(text, _UPPER, "")).alias("n_others"),
        text.rlike(r"[#$%&*|]").alias("marked"),
    )
    counted = cut.withColumns(
        {"n_words": F.size("words").cast("bigint"), "n_distinct": F.size(F.array_distinct("words")).cast("bigint")}
    ).drop("words")
    failed = (
        F.col("n_words") < 100,
        100 * F.col("n_distinct") < 80 * F.col("n_words"),
        100 * (F.col("n_chars") - F.col("n_others")).cast("bigint") > 10 * F.col("n_chars").cast("bigint"),
        F.col("marked"),
    )
    bits = sum((F.when(one, 1 << bit).otherwise(0) for bit, one in enumerate(failed)), F.lit(0))
    return counted.select("doc_id", "part", "digest", bits.alias("failures"))


def mark(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, part, all failure bits, good and toxic of every document."""
    spark = documents.sparkSession
    facts = tables.cut(spark, failures(documents), "filter-failures")
    ids = facts.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    copies = tables.join_one(facts, ids.where("first < last").drop("last"), "digest")
    copied = F.when(F.col("doc_id") > F.col("first"), 1 << FILTERS.index("E")).otherwise(0)
    marked = copies.select("doc_id", "part", (F.col("failures") + copied).alias("failures"))
    marked = tables.cut(spark, marked, "filter-marked")
    flags = labels.where("doc_id is not null and (quality = 1 or toxic = 1)").groupBy("doc_id")
    flags = flags.agg(F.max(_is("quality")).alias("good"), F.max(_is("toxic")).alias("toxic"))
    joined = tables.join_one(marked, flags, "doc_id")
    return joined.select("doc_id", "part", "failures", *(F.coalesce(name, F.lit(False)).alias(name) for name in LABELS[1:]))


def _is(name: str) -> Column:
    return F.coalesce(F.col(name) == 1, F.lit(False))


def bit_counts(words: np.ndarray) -> np.ndarray:
    """How many words have each bit set, by carry-save adders."""
    counts, weight = np.zeros(SUBSETS, np.int64), 1
    while len(words):
        carries = [words[:0]]
        while len(words) > 2:
            third = len(words) // 3
            a, b, c = words[:third], words[third : 2 * third], words[2 * third : 3 * third]
            half = a ^ b
            carries.append((a & b) | (half & c))
            words = np.concatenate([half ^ c, words[3 * third :]])
        for word in words.tolist():
            counts += weight * ((word >> np.arange(SUBSETS)) & 1)
        words, weight = np.concatenate(carries), 2 * weight
    return counts


def survivors(marked: DataFrame) -> DataFrame:
    """part, label (place in ``LABELS``), subset and n, the documents that pass all filters of the subset."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            coded = batch.column(0).dictionary_encode()
            codes = coded.indices.to_numpy()
            words = WORDS[batch.column(1).to_numpy()]
            chosen = [batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3)]
            order = np.argsort(codes, kind="stable")
            cuts = np.searchsorted(codes[order], np.arange(len(coded.dictionary) + 1))
            for code, part in enumerate(coded.dictionary.to_pylist()):
                rows = order[cuts[code] : cuts[code + 1]]
                found = [bit_counts(words[rows]), *(bit_counts(words[rows[label[rows]]]) for label in chosen)]
                totals[part] = totals.get(part, 0) + np.stack(found)
            if len(totals) > PARTS:
                yield _count_rows(totals)
                totals = {}
        yield _count_rows(totals)

    found = marked.select("part", "failures", *LABELS[1:]).mapInArrow(count, "part string, label int, subset int, n bigint")
    return found.groupBy("part", "label", "subset").agg(F.sum("n").alias("n"))


def _count_rows(totals: dict[str, np.ndarray]) -> pa.RecordBatch:
    size = len(LABELS) * SUBSETS
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part for part in totals for _ in range(size)], pa.string()),
            pa.array(np.tile(np.repeat(np.arange(len(LABELS)), SUBSETS), len(totals)), pa.int32()),
            pa.array(np.tile(np.arange(SUBSETS), len(LABELS) * len(totals)), pa.int32()),
            pa.array(np.concatenate([one.ravel() for one in totals.values()]) if totals else [], pa.int64()),
        ],
        ["part", "label", "subset", "n"],
    )


def audit(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the subset survivors."""
    cells = F.sort_array(F.collect_list(F.struct("label", "subset", "n")))
    gathered = counts.groupBy("part").agg(F.transform(cells, lambda one: one["n"]).alias("counts"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, flat in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = order_rows(np.array(flat).reshape(len(LABELS), SUBSETS))
                yield pa.RecordBatch.from_pylist([{"part": part, **row} for row in rows], schema=_RESULT)

    return gathered.mapInArrow(spread, _RESULT_DDL)


_RESULT = pa.schema(
    [("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32())]
    + [(name, pa.int64()) for name in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]
)
_RESULT_DDL = ", ".join(f"{f.name} {({pa.string(): 'string', pa.int32(): 'int'}).get(f.type, 'bigint')}" for f in _RESULT)


def order_rows(counts: np.ndarray) -> list[dict]:
    """All orders and steps of one part; ``counts`` holds the survivors per label and subset."""
    passing, whole = counts[0], SUBSETS - 1
    rows, shares = [], dict.fromkeys(FILTERS, 0)
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            lost = (counts[:, before] - counts[:, before | bit]).tolist()
            shares[name] += lost[0]
            rows.append(
                {
                    "filter_order": "".join(order),
                    "step": step,
                    "kept": int(passing[before | bit]),
                    "removed": lost[0],
                    "redundant": int(passing[0] - passing[bit]) - lost[0],
                    "unique_fails": int(passing[whole ^ bit] - passing[whole]),
                    "good_lost": lost[1],
                    "toxic_lost": lost[2],
                }
            )
            before |= bit
    return [{**row, "shapley": shares[row["filter_order"][row["step"] - 1]]} for row in rows]


def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Every part, order and step over all documents."""
    documents = tables.read(spark, folder, "documents").select("doc_id", "text", "lang")
    labels = tables.read(spark, folder, "labels").select("doc_id", "quality", "toxic")
    return audit(survivors(mark(documents, labels)))


OP11_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), failed AS (
  SELECT part,
    CASE WHEN len(w) < 100 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS m,
    doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good,
    doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) AS toxic
  FROM texts
), counts AS (
  SELECT part, m, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic FROM failed GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS letter,
    CAST(2 ** (ascii(filter_order[step]) - 65) AS INTEGER) AS bit,
    CAST(list_sum(list_transform(range(1, step), lambda k: 2 ** (ascii(filter_order[k]) - 65))) AS INTEGER) AS before
  FROM orders, unnest(range(1, 6)) AS u(step)
), found AS (
  SELECT part, filter_order, step, letter,
    coalesce(sum(n) FILTER (m & (coalesce(before, 0) | bit) = 0), 0) AS kept,
    coalesce(sum(n) FILTER (m & coalesce(before, 0) = 0 AND m & bit <> 0), 0) AS removed,
    coalesce(sum(n) FILTER (m & coalesce(before, 0) <> 0 AND m & bit <> 0), 0) AS redundant,
    coalesce(sum(n) FILTER (m = bit), 0) AS unique_fails,
    coalesce(sum(n_good) FILTER (m & coalesce(before, 0) = 0 AND m & bit <> 0), 0) AS good_lost,
    coalesce(sum(n_toxic) FILTER (m & coalesce(before, 0) = 0 AND m & bit <> 0), 0) AS toxic_lost
  FROM counts, steps GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM found
"""
