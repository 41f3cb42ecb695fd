"""Quality rules as a ledger of bitmasks, in DataFrame functions only.

Every rule is evaluated once per document. The ledger keeps the measurements and one long whose bit r is set where rule
r fails. Policies are versioned masks over these bits: applying one, or asking what would be kept without one of its
rules, is a bitwise operation on the ledger and never reads a text again. The ledger is a table to be written (``store``):
a filter on one that is not would be pushed down into the measurements and evaluate them many times over.

Repeated eight-word windows are found within the row, by a 64-bit hash of each window. Only texts that hold a hash twice
are sorted. There is no shuffle.

Defined results: null and empty texts have no words and zero everywhere, so they fail the rule on few words; repeated
rows are judged one by one; texts of any length are measured whole; there are no ties, a document on a
limit does not fail; an empty table gives an empty ledger and an ablation without rows; other columns are carried,
but for those that bear the name of an added one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm import tables

WINDOW = 8
_SPACE = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]"
_SYMBOLS = "#*$%&|<>"

#: Name and condition of failure, in the order of the bits. Bits are never reused, so that old ledgers stay readable.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "100 * n_symbols > 30 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("upper_case", "100 * n_upper > 50 * word_chars"),
    ("word_length", "word_chars > 25 * n_words"),
    ("repeated_words", "100 * n_next_repeats > 30 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """Documents with any failure among ``rules`` go."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << bit for bit, (name, _) in enumerate(RULES) if name in self.rules)


BASE = Policy("base", ("few_words", "repeated_windows"))
VERSIONS = {
    policy.version: policy
    for policy in (
        BASE,
        Policy("2", (*BASE.rules, "symbols", "duplicate_lines", "upper_case")),
        Policy("3", (*BASE.rules, "symbols", "duplicate_lines", "upper_case", "word_length", "repeated_words")),
    )
}
CURRENT = "3"
_ADDED = (
    "n_words", "word_chars", "n_symbols", "n_upper", "n_lines", "n_dup_lines", "n_next_repeats", "n_repeat_words", "failures",
    "_words", "_lines", "_hashes", "_sorted", "_places",
)


def measure(documents: DataFrame) -> DataFrame:
    """``documents`` with all measurements of ``text``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    cut = documents.withColumns(
        {
            "_words": F.array_remove(F.split(text, _SPACE), ""),
            "_lines": F.filter(F.split(text, "\n"), lambda line: line.rlike(_WORD)),
            "n_symbols": (F.length(text) - F.length(F.translate(text, _SYMBOLS, ""))).cast("bigint"),
            "n_upper": (F.length(text) - F.length(F.regexp_replace(text, r"[A-ZÀ-ÖØ-Þ]+", ""))).cast("bigint"),
        }
    )
    counted = cut.withColumns(
        {
            "n_words": F.size("_words").cast("bigint"),
            "word_chars": F.length(F.array_join("_words", "")).cast("bigint"),
            "n_lines": F.size("_lines").cast("bigint"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
            "_hashes": _window_hashes(F.col("_words")),
            "n_next_repeats": F.size(
                F.filter("_words", lambda word, k: (k > 0) & (word == F.get("_words", F.greatest(k - 1, F.lit(0)))))
            ).cast("bigint"),
        }
    )
    marked = counted.withColumn(
        "_sorted",
        F.when(
            F.size("_hashes") != F.size(F.array_distinct("_hashes")),
            F.sort_array(F.transform("_hashes", lambda hashed, k: F.struct(hashed.alias("hash"), k.alias("place")))),
        ),
    )
    placed = marked.withColumn("_places", _repeated_places("_sorted"))
    done = placed.withColumn("n_repeat_words", F.coalesce(_covered("_places"), F.lit(0)).cast("bigint"))
    return done.drop("_words", "_lines", "_hashes", "_sorted", "_places")


def _window_hashes(words: Column) -> Column:
    last = F.size(words) - WINDOW + 1
    return F.when(
        last > 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda k: F.xxhash64(F.slice(words, k, WINDOW)))
    ).otherwise(F.array().cast("array<bigint>"))


def _repeated_places(ordered: str) -> Column:
    """Places whose hash equals that of a neighbour in the sorted order, ascending."""

    def place(one: Column, k: Column) -> Column:
        before, after = F.get(ordered, F.greatest(k - 1, F.lit(0))), F.get(ordered, k + 1)
        same = ((k > 0) & (before["hash"] == one["hash"])) | F.coalesce(after["hash"] == one["hash"], F.lit(False))
        return F.when(same, one["place"])

    return F.sort_array(F.array_compact(F.transform(ordered, place)))


def _covered(places: str) -> Column:
    """How many words the windows at ascending places cover together."""
    widths = F.transform(places, lambda one, k: F.least(F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - one, F.lit(WINDOW))))
    return F.aggregate(widths, F.lit(0), lambda total, width: total + width)


def ledger(documents: DataFrame) -> DataFrame:
    """``documents`` with the measurements and ``failures``, the bits of the failed rules."""
    bits = [F.when(F.expr(condition), F.lit(1 << bit)).otherwise(F.lit(0)).cast("bigint") for bit, (_, condition) in enumerate(RULES)]
    failures = bits[0]
    for bit in bits[1:]:
        failures = failures.bitwiseOR(bit)
    return measure(tables.without(documents, _ADDED)).withColumn("failures", failures)


def store(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """The ledger without the texts, written below the shared folder and read again."""
    return tables.cut(spark, ledger(documents).drop("text"), "ledger")


def passes(policy: Policy) -> Column:
    """Whether a ledger row has no failure that the policy counts."""
    return F.col("failures").bitwiseAND(F.lit(policy.mask).cast("bigint")) == 0


def ablation(rows: DataFrame, policy: Policy) -> DataFrame:
    """One row per rule of the policy: failures, failures of this rule only, and what is kept with and without it.

    One aggregation over the ledger; each figure is a sum over one bitwise test.
    """
    failed = F.col("failures").bitwiseAND(F.lit(policy.mask).cast("bigint"))
    sums = [F.count("*").alias("n"), F.sum((failed == 0).cast("bigint")).alias("kept")]
    chosen = [(bit, name) for bit, (name, _) in enumerate(RULES) if name in policy.rules]
    for bit, _ in chosen:
        one = F.lit(1 << bit).cast("bigint")
        sums.append(F.sum((failed.bitwiseAND(one) != 0).cast("bigint")).alias(f"failed_{bit}"))
        sums.append(F.sum((failed == one).cast("bigint")).alias(f"only_{bit}"))
    totals = rows.agg(*sums).where("n > 0")
    each = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                F.col(f"failed_{bit}").alias("n_failed"),
                F.col(f"only_{bit}").alias("n_only"),
                F.col("kept").alias("n_kept"),
                (F.col("kept") + F.col(f"only_{bit}")).alias("n_kept_without"),
            )
            for bit, name in chosen
        ]
    )
    return totals.select(F.lit(policy.version).alias("version"), F.inline(each))


def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Measurements, base verdict and current verdict of every document."""
    rows = ledger(tables.read(spark, folder, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~passes(BASE)).alias("base_failed"),
        passes(VERSIONS[CURRENT]).alias("kept"),
        "failures",
    )


OP5_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), wins AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, list_slice(w, i, i + 7)) AS c
  FROM cut, unnest(range(1, greatest(len(w) - 7, 0) + 1)) AS u(i)
), reps AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM wins, unnest(range(0, 8)) AS u(k) WHERE c > 1 GROUP BY doc_id
), m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(length(t) - length(regexp_replace(t, '[A-Z\x{00C0}-\x{00D6}\x{00D8}-\x{00DE}]+', '', 'g')) AS BIGINT) AS n_upper,
    CAST(len(list_filter(range(2, greatest(len(w), 1) + 1), lambda k: w[k] = w[k - 1])) AS BIGINT) AS n_next,
    CAST(coalesce(reps.n, 0) AS BIGINT) AS n_repeat_words
  FROM cut LEFT JOIN reps USING (doc_id)
), f AS (
  SELECT *, n_words < 20 AS f0, 100 * n_repeat_words > 30 * n_words AS f1, 100 * n_symbols > 30 * n_words AS f2,
    100 * n_dup_lines > 50 * n_lines AS f3, 100 * n_upper > 50 * word_chars AS f4, word_chars > 25 * n_words AS f5,
    100 * n_next > 30 * n_words AS f6
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f0 OR f1 AS base_failed,
  NOT (f0 OR f1 OR f2 OR f3 OR f4 OR f5 OR f6) AS kept,
  CAST(f0 AS BIGINT) + 2 * CAST(f1 AS BIGINT) + 4 * CAST(f2 AS BIGINT) + 8 * CAST(f3 AS BIGINT) + 16 * CAST(f4 AS BIGINT)
    + 32 * CAST(f5 AS BIGINT) + 64 * CAST(f6 AS BIGINT) AS failures
FROM f
"""
