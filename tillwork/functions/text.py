"""Text columns: places from addresses, sentiment labels, digits, keys."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Scorer = Callable[[Column], Column]

# Label thresholds. Above the first is Positive, below the second Negative.
POSITIVE_ABOVE = 0.6
NEGATIVE_BELOW = 0.4

# Default lexicon; pass other lists for another language or domain.
POSITIVE_WORDS = (
    "amazing", "awesome", "best", "excellent", "fantastic", "good", "great", "happy", "love",
    "nice", "perfect", "pleased", "recommend", "reliable", "satisfied", "superb", "wonderful",
)
NEGATIVE_WORDS = (
    "awful", "bad", "broken", "defective", "disappointed", "faulty", "hate", "horrible", "poor",
    "refund", "slow", "terrible", "unhappy", "useless", "waste", "worse", "worst",
)


def place_of(answer: Column) -> Column:
    """Second comma-separated part without outer blanks, or the whole text when it has no comma."""
    second = F.trim(F.split_part(answer, F.lit(","), F.lit(2)))
    return F.when(F.contains(answer, F.lit(",")), second).otherwise(answer)


def with_state(df: DataFrame, address: str = "address", extractor: Scorer | None = None) -> DataFrame:
    """Add ``state``, the place that the extracted text names.

    Without an extractor the address itself is the extracted text and everything stays in one
    projection. A model-backed extractor runs once per distinct address and is joined back, so
    its cost follows the number of addresses and not the number of rows.
    """
    if extractor is None:
        return df.withColumn("state", place_of(F.col(address)))
    answers = (
        df.select(F.col(address).alias("_address"))
        .where(F.col("_address").isNotNull())
        .distinct()
        .select("_address", place_of(extractor(F.col("_address")).cast("string")).alias("state"))
    )
    return df.join(answers, F.col(address) == F.col("_address"), "left").drop("_address")


def lexicon_score(
    text: Column,
    positive: Iterable[str] = POSITIVE_WORDS,
    negative: Iterable[str] = NEGATIVE_WORDS,
) -> Column:
    """``(p - n) / (p + n)`` over the listed words of the whole text; NULL when none occurs."""
    ups, downs = sorted(set(positive)), sorted(set(negative))
    both = set(ups) & set(downs)
    if both:
        raise ValueError(f"words listed as both positive and negative: {sorted(both)}")
    hits = F.filter(F.split(F.lower(text), "[^a-z]+"), lambda word: word.isin(ups + downs))
    return F.aggregate(
        hits,
        F.struct(F.lit(0).alias("balance"), F.lit(0).alias("seen")),
        lambda acc, word: F.struct(
            (acc["balance"] + F.when(word.isin(ups), 1).otherwise(-1)).alias("balance"),
            (acc["seen"] + 1).alias("seen"),
        ),
        lambda acc: F.try_divide(acc["balance"], acc["seen"]),
    )


def with_sentiment(
    df: DataFrame,
    text: str = "content",
    scorer: Scorer = lexicon_score,
    out: str = "sentiment_score",
) -> DataFrame:
    """Label each row Positive, Negative or Neutral. The score is computed once per row."""
    score = F.col("_score")
    label = (
        F.when(score > POSITIVE_ABOVE, "Positive")
        .when(score < NEGATIVE_BELOW, "Negative")
        .otherwise("Neutral")
    )
    return df.withColumn("_score", scorer(F.col(text))).withColumn(out, label).drop("_score")


def first_number(text: Column) -> Column:
    """The first run of digits as a double; NULL when there is none."""
    return F.regexp_extract(text, r"(\d+)", 1).try_cast("double")


def same_text(text: Column, wanted: str) -> Column:
    """Equal apart from case."""
    return F.lower(text) == F.lit(wanted.lower())


def preference_key(kind: str = "preference_type", value: str = "preference_value") -> Column:
    """``kind - value``; NULL when either part is."""
    return F.concat(F.col(kind).cast("string"), F.lit(" - "), F.col(value).cast("string"))
