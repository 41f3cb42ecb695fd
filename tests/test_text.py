import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillwork.functions.text import (
    first_number, lexicon_score, place_of, preference_key, with_sentiment, with_state,
)


def _texts(spark, values):
    return spark.createDataFrame([(value,) for value in values], "t string")


def test_place(spark):
    values = ["5 Pine St, Austin", "Austin", None, "a,b,c", "a,", " x ", "a,  b "]
    found = [row[0] for row in _texts(spark, values).select(place_of(F.col("t"))).collect()]
    assert found == ["Austin", "Austin", None, "b", "", " x ", "b"]


def test_state_with_extractor_runs_on_distinct_addresses(spark, rows):
    @F.pandas_udf("string")
    def after_dash(texts: pd.Series) -> pd.Series:
        return texts.str.split("-").str[-1]

    df = spark.createDataFrame([(1, "x-Rome"), (2, "x-Rome"), (3, None), (4, "y-a, Oslo")], "id int, address string")
    found = with_state(df, "address", after_dash)
    assert rows(found, "id", "state") == [(1, "Rome"), (2, "Rome"), (3, None), (4, "Oslo")]


def test_lexicon_labels(spark):
    words = {"good": 1, "bad": -1}
    texts = ["Good good GOOD, fine", "bad", "good bad", None, "nothing", "good good good bad", "goodness badly", ""]
    scorer = lambda text: lexicon_score(text, ["good"], ["bad"])
    df = _texts(spark, texts).select("t", scorer(F.col("t")).alias("score"))
    assert [row["score"] for row in df.collect()] == [1.0, -1.0, 0.0, None, None, 0.5, None, None]
    labels = [row["sentiment_score"] for row in with_sentiment(df, "t", scorer).collect()]
    assert labels == ["Positive", "Negative", "Negative", "Neutral", "Neutral", "Neutral", "Neutral", "Neutral"]


def test_thresholds_are_exclusive(spark):
    df = spark.createDataFrame([(0.6,), (0.4,), (0.61,), (0.39,), (None,)], "s double")
    found = with_sentiment(df, "s", lambda score: score)
    assert [row[1] for row in found.collect()] == ["Neutral", "Neutral", "Positive", "Negative", "Neutral"]


def test_model_scorer_may_be_a_pandas_udf(spark):
    @F.pandas_udf("double")
    def length_score(texts: pd.Series) -> pd.Series:
        return texts.str.len() / 10

    found = with_sentiment(_texts(spark, ["abcdefgh", "abc"]), "t", length_score)
    assert [row["sentiment_score"] for row in found.collect()] == ["Positive", "Negative"]


def test_overlapping_lexicon_is_refused():
    with pytest.raises(ValueError):
        lexicon_score(None, ["good"], ["good"])


def test_first_number_and_key(spark):
    found = _texts(spark, ["12 hours", "none", None, "a7b8", ""]).select(first_number(F.col("t")))
    assert [row[0] for row in found.collect()] == [12.0, None, None, 7.0, None]
    df = spark.createDataFrame([("a", "b"), (None, "b"), ("a", None)], "preference_type string, preference_value string")
    assert [row[0] for row in df.select(preference_key()).collect()] == ["a - b", None, None]
