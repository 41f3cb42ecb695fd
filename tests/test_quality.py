import json

import pytest
from pyspark.sql import functions as F

from tillwork.operators.quality import (
    REVIEW_EXPECTATIONS, MinBetween, ValuesInSet, bottom_sample, check, validation_record,
)


def _reviews(spark):
    return spark.createDataFrame(
        [("true", 12), ("FALSE", 20), (None, None), ("FALSE", 15)], "verified_purchase string, helpful_votes int"
    )


def test_checks_in_one_pass(spark):
    first, second = check(_reviews(spark), REVIEW_EXPECTATIONS).collect()
    assert (first.success, first.element_count, first.missing_count, first.unexpected_count) == (False, 4, 1, 1)
    assert abs(first.unexpected_percent - 100 / 3) < 1e-9
    assert (second.success, second.observed_value) == (True, "12")


def test_bounds_are_inclusive_and_empty_columns_fail(spark):
    df = _reviews(spark)
    assert check(df, [MinBetween("helpful_votes", 5, 12)]).first().success
    assert not check(df, [MinBetween("helpful_votes", 13, 20)]).first().success
    assert not check(df.where("helpful_votes is null"), [MinBetween("helpful_votes", 0, 99)]).first().success


def test_nulls_are_ignored_and_match_is_exact(spark):
    df = _reviews(spark)
    assert check(df, [ValuesInSet("verified_purchase", ("true", "FALSE"))]).first().success
    assert not check(df, [ValuesInSet("verified_purchase", ("true", "false"))]).first().success


def test_sample_and_record(spark):
    results = check(_reviews(spark), REVIEW_EXPECTATIONS, sample_rows=2)
    assert results.first().element_count == 2
    record = validation_record(check(_reviews(spark), REVIEW_EXPECTATIONS), "night-1").first()
    assert record.RunStatus is False
    assert json.loads(record.RunId.toJson())["run_name"] == "night-1"
    assert [one["success"] for one in json.loads(record.RunValidation.toJson())] == [False, True]


@pytest.mark.parametrize("key", [("id",), ("group",), ()])
def test_the_sample_is_the_same_at_any_partitioning(spark, rows, key):
    df = spark.range(500).select("id", (F.col("id") % 40).alias("group"), F.array(F.col("id") % 3).alias("list"))
    samples = [rows(bottom_sample(df.repartition(parts, F.rand(parts)), 60, key)) for parts in (1, 3, 17)]
    assert samples[0] == samples[1] == samples[2] and len(samples[0]) == 60
    assert rows(bottom_sample(df, 10_000, key)) == rows(df)
    # A larger sample holds the smaller one.
    assert set(map(str, samples[0])) <= set(map(str, rows(bottom_sample(df, 200, key))))


def test_the_sample_is_spread_over_the_table(spark):
    ids = [row.id for row in bottom_sample(spark.range(10_000), 400, ("id",)).collect()]
    assert abs(sum(ids) / 400 - 5_000) < 600


def test_a_sample_is_kept_per_task_and_merged(spark):
    plan = check(spark.range(100).withColumn("v", F.col("id") % 2), [ValuesInSet("v", (0,))], 10, ("id",))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in text
    first, again = (check(spark.range(100).repartition(n).withColumn("v", F.col("id") % 2), [ValuesInSet("v", (0,))], 10, ("id",)).first() for n in (2, 9))
    assert first == again and first.element_count == 10 and 0 < first.unexpected_count < 10
