"""Declared expectations, checked in one pass over the whole table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# One row per expectation.
_RESULT_FIELDS = (
    "check_no int, expectation string, column string, success boolean, element_count bigint, "
    "missing_count bigint, unexpected_count bigint, unexpected_percent double, observed_value string"
)


@dataclass(frozen=True)
class ValuesInSet:
    """Every value that is not NULL is one of ``values``, exactly."""

    column: str
    values: tuple

    # Fixed value: the check's name in the audit records.
    name = "expect_column_values_to_be_in_set"

    def measures(self) -> dict[str, Column]:
        value = F.col(self.column)
        return {
            "rows": F.count(F.lit(1)),
            "missing": F.count_if(value.isNull()),
            "unexpected": F.count_if(~value.isin(list(self.values))),
        }

    def result(self, measured: dict[str, Column]) -> dict[str, Column]:
        present = measured["rows"] - measured["missing"]
        return {
            "success": measured["unexpected"] == 0,
            "element_count": measured["rows"],
            "missing_count": measured["missing"],
            "unexpected_count": measured["unexpected"],
            "unexpected_percent": F.try_divide(measured["unexpected"] * 100.0, present),
        }


@dataclass(frozen=True)
class MinBetween:
    """The smallest value lies in ``[low, high]``; a column without values fails."""

    column: str
    low: float
    high: float

    # Fixed value: the check's name in the audit records.
    name = "expect_column_min_to_be_between"

    def measures(self) -> dict[str, Column]:
        return {"least": F.min(self.column)}

    def result(self, measured: dict[str, Column]) -> dict[str, Column]:
        least = measured["least"]
        return {
            "success": F.coalesce(least.between(self.low, self.high), F.lit(False)),
            "observed_value": least.cast("string"),
        }


# The suite that guards the review table.
REVIEW_EXPECTATIONS = (
    ValuesInSet("verified_purchase", ("FALSE",)),
    MinBetween("helpful_votes", 12, 20),
)


def bottom_sample(df: DataFrame, rows: int, key: Sequence[str] = ()) -> DataFrame:
    """The ``rows`` rows whose key has the smallest hash; all of them if there are fewer.

    The same rows in every run and at every partitioning: each task keeps its smallest, and these are merged. ``key``
    should tell rows apart; without it all columns are the key.
    """
    named = [F.col(f"`{name}`") for name in key or df.columns]
    text = F.to_json(F.struct(*named)) if len(named) != 1 else F.coalesce(named[0].cast("string"), F.lit(""))
    # Rows with equal keys are told apart by the rest of them.
    whole = F.to_json(F.struct(*[F.col(f"`{name}`") for name in df.columns]))
    return df.orderBy(F.sha2(text, 256), text, whole).limit(rows)


def check(
    df: DataFrame, expectations: Sequence, sample_rows: int | None = None, sample_key: Sequence[str] = ()
) -> DataFrame:
    """One result row per expectation, from a single aggregation.

    ``sample_rows`` checks a sample of that size instead of the whole table, the same in every run (``bottom_sample``).
    """
    if sample_rows is None:
        source = df
    else:
        needed = {*sample_key, *(expectation.column for expectation in expectations)}
        source = bottom_sample(df.select([name for name in df.columns if not sample_key or name in needed]), sample_rows, sample_key)
    measured = [
        measure.alias(f"_{number}_{label}")
        for number, expectation in enumerate(expectations)
        for label, measure in expectation.measures().items()
    ]
    rows = []
    fields = [field.strip().rsplit(" ", 1) for field in _RESULT_FIELDS.split(",")]
    for number, expectation in enumerate(expectations):
        found = {label: F.col(f"_{number}_{label}") for label in expectation.measures()}
        values = {
            "check_no": F.lit(number),
            "expectation": F.lit(expectation.name),
            "column": F.lit(expectation.column),
            **expectation.result(found),
        }
        rows.append(
            F.struct(*[values.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in fields])
        )
    return source.agg(*measured).select(F.inline(F.array(*rows)))


def validation_record(results: DataFrame, run_name: str) -> DataFrame:
    """``RunStatus, RunId, RunValidation``: one row that sums up a run for the audit table."""
    checks = F.array_sort(F.collect_list(F.struct(*results.columns)))
    run = F.struct(F.lit(run_name).alias("run_name"), F.current_timestamp().cast("string").alias("run_time"))
    return results.agg(
        F.coalesce(F.bool_and("success"), F.lit(True)).alias("RunStatus"),
        F.first(F.parse_json(F.to_json(run))).alias("RunId"),
        F.parse_json(F.to_json(checks)).alias("RunValidation"),
    )
