"""Aggregate expressions shared by the metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Ratings are averaged with this many decimals, averages of money with those of AVERAGE_TYPE.
RATING_TYPE = "decimal(18,6)"
AVERAGE_TYPE = "decimal(28,6)"


def mean_of(name: str | Column) -> Column:
    """Mean from the exact sum, as a double; NULL for no values. Doubles are cast to a decimal first."""
    return F.try_divide(F.sum(name).cast("double"), F.count(name))


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` as a double; NULL for a zero divisor."""
    return F.try_divide(top.cast("double"), bottom)


def sum_or_zero(name: str) -> Column:
    """Sum that is 0, not NULL, when a group holds only NULLs."""
    return F.coalesce(F.sum(name), F.lit(0))


def month_start(moment: str) -> Column:
    """First instant of the month, without a zone (so no session setting can shift it)."""
    return F.trunc(F.col(moment).cast("date"), "month").cast("timestamp_ntz")


def month_text(moment: str) -> Column:
    return F.date_format(F.col(moment).cast("date"), "yyyy-MM")


def with_copies(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct ``columns`` and how many rows share them.

    Facts are aggregated before they meet a dimension. Multiplying by ``copies`` afterwards gives
    what join-then-aggregate gives even if the dimension repeats a key.
    """
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
