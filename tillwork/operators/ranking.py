"""Top-k reports. Orders are total: ties are broken by the key columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, measure: str, n: int, *keys: str) -> DataFrame:
    """The ``n`` rows with the largest ``measure``; each task keeps at most ``n`` rows."""
    order = [F.desc_nulls_last(measure), *[F.asc_nulls_last(key) for key in keys]]
    return df.orderBy(*order).limit(n)


def top_ranked(df: DataFrame, group: str, measure: str, depth: int) -> DataFrame:
    """Rows of rank ``depth`` or better in their group; tied rows share a rank and all stay.

    Spark cuts each task's rows to that rank before the shuffle, so a large group stays small.
    """
    window = Window.partitionBy(group).orderBy(F.desc_nulls_last(measure))
    return df.withColumn("rank", F.rank().over(window)).where(F.col("rank") <= depth).drop("rank")
