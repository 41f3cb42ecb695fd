"""Tables that lie clustered by a key, so that joins and groupings on it need no shuffle of them.

A bucket holds all rows of its keys and cannot be split, so keys with a large part of all rows lie in a table of their own beside it,
which is split freely. There are at most ``SHARE`` such keys. What is computed per key is computed in both parts and
put together: no key is in both.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.sinks.tables import overwrite_table

#: A key with more than one in so many rows is hot.
SHARE = 1_000
HOT = "_hot"


@dataclass(frozen=True)
class Clustered:
    """The clustered rows of a table, and those of its hot keys."""

    cold: DataFrame
    hot: DataFrame


def hot_keys(df: DataFrame, key: str, share: int = SHARE) -> list:
    """Keys with more than one in ``share`` of the rows of ``df``: at most ``share`` of them."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    return [row[0] for row in counts.where(F.col("_rows") * share > df.count()).select(key).collect()]


def write_clustered(
    df: DataFrame, name: str, key: str, hot: Sequence, buckets: int, note: Mapping[str, str] | None = None
) -> int:
    """Write ``name``, clustered by ``key`` into ``buckets``, and beside it the rows of the hot keys; returns the rows of both.

    Tables that are to be joined need the same hot keys and buckets. Rows without a key are dealt at random among the hot ones.
    """
    apart = F.col(key).isNull() | F.col(key).isin(list(hot)) if hot else F.col(key).isNull()
    rows = overwrite_table(df.where(~apart), name, note=note, cluster_by=(key, buckets))
    return rows + overwrite_table(df.where(apart), name + HOT, note=note)


def read_clustered(spark: SparkSession, name: str) -> Clustered:
    return Clustered(spark.table(name), spark.table(name + HOT))


def per_part(build: Callable[..., DataFrame], *tables: Clustered) -> DataFrame:
    """``build`` over the clustered parts and over the hot parts, together."""
    return build(*[one.cold for one in tables]).unionByName(build(*[one.hot for one in tables]))
