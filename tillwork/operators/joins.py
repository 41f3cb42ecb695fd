"""Equi-joins with a suffix for clashing right-hand names.

Joins carry no broadcast hint unless the side was counted (``small_enough``). Without one, Spark
broadcasts a side only when its size, estimated or measured by adaptive execution, is below
``spark.sql.autoBroadcastJoinThreshold``; beyond that it sorts and merges, and splits skewed
partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.functions.names import quoted

# Rows of a narrow key list that may be broadcast.
BROADCAST_ROWS = 500_000


def _renamed(left: DataFrame, right: DataFrame, suffix: str) -> DataFrame:
    taken = {name.lower() for name in left.columns}
    return right.select(
        *[
            F.col(quoted(name)).alias(name + suffix if name.lower() in taken else name)
            for name in right.columns
        ]
    )


def join_suffix(left: DataFrame, right: DataFrame, on: str, how: str = "left", suffix: str = "_right") -> DataFrame:
    """Join on ``on``. Clashing right columns, the key among them, get ``suffix``."""
    other = _renamed(left, right, suffix)
    return left.join(other, left[on] == other[on + suffix], how)


def left_join_many(left: DataFrame, right: DataFrame, on: str, suffix: str = "_right") -> DataFrame:
    """``join_suffix(..., "left")`` for a right side in which one key may hold much of the rows.

    Adaptive execution can split a skewed partition of either side of an inner join, but only the
    left one of a left outer join. So this is the inner join plus the left rows without a match.
    The right keys are made distinct before they are shuffled, and both parts read the same
    shuffle of the left side, which is why rows without a key are taken apart first.
    """
    keyed = left.where(left[on].isNotNull())
    matched = join_suffix(keyed, right, on, "inner", suffix)
    present = right.select(F.col(on).alias("_present")).distinct()
    unmatched = keyed.join(present, keyed[on] == present["_present"], "left_anti")
    alone = unmatched.union(left.where(left[on].isNull()))
    return matched.unionByName(alone, allowMissingColumns=True)


def small_enough(keys: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``keys`` with a broadcast hint if a count finds at most ``max_rows``, else as it is.

    For filtered key lists: Spark cannot estimate what a filter leaves and would shuffle the large
    side before it finds out.
    """
    return F.broadcast(keys) if keys.count() <= max_rows else keys
