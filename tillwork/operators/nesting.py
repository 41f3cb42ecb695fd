"""Child rows to arrays of structs per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nest_children(children: DataFrame, key: str, fields: Mapping[str, str], out: str) -> DataFrame:
    """``key, out``: one sorted array of structs per key that holds every child row.

    ``fields`` maps child columns to struct fields. Equal children are counted before they travel, so copies
    arrive as one row and are written out only when the cell is built. A cell is one row by definition: a
    key whose array is beyond what Spark can hold in a row fails the job, and nothing is left out. Work on single
    elements at scale reads the child table instead.
    """
    keyed = children.where(F.col(key).isNotNull())
    tallies = keyed.groupBy(key, *fields).agg(F.count(F.lit(1)).alias("_copies"))
    element = F.struct(*[F.col(column).alias(field) for column, field in fields.items()])
    one = F.struct(element.alias("element"), F.col("_copies").cast("int").alias("copies"))
    repeated = F.transform(F.array_sort(F.collect_list(one)), lambda each: F.array_repeat(each["element"], each["copies"]))
    return tallies.groupBy(key).agg(F.flatten(repeated).alias(out))


def child_digests(children: DataFrame, key: str, fields: Sequence[str], out: str) -> DataFrame:
    """``key, n, out``: per key the number of children and a sum of their hashes, which does not depend on their order.

    What an array of the children holds can be told from it, but no key ever gathers: every task hands on one row per key.
    """
    text = F.array_join(F.array(*[F.col(name) for name in fields]), "=", "")
    # 60 bits of the hash as a number; sums of many stay exact.
    hashed = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")
    keyed = children.where(F.col(key).isNotNull())
    return keyed.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(hashed).alias(out))
