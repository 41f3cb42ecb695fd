"""Reading the given tables and the session settings that the Python operators rely on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.session import new_folder

#: Rows per Arrow batch: with texts of a few thousand characters a batch is a few megabytes.
ARROW_ROWS = 1_000
#: A key with more than one in so many rows is joined by broadcast.
SHARE = 1_000


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One given table; ``folder`` may be any path Spark can read."""
    use_small_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def use_small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(column: str, parts: int):
    """The remainder of crc32 of the id as text: the folds for held-out rows."""
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(parts))


def with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` again the length of the text, where the table has that column."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def cut(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the shared folder and read again: a lost executor costs no recomputation."""
    folder = new_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def join_one(rows: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join with a table of one row per key; neither null nor frequent keys gather in one task."""
    total = rows.count()
    often = rows.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") * SHARE > total)
    often = [row[0] for row in often.select(key).collect()]
    known, hot = F.col(key).isNotNull(), F.col(key).isin(often) if often else F.lit(False)
    joined = rows.where(known & ~hot).join(right, key, "left")
    if often:
        joined = joined.unionByName(rows.where(known & hot).join(F.broadcast(right.where(hot)), key, "left"))
    return joined.unionByName(rows.where(~known), allowMissingColumns=True)


def without(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """``df`` without columns that bear one of ``names``, whatever their case: added columns replace them."""
    lowered = {name.lower() for name in names}
    return df.select([f"`{name}`" for name in df.columns if name.lower() not in lowered])


def set_aside(df: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with columns that bear one of ``names`` renamed, and what gives a result the columns of ``df`` again."""
    lowered = {name.lower() for name in names}
    renamed = {name: f"set_aside_{k}" if name.lower() in lowered else name for k, name in enumerate(df.columns)}

    def restore(result: DataFrame) -> DataFrame:
        return result.select([F.col(f"`{renamed[name]}`").alias(name) for name in df.columns])

    return df.select([F.col(f"`{name}`").alias(renamed[name]) for name in df.columns]), restore
