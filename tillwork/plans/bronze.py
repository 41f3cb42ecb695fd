"""Bronze layer: sources into catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillwork import schemas
from tillwork.functions.names import clean_names
from tillwork.sinks.tables import overwrite_table
from tillwork.sources import files
from tillwork.sources.databases import DatabaseSource, KeySplit, RangeSplit, read_table
from tillwork.sources.snapshots import Snapshot


def database_table(
    spark: SparkSession,
    source: DatabaseSource,
    table: str,
    split: RangeSplit | KeySplit | None = None,
    snapshot: Snapshot | None = None,
) -> DataFrame:
    """A source table with cleaned names."""
    return clean_names(read_table(spark, source, table, split, snapshot))


def load_table(
    spark: SparkSession,
    source: DatabaseSource,
    table: str,
    target: str,
    split: RangeSplit | KeySplit | None = None,
    snapshot: Snapshot | None = None,
) -> int:
    """A source table as ``target``. Rows of a watched source that has changed meanwhile are not shown."""
    verify = snapshot.verify if snapshot is not None else None
    return overwrite_table(database_table(spark, source, table, split, snapshot), target, verify=verify)


def load_reviews(
    spark: SparkSession, path: str, layout: str, target: str = schemas.BRONZE_PRODUCT_REVIEWS
) -> int:
    return overwrite_table(files.read_reviews(spark, path, layout), target)


def load_preferences(
    spark: SparkSession, path: str, layout: str, target: str = schemas.BRONZE_CUSTOMER_PREFERENCES
) -> int:
    return overwrite_table(files.read_preferences(spark, path, layout), target)


def load_specifications(
    spark: SparkSession, path: str, layout: str, target: str = schemas.BRONZE_PRODUCT_SPECIFICATIONS
) -> int:
    return overwrite_table(files.read_specifications(spark, path, layout), target)
