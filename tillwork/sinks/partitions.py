"""Partitioned tables of which each night changes a part: only changed partitions are written.

Each partition has a digest that does not depend on the order of its rows: their number and two sums of row hashes. Partitions
whose digest is that of the version shown are not written again; the new version names the folder they already lie in. A version
goes when nothing names its folders any more, and before that it gives up the partitions that nothing names. These versions are
external tables, since the catalog deletes the folders of a managed table wherever they lie.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillwork.functions.names import quoted
from tillwork.sinks import tables
from tillwork.sinks.tables import Conflict, Replacement, current_version, overwrite_table

_ATTEMPTS = 3


def partition_digests(df: DataFrame, partition_by: Sequence[str], ignored: Sequence[str] = ()) -> list[Row]:
    """Per partition its values, ``_part`` (the values as JSON, NULL where one is missing or empty) and ``_digest``."""
    hashed = [F.col(quoted(name)) for name in sorted(df.columns) if name not in ignored]

    def total(seed: int):
        return F.sum(F.xxhash64(F.lit(seed), *hashed).cast("decimal(38,0)")).cast("string")

    digest = F.concat_ws(":", F.count("*").cast("string"), total(0), total(1))
    found = df.groupBy(*partition_by).agg(digest.alias("_digest"), F.count("*").alias("_rows"))
    texts = [F.col(quoted(name)).cast("string").alias(f"_text_{k}") for k, name in enumerate(partition_by)]
    rows = found.select("*", *texts).collect()
    return [
        Row(**{name: row[name] for name in (*partition_by, "_digest", "_rows")}, _part=_part([row[f"_text_{k}"] for k in range(len(texts))]))
        for row in rows
    ]


def _part(values: list[str | None]) -> str | None:
    return json.dumps(values) if all(values) else None


def overwrite_partitions(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str],
    verify: Callable[[], None] | None = None,
    note: Mapping[str, str] | None = None,
    ignored: Sequence[str] = (),
) -> int:
    """``overwrite_table`` that writes only the partitions that differ from those ``name`` shows; returns the rows of all.

    The rows are computed once and kept for the comparison and the writing. Columns in ``ignored``, such as the time of loading, do
    not make a partition differ. A writer that another one overtakes compares again. The driver holds a line per partition.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        digests = partition_digests(kept, partition_by, ignored)
        for _ in range(_ATTEMPTS):
            try:
                return _replace(kept, name, partition_by, digests, verify, note)
            except Conflict:
                continue
        return overwrite_table(kept, name, partition_by, verify, note=note)
    finally:
        kept.unpersist()


def _replace(df, name, partition_by, digests, verify, note) -> int:
    spark = df.sparkSession
    replacement, shown = Replacement(spark, name, partition_by, external=True), current_version(spark, name)
    known = tables.parts_of(tables._properties(spark, name)) if shown is not None and _same_layout(df, name) else {}
    same = {row._part: known[row._part] for row in digests if row._part in known and known[row._part].rpartition("@")[0] == row._digest}
    try:
        changed = [row for row in digests if row._part not in same]
        replacement.write(_of_partitions(df, partition_by, changed) if same else df)
        replacement.rows = sum(row._rows for row in digests)
        _link(replacement, same)
        replacement.parts = same | {row._part: f"{row._digest}@{replacement.version}" for row in changed if row._part is not None}
        if verify is not None:
            verify()
        replacement.commit(replacing=shown, note=note)
    except BaseException:
        replacement.abandon()
        raise
    return replacement.rows


def _same_layout(df: DataFrame, name: str) -> bool:
    """Whether the columns and types of ``df`` are those shown: files of other columns cannot be named."""
    def types(one: StructType) -> dict:
        return {field.name: field.dataType.simpleString() for field in one}

    return types(df.schema) == types(df.sparkSession.table(name).schema)


def _of_partitions(df: DataFrame, partition_by: Sequence[str], chosen: list[Row]) -> DataFrame:
    """The rows of the chosen partitions; NULL is a value like others."""
    fields = StructType([df.schema[name] for name in partition_by])
    values = df.sparkSession.createDataFrame([tuple(row[name] for name in partition_by) for row in chosen], fields)
    values = F.broadcast(values.toDF(*[f"_{k}" for k in range(len(partition_by))]))
    fits = F.lit(True)
    for k, name in enumerate(partition_by):
        fits = fits & df[quoted(name)].eqNullSafe(values[f"_{k}"])
    return df.join(values, fits, "left_semi")


def _link(replacement: Replacement, same: Mapping[str, str]) -> None:
    """Name the folders of unchanged partitions in the new version."""
    spark, at = replacement.spark, {}
    for part, digest in same.items():
        home = digest.rpartition("@")[2]
        if home not in at:
            folder = tables.external_folder(spark, home)
            at[home] = folder, tables.partitions(spark, home) if folder is not None else {}
        location, found = at[home]
        if part not in found:
            raise Conflict(f"{home} has given up {part}")
        folder = f"{location}/{found[part].folder}"
        spark.sql(f"ALTER TABLE {tables._sql_name(replacement.version)} ADD PARTITION ({found[part].sql}) LOCATION {tables._text(folder)}")
