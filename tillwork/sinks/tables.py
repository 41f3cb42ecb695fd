"""Catalog tables in versions. A name is a view of its current version, so that a replacement is one metadata step.

Several writers may work on one name. Each writes a version of its own, whose name holds the time until which it is leased:
nobody takes it for left over before. Versions are shown one writer at a time, behind a lock that the catalog keeps
(creating a view of a name that exists fails), so the last commit wins and no view is left on a dropped table.
"""

from __future__ import annotations

import json
import re
import threading
import time
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager, suppress
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillwork.functions.names import quoted, trim_names
from tillwork.session import remove_folder

_VERSION = "__version_"
_LOCK = "__commit"
_NOTE = "note."
_PART = "part."
_STALE = "parts_are_stale"
_RETAINED = "retained"
_LEASE = re.compile(rf"{_VERSION}([0-9a-f]+)_[0-9a-f]{{32}}$", re.IGNORECASE)
#: How long a version may take to be written.
LEASE_SECONDS = 24 * 3_600
#: A commit whose lock was not renewed for so long is taken for dead.
COMMIT_SECONDS = 600


class Conflict(RuntimeError):
    """The name no longer shows the version that a writer has built on, or a writer has lost its right to show one."""


def _sql_name(name: str) -> str:
    return ".".join(quoted(part) for part in name.split("."))


def _versions(spark: SparkSession, name: str) -> list[str]:
    """The tables behind ``name``, whether they are current or not."""
    database, _, table = name.rpartition(".")
    where = f" IN {_sql_name(database)}" if database else ""
    found = spark.sql(f"SHOW TABLES{where} LIKE '{table}{_VERSION}*'").collect()
    return [f"{database}.{row.tableName}" if database else row.tableName for row in found]


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW"


def current_version(spark: SparkSession, name: str) -> str | None:
    """The table that ``name`` shows, if ``overwrite_table`` has made it."""
    if not _is_view(spark, name):
        return None
    return _properties(spark, name).get("version")


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return dict(tuple(row) for row in spark.sql(f"SHOW TBLPROPERTIES {_sql_name(name)}").collect())


def _fresh_version(name: str) -> str:
    return f"{name}{_VERSION}{int(time.time() + LEASE_SECONDS):x}_{uuid.uuid4().hex}"


def _leased(version: str) -> bool:
    """Whether a version may still be at work; names without a lease never are."""
    found = _LEASE.search(version)
    return found is not None and int(found[1], 16) > time.time()


class _Lock:
    """The right to change what ``name`` shows, as a view that only one writer can create."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.view, self.holder = spark, f"{name}{_LOCK}", uuid.uuid4().hex

    def _claim(self) -> str:
        return f"('holder' = '{self.holder}', 'until' = '{time.time() + COMMIT_SECONDS}')"

    def _held_by(self) -> tuple[str, float] | None:
        try:
            found = _properties(self.spark, self.view)
        except AnalysisException:  # gone meanwhile
            return None
        return (found["holder"], float(found["until"])) if "holder" in found else None

    def try_acquire(self) -> bool:
        try:
            self.spark.sql(f"CREATE VIEW {_sql_name(self.view)} TBLPROPERTIES {self._claim()} AS SELECT 1 AS held")
            return True
        except AnalysisException as failure:
            if failure.getCondition() != "TABLE_OR_VIEW_ALREADY_EXISTS":
                raise
        other = self._held_by()
        if other is not None and other[1] < time.time() and self._held_by() == other:
            self.spark.sql(f"DROP VIEW IF EXISTS {_sql_name(self.view)}")
        return False

    def renew(self) -> None:
        self.check()
        self.spark.sql(f"ALTER VIEW {_sql_name(self.view)} SET TBLPROPERTIES {self._claim()}")

    def check(self) -> None:
        """Right before anything is shown: a writer that was taken for dead must not go on."""
        other = self._held_by()
        if other is None or other[0] != self.holder:
            raise Conflict(f"{self.view} was taken over by another writer")

    def release(self) -> None:
        other = self._held_by()
        if other is not None and other[0] == self.holder:
            self.spark.sql(f"DROP VIEW IF EXISTS {_sql_name(self.view)}")


@contextmanager
def _commit(spark: SparkSession, name: str, wait_seconds: float | None = None) -> Iterator[_Lock]:
    """Hold the lock of ``name``, renewed as long as the block runs."""
    lock, began, done = _Lock(spark, name), time.monotonic(), threading.Event()
    while not lock.try_acquire():
        if wait_seconds is not None and time.monotonic() - began > wait_seconds:
            raise Conflict(f"another writer commits to {name}")
        time.sleep(0.05)

    def renewing() -> None:
        with suppress(Conflict):
            while not done.wait(COMMIT_SECONDS / 4):
                lock.renew()

    keeper = threading.Thread(target=renewing, daemon=True)
    keeper.start()
    try:
        yield lock
    finally:
        done.set()
        keeper.join()
        lock.release()


class Replacement:
    """A new version of ``name``: written, then shown or abandoned."""

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        partition_by: Sequence[str] = (),
        external: bool = False,
        cluster_by: tuple[str, int] | None = None,
    ):
        self.spark, self.name, self.partition_by, self.external = spark, name, partition_by, external
        self.cluster_by = cluster_by
        self.version = _fresh_version(name)
        self.rows: int | None = None
        #: Partitions with what tells whether they have changed, ``@`` and the version that holds their files.
        self.parts: dict[str, str] = {}

    def write(self, df: DataFrame) -> None:
        written = Observation()
        rows = df.hint("rebalance", *self.partition_by) if self.partition_by else df
        if self.cluster_by is not None:
            rows = df.repartition(self.cluster_by[1], self.cluster_by[0])  # one file per bucket
        writer = rows.observe(written, F.count(F.lit(1)).alias("rows")).write
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        if self.cluster_by is not None:
            writer = writer.bucketBy(self.cluster_by[1], self.cluster_by[0]).sortBy(self.cluster_by[0])
        if self.external:
            database, _, table = self.version.rpartition(".")
            home = self.spark.catalog.getDatabase(database or self.spark.catalog.currentDatabase()).locationUri
            writer = writer.option("path", f"{home.rstrip('/')}/{table}")
        writer.saveAsTable(self.version)
        self.rows = written.get["rows"]

    def commit(
        self, replacing: str | None = None, wait_seconds: float | None = None, note: Mapping[str, str] | None = None
    ) -> None:
        """Show the version, with ``note`` beside it. With ``replacing`` only if the name still shows that one."""
        with _commit(self.spark, self.name, wait_seconds) as lock:
            if not _leased(self.version):
                raise Conflict(f"{self.version} took longer than its lease")
            shown, properties = current_version(self.spark, self.name), {}
            if replacing is not None and shown != replacing:
                raise Conflict(f"{self.name} shows {shown}, not {replacing}")
            if shown is not None:
                properties = _properties(self.spark, self.name)
            elif self.spark.catalog.tableExists(self.name):
                # A plain table of that name becomes a version.
                shown = _fresh_version(self.name)
                self.spark.sql(f"ALTER TABLE {_sql_name(self.name)} RENAME TO {_sql_name(shown)}")
            lock.check()
            old = {one for one in (properties.get("previous"), *properties.get(_RETAINED, "").split(",")) if one}
            used = self._used(parts_of(properties))
            retained = sorted(one for one in old if one.lower() in used)
            noted = {_NOTE + key: one for key, one in {**(note or {}), "rows": str(self.rows)}.items()}
            noted |= {_PART + key: one for key, one in self.parts.items()} | ({_RETAINED: ",".join(retained)} if retained else {})
            _show(self.spark, self.name, self.version, shown, noted)
            self._clean({one.lower() for one in (self.version, shown) if one is not None}, {one.lower() for one in old}, used)

    def _used(self, shown_parts: Mapping[str, str]) -> dict[str, set[str]]:
        """The partitions that the version and the one before it name, by the version that holds them."""
        used: dict[str, set[str]] = {}
        for parts in (self.parts, shown_parts):
            for part, digest in parts.items():
                used.setdefault(digest.rpartition("@")[2].lower(), set()).add(part)
        return used

    def _clean(self, kept: set[str], replaced: set[str], used: Mapping[str, set[str]]) -> None:
        """Drop versions that were shown before last, and what writers left that have died. Versions at work are leased.

        A version that still holds partitions of the two that stay keeps those, and only those.
        """
        for old in _versions(self.spark, self.name):
            if old.lower() in kept or old.lower() not in replaced and _leased(old):
                continue
            if old.lower() not in used:
                _drop(self.spark, old)
                continue
            folder = external_folder(self.spark, old)
            for part, one in partitions(self.spark, old).items():
                if part not in used[old.lower()]:
                    self.spark.sql(f"ALTER TABLE {_sql_name(old)} DROP IF EXISTS PARTITION ({one.sql})")
                    # Where the partition was only named here, nothing lies below this folder.
                    remove_folder(self.spark, f"{folder}/{one.folder}")

    def abandon(self) -> None:
        """Drop the version, unless it is shown."""
        if current_version(self.spark, self.name) != self.version:
            _drop(self.spark, self.version)


def overwrite_table(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    verify: Callable[[], None] | None = None,
    replacing: str | None = None,
    note: Mapping[str, str] | None = None,
    cluster_by: tuple[str, int] | None = None,
) -> int:
    """Replace rows and schema of ``name`` and return the number of rows that were written.

    The rows go to a table of their own, and when they are complete the view ``name`` is pointed at it.
    So ``df`` may read ``name``, a failed job changes nothing, and readers see the old rows or the new ones. The version
    shown until now stays for readers that are at it and goes with the next replacement; what dead writers left goes when its
    lease is over. ``partition_by`` lays the rows out by these columns; large groups are split over several files. ``verify`` is
    called between both steps and may refuse by raising. Of several writers the last to commit wins; one that has
    computed its rows from the present version can name it as ``replacing`` and gets a ``Conflict`` if another was faster.
    ``note`` is kept with the version that is shown, in the same step; ``note_of`` reads it. ``cluster_by`` is a column and a number
    of buckets: joins and groupings on the column need no shuffle of this table, but rows of one value lie in one bucket.
    """
    replacement = Replacement(df.sparkSession, name, partition_by, cluster_by=cluster_by)
    try:
        replacement.write(df)
        if verify is not None:
            verify()
        replacement.commit(replacing, note=note)
    except BaseException:
        replacement.abandon()
        raise
    return replacement.rows


def _show(spark: SparkSession, name: str, version: str, previous: str | None, noted: Mapping[str, str]) -> None:
    noted = {"version": version, **({"previous": previous} if previous else {}), **noted}
    properties = ", ".join(f"{_text(key)} = {_text(value)}" for key, value in noted.items())
    spark.sql(f"CREATE OR REPLACE VIEW {_sql_name(name)} TBLPROPERTIES ({properties}) AS SELECT * FROM {_sql_name(version)}")


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def note_of(spark: SparkSession, name: str) -> dict[str, str]:
    """What the writer of the version that ``name`` shows has noted, and its ``rows``; empty if there is none."""
    if not _is_view(spark, name):
        return {}
    return {key.removeprefix(_NOTE): one for key, one in _properties(spark, name).items() if key.startswith(_NOTE)}


def external_folder(spark: SparkSession, table: str) -> str | None:
    """Where an external table lies; None for others."""
    if not spark.catalog.tableExists(table) or spark.catalog.getTable(table).tableType != "EXTERNAL":
        return None
    details = {row[0]: row[1] for row in spark.sql(f"DESCRIBE EXTENDED {_sql_name(table)}").collect()}
    return details["Location"].rstrip("/")


def _drop(spark: SparkSession, version: str) -> None:
    """Drop a version with its files."""
    folder = external_folder(spark, version)
    spark.sql(f"DROP TABLE IF EXISTS {_sql_name(version)}")
    if folder is not None:
        remove_folder(spark, folder)


def parts_of(properties: Mapping[str, str]) -> dict[str, str]:
    """The partitions of a shown version as ``Replacement.parts`` has them; none once rows were added to it."""
    if _STALE in properties:
        return {}
    return {key.removeprefix(_PART): one for key, one in properties.items() if key.startswith(_PART)}


@dataclass(frozen=True)
class Partition:
    """A partition of a table in SQL, and the folder it was written to below the table's."""

    sql: str
    folder: str


def partitions(spark: SparkSession, table: str) -> dict[str, Partition]:
    """The partitions of a table by their values as JSON; those without a value are left out."""
    found = {}
    for row in spark.sql(f"SHOW PARTITIONS {_sql_name(table)}").collect():
        pairs = [one.split("=", 1) for one in row[0].split("/")]
        values = [(unquote(name), unquote(value)) for name, value in pairs]
        if all(value != "__HIVE_DEFAULT_PARTITION__" for _, value in values):
            sql = ", ".join(f"{quoted(name)} = {_text(value)}" for name, value in values)
            found[json.dumps([value for _, value in values])] = Partition(sql, row[0])
    return found


def drop_table(spark: SparkSession, name: str) -> None:
    """Remove a view made by ``overwrite_table`` with all its versions."""
    with _commit(spark, name):
        if _is_view(spark, name):
            spark.sql(f"DROP VIEW {_sql_name(name)}")
        for table in _versions(spark, name):
            _drop(spark, table)


def replace_rows(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), note: Mapping[str, str] | None = None
) -> int:
    """Replace the rows of ``name`` but keep its schema; create it on the first run.

    The schema is that of the version shown now, so a writer that replaces it meanwhile makes this one fail.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        return overwrite_table(df, name, partition_by, note=note)
    shown = current_version(spark, name)
    kept = spark.table(shown or name).schema
    missing = {field.name.lower() for field in kept} ^ {column.lower() for column in df.columns}
    if missing:
        raise ValueError(f"columns of the new rows do not fit {name}: {sorted(missing)}")
    fitted = df.select(*[F.col(quoted(field.name)).cast(field.dataType).alias(field.name) for field in kept])
    return overwrite_table(fitted, name, partition_by, replacing=shown, note=note)


def append_rows(df: DataFrame, name: str) -> int:
    """Add rows to ``name``, or to the version it shows; returns their number. No replacement is shown meanwhile."""
    written = Observation()
    with _commit(df.sparkSession, name):
        target = current_version(df.sparkSession, name)
        if target is not None and parts_of(_properties(df.sparkSession, name)):
            df.sparkSession.sql(f"ALTER VIEW {_sql_name(name)} SET TBLPROPERTIES ('{_STALE}' = 'true')")
        target = target or name
        writer = df.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("append")
        if df.sparkSession.catalog.tableExists(target):
            laid_out_by = [one.name for one in df.sparkSession.catalog.listColumns(target) if one.isPartition]
            writer = writer.partitionBy(*laid_out_by) if laid_out_by else writer
        writer.saveAsTable(target)
    return written.get["rows"]


def write_many(
    tables: Mapping[str, DataFrame], degree: int = 10, note: Mapping[str, str] | None = None
) -> list[int]:
    """Overwrite several tables, up to ``degree`` jobs at a time; row counts in mapping order."""
    if not tables:
        return []
    spark = next(iter(tables.values())).sparkSession

    def write(entry: tuple[str, DataFrame]) -> int:
        name, df = entry
        return overwrite_table(trim_names(df), name, note=note)

    with ThreadPoolExecutor(max_workers=min(degree, len(tables))) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(write), entry) for entry in tables.items()]
        return [future.result() for future in futures]
