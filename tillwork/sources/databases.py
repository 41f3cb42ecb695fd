"""Relational tables over JDBC, split into ranges of a key that executors read in parallel."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tillwork.sources.ranges import NTH_LIMIT, NTH_OFFSET, cuts_of, ranges_between
from tillwork.sources.snapshots import Ask, Snapshot, SnapshotSql, take_snapshot

FETCH_ROWS = 10_000


@dataclass(frozen=True)
class Dialect:
    """How one database product is addressed, finds the n-th key and writes a point in time."""

    url: str
    driver: str
    port: int
    nth: str = NTH_OFFSET
    moment: str = "'{value}'"
    escaped_backslash: bool = False


# Source names, default ports and what the products' SQL asks for.
DIALECTS = {
    "mysql": Dialect(
        url="jdbc:mysql://{host}:{port}/{database}",
        driver="com.mysql.cj.jdbc.Driver",
        port=3306,
        nth=NTH_LIMIT,
        escaped_backslash=True,
    ),
    "oracle": Dialect(
        url="jdbc:oracle:thin:@//{host}:{port}/{database}",
        driver="oracle.jdbc.OracleDriver",
        port=1521,
        moment="TIMESTAMP '{value}'",
    ),
    "azuresql": Dialect(
        url="jdbc:sqlserver://{host}:{port};databaseName={database}",
        driver="com.microsoft.sqlserver.jdbc.SQLServerDriver",
        port=1433,
    ),
}


def dialect_of(source: str) -> Dialect:
    if source not in DIALECTS:
        raise ValueError(f"unknown source {source!r}; known: {sorted(DIALECTS)}")
    return DIALECTS[source]


@dataclass(frozen=True)
class RangeSplit:
    """Even ranges of a number, date or timestamp column. Rows outside the bounds are still read."""

    column: str
    lower: object
    upper: object
    parts: int


@dataclass(frozen=True)
class KeySplit:
    """About ``parts`` ranges of a key of any type, cut where the database's own order has its even positions.

    Each range is one index scan of its rows. Rows without a key are in the first range. Equal values share a range, so
    choose a column that is unique or nearly so.
    """

    column: str
    parts: int


@dataclass(frozen=True)
class DatabaseSource:
    """Where a database is. ``options`` holds ``user``, ``password`` and other JDBC options."""

    kind: str
    host: str = ""
    database: str = ""
    port: int | None = None
    url: str | None = None
    options: dict = field(default_factory=dict)

    def jdbc_options(self) -> dict[str, str]:
        dialect = dialect_of(self.kind)
        url = self.url or dialect.url.format(
            host=self.host, port=self.port or dialect.port, database=self.database
        )
        return {"url": url, "driver": dialect.driver, "fetchsize": str(FETCH_ROWS), **self.options}


def key_predicates(split: KeySplit, cuts: Sequence[object], dialect: Dialect) -> list[str]:
    """WHERE clauses that together select every row once."""
    ranges = ranges_between(cuts)
    return [one.where(split.column, dialect.moment, dialect.escaped_backslash) for one in ranges]


def find_cuts(split: KeySplit, ask: Callable[[str], list[tuple]], table: str, dialect: Dialect) -> list[object]:
    return cuts_of(ask, table, split.column, split.parts, dialect.nth, dialect.moment, dialect.escaped_backslash)


def ask_over_jdbc(spark: SparkSession, source: DatabaseSource) -> Ask:
    """Runs a query that gives few rows."""
    options = source.jdbc_options()

    def ask(query: str) -> list[tuple]:
        return [tuple(row) for row in spark.read.format("jdbc").options(query=query, **options).load().collect()]

    return ask


def snapshot_of(spark: SparkSession, source: DatabaseSource, known: dict[str, SnapshotSql] | None = None) -> Snapshot:
    """The present state of ``source`` for all tables of a load; raises where the product has none to read or watch."""
    return take_snapshot(source.kind, ask_over_jdbc(spark, source), known)


def read_table(
    spark: SparkSession,
    source: DatabaseSource,
    table: str,
    split: RangeSplit | KeySplit | None = None,
    snapshot: Snapshot | None = None,
) -> DataFrame:
    """Scan ``table``. Without a split it is read by one task, whatever its size: name a split for all but small tables.

    A ``KeySplit`` asks the database for its cut values first, one short query each. Ranges are read over connections of their
    own: with ``snapshot`` the cuts and all ranges see one state; without, rows that change meanwhile may be missed or read twice.
    """
    options = source.jdbc_options()
    if snapshot is not None:
        table = snapshot.table(table)
    if isinstance(split, KeySplit):
        dialect = dialect_of(source.kind)
        predicates = key_predicates(split, find_cuts(split, ask_over_jdbc(spark, source), table, dialect), dialect)
        properties = {name: value for name, value in options.items() if name != "url"}
        return spark.read.jdbc(options["url"], table, predicates=predicates, properties=properties)
    if isinstance(split, RangeSplit):
        options.update(
            partitionColumn=split.column,
            lowerBound=str(split.lower),
            upperBound=str(split.upper),
            numPartitions=str(split.parts),
        )
    return spark.read.format("jdbc").options(dbtable=table, **options).load()
