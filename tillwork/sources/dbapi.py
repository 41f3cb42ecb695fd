"""Tables over a Python DB-API connection factory, for databases without a JDBC driver.

Executors open their own connections and each reads one range of the key. The factory and its
module have to be importable, and the database reachable, on every executor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tillwork.sources.ranges import NTH_LIMIT, KeyRange, cuts_of, key_ranges, ranges_between
from tillwork.sources.snapshots import Ask, Snapshot

BATCH_ROWS = 10_000


def ask_over(connection) -> Ask:
    """Runs a query on one connection; hold it open as long as its snapshot is watched."""

    def ask(query: str) -> list[tuple]:
        cursor = connection.cursor()
        cursor.execute(query)
        return cursor.fetchall()

    return ask


def _source_class(connect: Callable, table: str, schema: StructType, key: str | None, parts: int, nth: str) -> type:
    columns = ", ".join(schema.fieldNames())

    class Reader(DataSourceReader):
        def partitions(self):
            if key is None or parts < 2:
                return [KeyRange(None, None)]
            connection = connect()
            ask = ask_over(connection)
            try:
                low, high = ask(f"SELECT MIN({key}), MAX({key}) FROM {table}")[0]
                if isinstance(low, int) and isinstance(high, int):
                    return key_ranges(low, high, parts)
                return ranges_between(cuts_of(ask, table, key, parts, nth))
            finally:
                connection.close()

        def read(self, partition: KeyRange) -> Iterator[pa.RecordBatch]:
            arrow = to_arrow_schema(schema)
            where = f" WHERE {partition.where(key)}" if key is not None else ""
            connection = connect()
            try:
                cursor = connection.cursor()
                cursor.execute(f"SELECT {columns} FROM {table}{where}")
                while rows := cursor.fetchmany(BATCH_ROWS):
                    values = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(column), type=kind) for column, kind in zip(values, arrow.types)],
                        schema=arrow,
                    )
            finally:
                connection.close()

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return "dbapi_table"

        def schema(self) -> StructType:
            return schema

        def reader(self, schema: StructType) -> DataSourceReader:
            return Reader()

    return Source


def read_dbapi(
    spark: SparkSession,
    connect: Callable,
    table: str,
    schema: StructType,
    key: str | None = None,
    parts: int = 1,
    nth: str = NTH_LIMIT,
    snapshot: Snapshot | None = None,
) -> DataFrame:
    """Scan ``table`` with ``connect()`` connections, in ``parts`` ranges of ``key``, which may be of any type.

    Without a key one task reads the table. ``nth`` is how the database selects the n-th key. With ``snapshot`` the cuts
    and all ranges see one state.
    """
    if snapshot is not None:
        table = snapshot.table(table)
    spark.dataSource.register(_source_class(connect, table, schema, key, parts, nth))
    return spark.read.format("dbapi_table").load()
