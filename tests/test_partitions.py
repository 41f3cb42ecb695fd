"""Partitioned tables: only changed partitions are written, and what is named stays readable."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillwork.sinks import partitions, tables
from tillwork.sinks.partitions import overwrite_partitions
from tillwork.sinks.tables import append_rows, current_version, drop_table, overwrite_table


def months(spark, changed=(), count=6, extra=()):
    """Rows of several months, some without one; values of the changed months differ."""
    rows = [(k, dt.datetime(2024, 1 + k % count, 1), f"v{k}{'!' if k % count in changed else ''}", [k]) for k in range(60)]
    return spark.createDataFrame([*rows, (900, None, "no month", []), *extra], "id int, month timestamp_ntz, text string, list array<int>").repartition(3)


@pytest.fixture
def written(monkeypatch):
    """The months that each write of a version has written."""
    found, write = [], tables.Replacement.write

    def noting(self, df):
        found.append(sorted(str(row[0])[:7] for row in df.select("month").distinct().collect()))
        write(self, df)

    monkeypatch.setattr(tables.Replacement, "write", noting)
    return found


def shown(spark, rows, name):
    return rows(spark.table(name).select("id", F.col("month").cast("string"), "text", F.col("list").cast("string")))


def test_one_changed_month_is_one_written_partition(spark, rows, written):
    name = "monthly"
    whole = overwrite_partitions(months(spark), name, ("month",))
    assert whole == 61 and len(written[-1]) == 7
    for changed in ([2], [2, 4], [], [5]):
        df = months(spark, changed)
        before = spark.table(name).where("id >= 0")
        expected_before = shown(spark, rows, name)
        assert overwrite_partitions(df, name, ("month",)) == 61
        plain = rows(df.select("id", F.col("month").cast("string"), "text", F.col("list").cast("string")))
        assert shown(spark, rows, name) == plain
        # Who reads the version before is not cut off.
        assert rows(before.select("id", F.col("month").cast("string"), "text", F.col("list").cast("string"))) == expected_before
    assert written[1:] == [["2024-03", "None"], ["2024-05", "None"], ["2024-03", "2024-05", "None"], ["2024-06", "None"]]
    march = spark.table(name).where("month = timestamp_ntz'2024-03-01 00:00:00'")
    assert "PartitionFilters: [isnotnull(month" in march._jdf.queryExecution().executedPlan().toString() and march.count() == 10
    drop_table(spark, name)


def test_months_come_and_go(spark, rows, written):
    name = "coming"
    overwrite_partitions(months(spark), name, ("month",))
    more = months(spark, extra=[(901, dt.datetime(2025, 1, 1), "new", None)])
    assert overwrite_partitions(more, name, ("month",)) == 62 and written[-1] == ["2025-01", "None"]
    fewer = more.where("month >= timestamp_ntz'2024-04-01 00:00:00'")
    assert overwrite_partitions(fewer, name, ("month",)) == fewer.count() and written[-1] == []
    assert shown(spark, rows, name) == rows(fewer.select("id", F.col("month").cast("string"), "text", F.col("list").cast("string")))
    drop_table(spark, name)


def test_repeated_and_reordered_rows(spark, written):
    name = "repeated"
    df = months(spark)
    overwrite_partitions(df, name, ("month",))
    overwrite_partitions(df.orderBy(F.desc("id")).coalesce(1), name, ("month",))
    assert written[-1] == ["None"]
    twice = df.unionAll(df.where("id = 7"))
    assert overwrite_partitions(twice, name, ("month",)) == 62 and written[-1] == ["2024-02", "None"]
    assert spark.table(name).where("id = 7").count() == 2
    drop_table(spark, name)


def test_old_files_go_when_nothing_names_them(spark, rows):
    name = "filed"
    overwrite_partitions(months(spark), name, ("month",))
    home = current_version(spark, name)
    folder = tables.external_folder(spark, home)
    fs = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def present():
        return sorted(one.getPath().getName()[6:13] for one in fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(folder)) if "month=2" in one.getPath().getName())

    for changed in range(5):
        overwrite_partitions(months(spark, range(changed + 1)), name, ("month",))
    # The last two versions name the months that have not changed, or changed last.
    assert present() == ["2024-05", "2024-06"]
    for _ in range(3):
        overwrite_partitions(months(spark, range(6)), name, ("month",))
    assert not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(folder)) and not spark.catalog.tableExists(home)
    assert spark.table(name).count() == 61
    drop_table(spark, name)
    assert tables._versions(spark, name) == []


def test_other_columns_appends_and_plain_writes_start_afresh(spark, written):
    name = "afresh"
    overwrite_partitions(months(spark), name, ("month",))
    overwrite_partitions(months(spark).withColumn("more", F.lit(1)), name, ("month",))
    assert len(written[-1]) == 7 and spark.table(name).where("more = 1").count() == 61
    append_rows(spark.table(name).where("id = 3"), name)
    assert overwrite_partitions(months(spark).withColumn("more", F.lit(1)), name, ("month",)) == 61
    assert len(written[-1]) == 7 and spark.table(name).count() == 61
    overwrite_table(months(spark), name, ("month",))
    overwrite_partitions(months(spark), name, ("month",))
    assert len(written[-1]) == 7 and spark.table(name).count() == 61
    drop_table(spark, name)


def test_ignored_columns_do_not_make_a_difference(spark, written):
    for night in range(2):
        overwrite_partitions(months(spark).withColumn("loaded", F.lit(night)), "loaded_at", ("month",), ignored=("loaded",))
    assert written[-1] == ["None"]


def test_a_writer_overtaken_compares_again(spark, rows, monkeypatch):
    name = "overtaken"
    overwrite_partitions(months(spark), name, ("month",))
    link, calls = partitions._link, []

    def overtaken(replacement, same):
        link(replacement, same)
        calls.append(len(same))
        if len(calls) == 1:
            for changed in (range(6), range(3)):
                overwrite_table(months(spark, changed), name, ("month",))

    monkeypatch.setattr(partitions, "_link", overtaken)
    assert overwrite_partitions(months(spark, [1]), name, ("month",)) == 61
    assert calls == [5, 0]
    assert shown(spark, rows, name) == rows(months(spark, [1]).select("id", F.col("month").cast("string"), "text", F.col("list").cast("string")))
    drop_table(spark, name)


def test_texts_that_folders_escape(spark, rows, written):
    """Two columns, with signs that folder names cannot hold, empty and missing values."""
    data = [(k, value, k % 2) for k, value in enumerate(["a/b", "a=b", "it's", "50%", "é : x", "", None, "a b", "a\\b"] * 2)]
    df = spark.createDataFrame(data, "id int, month string, odd int")
    for _ in range(2):
        assert overwrite_partitions(df, "escaped", ("month", "odd")) == len(data)
        assert rows(spark.table("escaped").select("id", F.nullif("month", F.lit("")), "odd")) == rows(df.select("id", F.nullif("month", F.lit("")), "odd"))
    assert set(written[-1]) == {"", "None"}
    drop_table(spark, "escaped")
