"""What the physical plans of the registered queries must and must not contain."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tillwork.operators.joins import left_join_many
from tillwork.plans import customers
from tillwork.plans.driver_tables import DriverTables
from tillwork.session import PARTITION_BYTES, use_scale_settings

FOLDER = os.environ.get("TILLWORK_TEST_DATA", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")

WRITING = {
    "reviews_json_roundtrip", "preferences_xml_roundtrip", "specs_xml_roundtrip", "csv_export_roundtrip",
    "table_write_modes", "nightly_tables", "reviews_json_split", "preferences_xml_split", "changed_partitions", "clustered_orders",
}


def _plan(spark, name):
    return registry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registry._QUERIES) - WRITING))
def test_no_cross_join_and_no_python(spark, name):
    plan = _plan(spark, name)
    assert not re.search(r"CartesianProduct|NestedLoop|PythonUDF|EvalPython|InPandas|InArrow", plan)


@pytest.mark.parametrize("name", ["top_products", "top_categories", "top_customers_by_spend", "top_preferences"])
def test_top_n_is_cut_in_the_tasks(spark, name):
    assert "TakeOrderedAndProject" in _plan(spark, name)


def test_ranks_are_cut_before_the_shuffle(spark):
    assert re.search(r"WindowGroupLimit.*Partial", _plan(spark, "state_category_top3"))


def test_scans_read_only_what_is_used(spark):
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", _plan(spark, "monthly_revenue"))
    assert [len(scan.split(",")) for scan in scans] == [2]
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", _plan(spark, "category_performance"))
    # Labels, then lines for the distinct orders, then lines for the sums.
    assert sorted(len(scan.split(",")) for scan in scans) == [3, 3, 4]


def test_facts_are_aggregated_before_they_are_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(spark, "product_performance")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for path in plan.split("FileScan")[:-1]:
        last_shuffle = path.rindex("Exchange hashpartitioning")
        assert "partial_" in path[last_shuffle:] or "HashAggregate" in path[last_shuffle:]


def test_history_cuts_lines_in_one_scan(spark):
    plan = _plan(spark, "customer_order_history")
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert len(re.findall(r"FileScan parquet \[l_orderkey", plan)) == 1


def test_customer_stats_place_customers_once(spark):
    """One scan and one placement of the customers, one join after the grouping."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stats = customers.customer_stats(
            spark.createDataFrame([("C", "a", "b")], "customer_id string, first_name string, last_name string"),
            spark.createDataFrame([("C", "O", 1)], "customer_id string, order_id string, total_amount int"),
        )
        plan = stats._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Join") == 1
    assert len(re.findall(r"FileScan parquet \[c_custkey", _plan(spark, "customer_stats"))) == 1


@pytest.mark.parametrize("name", ["expectation_results", "validation_record", "validation_sample"])
def test_checks_do_not_read_texts(spark, name):
    assert "documents.parquet" not in _plan(spark, name)


def test_reviewed_products_cut_specifications_before_nesting(spark):
    plan = _plan(spark, "top_reviewed_products")
    nested = plan[plan.index("collect_list"):]
    assert "LeftSemi" in nested


def test_headline_sums_collect_no_values(spark):
    assert "collect_list" not in _plan(spark, "kpi_summary")


def test_the_product_count_skips_the_outer_joins(spark):
    plan = _plan(spark, "kpi_summary")
    products = plan[plan.index("Exchange SinglePartition"):]
    assert "Join" not in products


def test_a_hot_right_key_is_split(spark):
    """A third of the right rows on one key: the inner part is cut into several tasks."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in small}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 1000)
        right = spark.range(0, 300_000, 1, 8).select(hot.alias("key"), F.col("id").alias("value"))
        left = spark.range(0, 1100, 1, 2).select(F.col("id").alias("key"), (F.col("id") * 2).alias("twice"))
        joined = left_join_many(left, right, "key")
        # A grouping on another column follows, as in the real plans.
        total = joined.groupBy(F.col("twice") % 7).agg(F.count("value").alias("n"), F.count(F.lit(1)).alias("rows"))
        found = total.agg(F.sum("n"), F.sum("rows"))
        assert tuple(found.collect()[0]) == (300_000, 300_100)
        assert "SortMergeJoin(skew=true)" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_shuffle_partitions_grow_with_the_input(spark, tmp_path):
    """A task after a shuffle gets no more of a larger input; few configured partitions are no limit."""
    (tmp_path / "documents.parquet").write_bytes(bytes(5 * PARTITION_BYTES + 1))
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        use_scale_settings(spark, str(tmp_path))
        assert spark.conf.get(name) == "6"
        plan = spark.range(9).groupBy(F.col("id") % 5).count()._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"hashpartitioning\(.*, 6\)", plan)
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
    finally:
        spark.conf.unset(name)


def test_source_files_of_the_nightly_run_lie_compressed(spark):
    """They are read once, a file per task, and raw JSON was the largest thing that the run wrote."""
    t = DriverTables(spark, FOLDER)
    for path in (registry._reviews_json(t), registry._preferences_xml(t, "gzip"), registry._specifications_xml(t, "gzip")):
        files = [name for name in os.listdir(path.removeprefix("file:")) if name.startswith("part-")]
        assert files and all(name.endswith(".gz") for name in files)
