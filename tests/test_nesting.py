from collections import Counter

from pyspark.sql import functions as F

from tillwork.operators.nesting import child_digests, nest_children
from tillwork.plans import silver

FIELDS = {"kind": "TYPE", "val": "VALUE"}


def _children(spark, data):
    return spark.createDataFrame(data, "id string, kind string, val string")


def test_every_key_has_one_sorted_array(spark):
    data = [("a", "y", "2"), ("a", "x", "1"), ("a", "x", "1"), ("b", "z", None), (None, "n", "n")]
    nested = nest_children(_children(spark, data), "id", FIELDS, "out")
    found = {row["id"]: [tuple(one) for one in row["out"]] for row in nested.collect()}
    assert found == {"a": [("x", "1"), ("x", "1"), ("y", "2")], "b": [("z", None)]}


def test_a_hot_key_is_whole(spark):
    hot = [("hot", f"k{n}", str(n)) for n in range(7000)] + [("hot", "same", "copy")] * 4500
    data = hot + [("cold", "c", str(n)) for n in range(20)] + [(None, "n", "n")] * 30
    rows = nest_children(_children(spark, data).repartition(6), "id", FIELDS, "out").collect()
    assert sorted(row["id"] for row in rows) == ["cold", "hot"]
    found = Counter((row["id"], one["TYPE"], one["VALUE"]) for row in rows for one in row["out"])
    assert found == Counter(row for row in data if row[0] is not None)


def test_no_parent_with_children_has_a_null_array(spark):
    """400 children of 20 customers: every child is in its parent's row."""
    children = spark.createDataFrame(
        [(n % 20, f"t{n}", "v") for n in range(400)], "customer_id int, preference_type string, preference_value string"
    )
    customers = spark.createDataFrame([(n,) for n in range(25)], "customer_id int")
    rows = silver.silver_customers(customers, silver.nested_preferences(children)).collect()
    assert len(rows) == 25
    assert {row["customer_id"]: len(row["preferences"] or ()) for row in rows} == {n: 20 if n < 20 else 0 for n in range(25)}
    assert all((row["preferences"] is None) == (row["customer_id"] >= 20) for row in rows)


def test_equal_children_travel_counted(spark):
    plan = nest_children(_children(spark, [("a", "x", "1")]), "id", FIELDS, "out")._jdf.queryExecution().executedPlan().toString()
    first_exchange = plan.rindex("Exchange hashpartitioning")
    assert "partial_count" in plan[first_exchange:]


def test_digests_tell_the_children_of_a_hot_key(spark):
    data = [("hot", f"k{n % 900}", str(n % 7)) for n in range(6000)] + [("cold", "c", None), ("other", "c", ""), (None, "n", "n")]
    fields = ("kind", "val")

    def digests(rows, parts):
        df = _children(spark, rows).repartition(parts, F.rand(parts))
        return {row["id"]: (row["n"], row["out"]) for row in child_digests(df, "id", fields, "out").collect()}

    found = digests(data, 3)
    assert found == digests(data[::-1], 7) and {key: n for key, (n, _) in found.items()} == {"hot": 6000, "cold": 1, "other": 1}
    assert digests(data[1:], 3)["hot"] != found["hot"] and digests([*data[1:], ("hot", "k0", "1")], 3)["hot"] != found["hot"]
    plan = child_digests(_children(spark, data), "id", fields, "out")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_sum" in plan


def test_hot_preferences_are_all_in_five_arrays(spark):
    """The whole table under five customers: an order-free sum over a third of it would be a smaller job."""
    import __spark_entry__ as registry

    folder = "/root/testdata/sf0.001"
    rows = registry.queries()["silver_preferences_hot_key"](spark, folder).collect()
    assert [row["customer_id"] for row in sorted(rows)] == [1, 2, 3, 4, 5]
    assert sum(row["n"] for row in rows) == spark.read.parquet(f"{folder}/conversations.parquet").count()
    assert all(len(row["preferences_sha256"]) == 64 for row in rows)
