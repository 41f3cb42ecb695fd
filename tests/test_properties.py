"""Rules that hold for any input, checked on generated cases."""

import contextlib
import sqlite3
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwork.operators.joins import join_suffix, left_join_many
from tillwork.plans.orders import product_performance
from tillwork.sources.ranges import NTH_LIMIT, cuts_of, key_ranges, ranges_between

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@given(st.integers(-50, 50), st.integers(0, 80), st.integers(1, 12))
def test_key_ranges_hold_every_key_once(low, span, parts):
    ranges = key_ranges(low, low + span, parts)
    for key in range(low - 2, low + span + 3):
        inside = [
            one for one in ranges
            if (one.low is None or key >= one.low) and (one.high is None or key < one.high)
        ]
        assert len(inside) == 1


ANY_KEYS = st.one_of(
    st.lists(st.one_of(st.none(), st.text("ab'\\é% ", max_size=3)), max_size=30),
    st.lists(st.one_of(st.none(), st.integers(-5, 5)), max_size=30),
    st.lists(st.one_of(st.none(), st.floats(-2, 2, width=16)), max_size=30),
    st.lists(st.one_of(st.none(), st.dates().map(str)), max_size=30),
)


@given(ANY_KEYS, st.integers(1, 7))
def test_cut_ranges_hold_every_row_once(keys, parts):
    """NULL keys, repeated keys and keys with quotes too, by the database's own order."""
    with contextlib.closing(sqlite3.connect(":memory:")) as connection:
        connection.execute("CREATE TABLE t (k, n INTEGER)")
        connection.executemany("INSERT INTO t VALUES (?, ?)", [(key, n) for n, key in enumerate(keys)])

        def ask(query):
            return connection.execute(query).fetchall()

        ranges = ranges_between(cuts_of(ask, "t", "k", parts, NTH_LIMIT))
        assert len(ranges) <= parts
        found = [row[0] for one in ranges for row in ask(f"SELECT n FROM t WHERE {one.where('k')}")]
        assert sorted(found) == list(range(len(keys)))


KEY = st.one_of(st.none(), st.integers(1, 4))


@FEW
@given(st.lists(KEY, max_size=6), st.lists(st.tuples(KEY, st.integers(0, 3)), max_size=12))
def test_left_join_many_is_a_left_join(spark, left_keys, right_rows):
    left = spark.createDataFrame(list(enumerate(left_keys)), "n int, id int")
    right = spark.createDataFrame(right_rows, "id int, v int")
    plain, split = join_suffix(left, right, "id"), left_join_many(left, right, "id")
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))


ITEMS = T.StructType(
    [
        T.StructField("order_id", T.IntegerType()), T.StructField("product_id", T.IntegerType()),
        T.StructField("quantity", T.IntegerType()), T.StructField("unit_price", T.DecimalType(12, 2)),
    ]
)
PRICE = st.one_of(st.none(), st.integers(0, 500).map(lambda cents: Decimal(cents) / 100))
LABEL = st.one_of(st.none(), st.sampled_from("ab"))


@FEW
@given(
    st.lists(st.tuples(KEY, KEY, st.one_of(st.none(), st.integers(1, 3)), PRICE), max_size=12),
    st.lists(st.tuples(KEY, LABEL, LABEL), max_size=6),
)
def test_product_performance_is_join_then_aggregate(spark, items, products):
    lines = spark.createDataFrame(items, ITEMS)
    goods = spark.createDataFrame(products, "product_id int, product_name string, category string")
    plain = (
        lines.join(goods, "product_id", "left")
        .groupBy("product_id", "product_name", "category")
        .agg(F.count_distinct("order_id"), F.sum("quantity"), F.sum(F.col("unit_price") * F.col("quantity")))
    )
    found = product_performance(lines, goods)
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.toDF(*found.columns).collect()))
