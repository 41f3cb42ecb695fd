"""Order, customer and gold figures against plain Python, join first and aggregate second."""

from collections import defaultdict
from decimal import Decimal

import pytest
import shop as data
from pyspark.sql import functions as F

from tillwork.functions.text import place_of
from tillwork.plans import customers, gold, orders, reports, silver


@pytest.fixture
def shop(spark):
    return data.Shop(spark)


def _products():
    return {row[0]: row for row in data.PRODUCTS}


def _lines():
    """order id, product id, name, category, quantity, price of each item."""
    for order, product, quantity, price in data.ITEMS:
        known = _products().get(product, (None, None, None, None))
        yield order, product, known[1], known[2], quantity, Decimal(price)


STATES = {"C1": "Austin", "C2": "Boston", "C3": None, "C4": "Denver", "C5": "Austin"}


def test_order_details_keep_orders_without_items(shop, rows):
    details = orders.order_details(shop.orders, shop.items, shop.products, shop.customers)
    expected = []
    for order, customer, *_ in data.ORDERS:
        lines = [line for line in _lines() if line[0] == order] or [(order, None, None, None, None, None)]
        for _, product, name, category, quantity, price in lines:
            total = None if quantity is None else quantity * price
            expected.append((order, customer, product, name, category, quantity, STATES.get(customer), total))
    found = rows(details, "order_id", "customer_id", "product_id", "product_name", "category", "quantity", "state", "line_total")
    assert found == sorted(expected, key=lambda row: [(value is not None, str(value)) for value in row])
    assert {"order_id_order_items", "product_id_products", "customer_id_customer"} <= set(details.columns)


def test_order_history_is_one_customer_latest_first(shop):
    history = orders.customer_order_history(shop.orders, shop.items, shop.products, shop.customers, "C1")
    assert [row.order_id for row in history.collect()] == ["O2", "O2", "O1", "O1", "O1"]
    assert orders.customer_order_history(
        shop.orders, shop.items, shop.products, shop.customers, "C5"
    ).select("order_id", "product_id", "state").collect() == [("O7", None, "Austin")]


def _performance():
    groups = defaultdict(lambda: [set(), 0, Decimal(0)])
    for order, product, name, category, quantity, price in _lines():
        group = groups[product, name, category]
        group[0].add(order)
        group[1] += quantity
        group[2] += quantity * price
    return {key: (len(found), quantity, revenue) for key, (found, quantity, revenue) in groups.items()}


def test_product_performance(shop):
    found = orders.product_performance(shop.items, shop.products).collect()
    assert {tuple(row[:3]): tuple(row[3:]) for row in found} == _performance()
    assert len(found) == len(_performance())


def test_product_performance_with_a_repeated_product_row(spark, shop):
    doubled = shop.products.union(shop.products.where("product_id = 'P1'")).union(
        shop.products.where("product_id = 'P3'").withColumn("product_name", F.lit("Other"))
    )
    joined = shop.items.join(doubled, "product_id", "left").groupBy("product_id", "product_name", "category").agg(
        F.count_distinct("order_id"), F.sum("quantity"), F.sum(F.col("unit_price") * F.col("quantity"))
    )
    found = orders.product_performance(shop.items, doubled)
    assert sorted(map(str, found.collect())) == sorted(map(str, joined.toDF(*found.columns).collect()))


def test_category_performance_counts_an_order_per_product(shop):
    expected = defaultdict(lambda: [0, 0, Decimal(0)])
    for (_, _, category), figures in _performance().items():
        expected[category] = [a + b for a, b in zip(expected[category], figures)]
    found = orders.category_performance(orders.product_performance(shop.items, shop.products))
    for row in found.collect():
        assert [row.total_orders, row.total_quantity_sold, row.total_revenue] == expected[row.category]
        assert row.avg_order_value == float(row.total_revenue) / row.total_orders
    assert found.count() == len(expected)


def test_ratio_of_zero_orders_is_null(spark):
    per_product = spark.createDataFrame(
        [("P", "n", "c", 0, 1, 2.0)],
        "product_id string, product_name string, category string, total_orders bigint, total_quantity_sold bigint, total_revenue double",
    )
    assert orders.category_performance(per_product).first().avg_order_value is None


def test_top_products_break_ties_by_key_and_carry_tags(shop):
    tops = orders.top_selling_products(orders.product_performance(shop.items, shop.products), 2)
    by_quantity = orders.of_metric(tops, orders.BY_QUANTITY).collect()
    assert sorted((row.product_id, row.total_quantity_sold) for row in by_quantity) == [("P6", 6), ("PX", 5)]
    by_revenue = orders.of_metric(tops, orders.BY_REVENUE).collect()
    assert sorted(row.product_id for row in by_revenue) == ["P2", "P6"]


def test_union_of_tops_is_distinct(spark):
    tops = spark.createDataFrame(
        [("A", 1, 5, 2.0), ("A", 1, 5, 2.0), ("B", 1, 1, 1.0)],
        "category string, total_orders int, total_quantity_sold int, total_revenue double",
    )
    assert orders.top_selling_categories(tops, 2).count() == 2


def _state_category():
    groups = defaultdict(lambda: [set(), None, None])
    for order, customer, *_ in data.ORDERS:
        lines = [line for line in _lines() if line[0] == order] or [(order, None, None, None, None, None)]
        for _, _, _, category, quantity, price in lines:
            group = groups[STATES.get(customer), category]
            group[0].add(order)
            if quantity is not None:
                group[1] = (group[1] or 0) + quantity
                group[2] = (group[2] or 0) + quantity * price
    return {key: (len(found), quantity, revenue) for key, (found, quantity, revenue) in groups.items()}


def test_state_category(shop):
    found = orders.state_category(shop.orders, shop.items, shop.products, shop.customers)
    assert {tuple(row[:2]): tuple(row[2:5]) for row in found.collect()} == _state_category()


def test_state_category_equals_the_join_of_all_rows_when_keys_repeat(shop):
    many_orders = shop.orders.union(shop.orders.where("order_id = 'O1'"))
    many_products = shop.products.union(shop.products.where("product_id = 'P3'"))
    many_customers = shop.customers.union(shop.customers.where("customer_id = 'C1'"))
    details = orders.order_details(many_orders, shop.items, many_products, many_customers)
    plain = details.groupBy("state", "category").agg(
        F.count_distinct("order_id"), F.sum("quantity"), F.sum("line_total")
    )
    found = orders.state_category(many_orders, shop.items, many_products, many_customers).drop("avg_order_value")
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.toDF(*found.columns).collect()))


def test_tied_ranks_all_stay(spark):
    df = spark.createDataFrame(
        [("c", "s1", 9.0), ("c", "s2", 9.0), ("c", "s3", 8.0), ("c", "s4", 8.0), ("c", "s5", 7.0), (None, "s6", 1.0)],
        "category string, state string, total_revenue double",
    )
    found = orders.state_category_top(df)
    assert sorted(row.state for row in found.collect()) == ["s1", "s2", "s3", "s4", "s6"]
    assert "rank" not in found.columns


def test_customer_insights(shop, rows):
    sales = silver.silver_orders(shop.orders, shop.customers)
    found = gold.customer_insights(shop.customers, sales).collect()
    figures = {row.customer_id: (row.state, row.total_orders, row.total_spent, row.avg_order_value) for row in found}
    assert figures == {
        "C1": ("Austin", 2, Decimal("70.00"), 35.0),
        "C2": ("Boston", 1, Decimal("75.25"), 75.25),
        "C3": (None, 1, Decimal("12.00"), 12.0),
        "C4": (None, 0, None, None),
        "C5": ("Austin", 1, None, None),
    }
    assert {row.customer_id: row.last_order_date for row in found}["C1"].month == 6


def test_customer_insights_with_a_repeated_customer_row(shop):
    doubled = shop.customers.union(shop.customers.where("customer_id = 'C1'"))
    sales = silver.silver_orders(shop.orders, shop.customers)
    row = gold.customer_insights(doubled, sales).where("customer_id = 'C1'").first()
    assert (row.total_orders, row.total_spent, row.avg_order_value) == (4, Decimal("140.00"), 35.0)


REVIEWS_DDL = (
    "product_id string, review_id string, customer_id string, rating decimal(38,0), title string, content string, "
    "review_date date, verified_purchase string, sentiment_score string, aspects array<struct<name:string,rating:double>>"
)


def _reviews(spark):
    def one(product, review, rating, verified, label, aspects, content="c"):
        return (product, review, "C", Decimal(rating), "t", content, None, verified, label, aspects)

    return spark.createDataFrame(
        [
            one("P1", "R1", 5, "true", "Positive", [("Quality", 4.0), ("Quality", 2.0), ("Battery Life", 3.0)]),
            one("P1", "R1", 5, "true", "Positive", [("Quality", 5.0)]),
            one("P1", "R2", 2, "false", "Negative", [("Other", 1.0)], None),
            one("P1", "R3", 1, "true", "Neutral", []),
            one("P1", "R4", 1, "true", "Neutral", None),
            one("P2", "R5", 4, "TRUE", "Neutral", [("Value for Money", 2.5), (None, 9.0)], ""),
        ],
        REVIEWS_DDL,
    )


def test_review_pivot_equals_explode_and_pivot(spark):
    reviews = _reviews(spark)
    keys = [name for name in reviews.columns if name != "aspects"]
    plain = (
        reviews.select(*keys, F.inline("aspects").alias("aspect_name", "aspect_rating"))
        .groupBy(*keys)
        .pivot("aspect_name", list(gold.ASPECTS))
        .agg(F.max("aspect_rating"))
    )
    found = gold.review_aspects(reviews).select(*plain.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
    assert gold.review_aspects(reviews, outer=True).count() == found.count() + 2


def test_review_analytics(spark):
    found = {row.product_id: row for row in gold.review_analytics(_reviews(spark)).collect()}
    first = found["P1"]
    assert (first.avg_rating, first.total_reviews, first.verified_reviews) == (3.5, 2, 1)
    assert (first.avg_quality_rating, first.avg_battery_rating, first.avg_value_rating) == (5.0, 3.0, None)
    assert (first.positive_reviews, first.negative_reviews) == (1, 1)
    assert (found["P2"].total_reviews, found["P2"].verified_reviews, found["P2"].avg_value_rating) == (1, 0, 2.5)


def test_product_performance_by_month(shop):
    nested = silver.nested_specifications(shop.specifications)
    goods = silver.silver_products(shop.products, nested)
    metrics = gold.monthly_metrics(shop.items, shop.orders)
    found = gold.product_performance_by_month(goods, metrics).collect()
    figures = {
        (row.product_id, row.order_month and row.order_month.strftime("%Y-%m")): (row.total_orders, row.total_sales)
        for row in found
    }
    assert figures == {
        ("P1", "2024-05"): (2, Decimal("31.00")),
        ("P1", "2024-06"): (1, Decimal("10.00")),
        ("P2", "2024-05"): (1, Decimal("99.99")),
        ("P3", "2024-05"): (1, Decimal("25.50")),
        ("P3", "2024-07"): (1, Decimal("51.00")),
        ("P4", "2024-05"): (1, Decimal("3.00")),
        ("P5", None): (None, None),
        ("P6", "2024-07"): (1, Decimal("225.50")),
        ("P6", None): (1, Decimal("45.10")),
    }
    assert len(found) == len(figures)
    lamp = next(row for row in found if row.product_id == "P1")
    assert [tuple(one) for one in lamp.specifications] == [
        ("Battery Life", "12 hours"), ("STORAGE", "64 GB"), ("battery life", "9 hours"),
    ]


def test_silver_keeps_the_clashing_key(shop):
    people = silver.silver_customers(shop.customers, silver.nested_preferences(shop.preferences))
    found = {row.customer_id: row for row in people.collect()}
    assert people.columns[-2:] == ["customer_id_right", "preferences"]
    assert [tuple(one) for one in found["C1"].preferences] == [("Channel", "Mail"), ("Colour", "Red"), ("Colour", "Red")]
    assert found["C3"].preferences is None and found["C3"].customer_id_right is None
    assert {row.customer_id: row.state for row in shop.customers.select(
        "customer_id", place_of(F.col("address")).alias("state")).collect()} == STATES


def test_customer_stats_drop_null_keys(shop, rows):
    found = rows(customers.customer_stats(shop.customers, shop.orders))
    assert found == [
        ("C1", "Ann", "Ames", Decimal("70.00"), 2, 35.0),
        ("C2", "Bob", "Burr", Decimal("75.25"), 1, 75.25),
        ("C5", "Eve", "East", Decimal("0.00"), 1, None),
    ]


def test_customer_stats_with_two_names_for_an_id(shop, rows):
    second = shop.customers.where("customer_id = 'C1'").withColumn("first_name", F.lit("Anna"))
    found = customers.customer_stats(shop.customers.union(second), shop.orders).where("customer_id = 'C1'")
    assert rows(found) == [
        ("C1", "Ann", "Ames", Decimal("70.00"), 4, 35.0), ("C1", "Anna", "Ames", Decimal("70.00"), 4, 35.0),
    ]


def test_monthly_figures(shop, rows):
    assert rows(customers.monthly_revenue(shop.orders)) == [
        ("2024-05", Decimal("125.25")), ("2024-06", Decimal("20.00")), ("2024-07", Decimal("23.00")),
    ]
    assert rows(customers.order_status_counts(shop.orders)) == [
        ("2024-05", "Pending", 2), ("2024-05", "Shipped", 1), ("2024-06", "Shipped", 1),
        ("2024-07", "Cancelled", 1), ("2024-07", "Pending", 1),
    ]
    assert rows(customers.payment_method_counts(shop.orders)) == [
        ("2024-05", "Card", 3), ("2024-06", "PayPal", 1), ("2024-07", "Card", 2),
    ]


def test_stock(shop, rows):
    per_product = customers.inventory_per_product(shop.products, shop.inventory)
    assert rows(per_product, "product_id", "total_stock") == [
        ("P1", 12), ("P2", 0), ("P3", 4), ("P4", None), ("P5", None), ("P6", None),
    ]
    assert rows(customers.inventory_per_category(per_product)) == [("Home", 12), ("Office", 4), ("Toys", 0)]
    assert rows(customers.inventory_per_warehouse(shop.inventory)) == [("W1", 5), ("W2", 16), ("W3", 3)]


def test_price_stats(shop):
    found = {row.category: row for row in customers.product_price_stats(shop.products).collect()}
    assert set(found) == {"Home", "Office", "Toys"}
    assert found["Home"].avg_price == float(Decimal("155.09")) / 3
    assert (found["Home"].min_price, found["Home"].max_price) == (Decimal("10.00"), Decimal("99.99"))


def test_spec_reports(shop, rows):
    numbers = reports.with_spec_numbers(reports.spec_pivot(shop.products, shop.specifications))
    found = {row.product_id: row for row in numbers.collect()}
    assert len(found) == len(data.PRODUCTS)
    # The largest text, not the largest number.
    assert (found["P1"].battery_life, found["P1"].battery_life_hours, found["P1"].storage_gb) == ("9 hours", 9.0, 64.0)
    assert (found["P2"].storage, found["P2"].storage_gb) == ("none", None)
    assert [row.product_id for row in reports.ranked_spec(numbers, "storage_gb").collect()] == ["P1"]


def test_specification_rows_from_text_and_array(spark, shop, rows):
    nested = silver.nested_specifications(shop.specifications)
    as_text = nested.withColumn("specifications", F.to_json("specifications"))
    assert rows(reports.specification_rows(as_text)) == rows(reports.specification_rows(nested))
    assert reports.specification_rows(nested).count() == len(data.SPECIFICATIONS)


def test_preference_reports(shop, rows):
    assert rows(reports.preference_counts(shop.preferences)) == [
        (None, 1), ("A - B", 1), ("Channel - Mail", 1), ("Colour - Red", 2),
    ]
    assert reports.top_preferences(shop.preferences, 1).collect() == [("Colour - Red", 2)]


def test_kpis_describe_the_listed_categories(spark, shop):
    listed = spark.createDataFrame(
        [("A", 2, 10.0, 5.0), (None, 1, 4.5, 4.5)],
        "category string, total_orders bigint, total_revenue double, avg_order_value double",
    )
    performance = shop.products.select("product_id")
    found = {row.kpi: row.value for row in reports.kpi_summary(listed, performance.union(performance)).collect()}
    assert found == {"total_revenue": 14.5, "total_orders": 3.0, "avg_order_value": 4.75, "total_products": 6.0}


def test_top_reviewed_products(spark, shop):
    figures = spark.createDataFrame(
        [(f"P{n}", 4.0, 10 - n // 2, 1, 0) for n in range(1, 9)],
        "product_id string, avg_rating double, total_reviews int, positive_reviews int, negative_reviews int",
    )
    found = reports.top_reviewed_products(figures, shop.products, shop.specifications, 7).collect()
    assert [row.product_id for row in found] == ["P1", "P2", "P3", "P4", "P5", "P6", "P7"]
    assert [row.product_name for row in found] == ["Lamp", "Desk", "Mouse", "Ghost", "Unsold", "Rug", None]


def test_treemap_filters_before_it_ranks(spark):
    df = spark.createDataFrame(
        [("s", "c", 1.0), (None, "c", 9.0), ("s", None, 9.0), ("s", "d", 0.0), ("t", "c", None)],
        "state string, category string, total_revenue double",
    )
    assert reports.state_revenue_treemap(df).collect() == [("s", "c", 1.0)]
