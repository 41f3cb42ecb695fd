"""Order metrics: details, products, categories, states, ranked reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.functions.measures import ratio, with_copies
from tillwork.functions.text import Scorer, with_state
from tillwork.operators.clustering import Clustered, per_part
from tillwork.operators.joins import join_suffix, left_join_many, small_enough
from tillwork.operators.ranking import top_n, top_ranked

# Tags of the two top-n lists.
BY_QUANTITY = "quantity_sold"
BY_REVENUE = "revenue"


def order_details(
    orders: DataFrame,
    order_items: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    extractor: Scorer | None = None,
) -> DataFrame:
    """One row per order line with product, customer, state and line total.

    The state is derived on the customer side, once per customer.
    """
    lines = left_join_many(orders, order_items, "order_id", "_order_items")
    return _described(lines, products, customers, extractor)


def clustered_order_details(
    orders: Clustered,
    order_items: Clustered,
    products: DataFrame,
    customers: DataFrame,
    extractor: Scorer | None = None,
) -> DataFrame:
    """``order_details`` of tables that lie clustered by order: lines and orders meet without a shuffle."""
    cold = join_suffix(orders.cold, order_items.cold, "order_id", "left", "_order_items")
    hot = left_join_many(orders.hot, order_items.hot, "order_id", "_order_items")
    return _described(cold.unionByName(hot), products, customers, extractor)


def _described(lines: DataFrame, products: DataFrame, customers: DataFrame, extractor: Scorer | None) -> DataFrame:
    """Lines with product, customer, state and line total."""
    lines = join_suffix(lines, products, "product_id", "left", "_products")
    placed = with_state(customers, "address", extractor)
    lines = join_suffix(lines, placed, "customer_id", "left", "_customer")
    return lines.withColumn("line_total", F.col("quantity") * F.col("unit_price"))


def customer_order_history(
    orders: DataFrame,
    order_items: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    customer_id,
    extractor: Scorer | None = None,
) -> DataFrame:
    """Order details of one customer, latest first.

    Counting the customer's orders first runs a job, but then the lines are cut down to that
    customer inside the scan tasks. One customer's lines are no skewed table, so a plain left join reads them once.
    """
    own = orders.where(F.col("customer_id") == F.lit(customer_id))
    own_ids = small_enough(own.select("order_id"))
    own_items = order_items.join(own_ids, "order_id", "left_semi").select(*order_items.columns)
    person = customers.where(F.col("customer_id") == F.lit(customer_id))
    lines = join_suffix(own, own_items, "order_id", "left", "_order_items")
    details = _described(lines, products, person, extractor)
    return details.orderBy(F.desc_nulls_last("order_date"), "order_id", "product_id")


def product_performance(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct orders, quantity and revenue per product.

    Lines are aggregated per product id before the join. Items of unknown products keep their id
    with NULL name and category. Distinct orders are counted apart from the sums: their shuffle
    carries (product, order) pairs only, while the sums shrink to a row per product in each task.
    """
    figures = ("total_orders", "_quantity", "_revenue")
    sums = order_items.groupBy("product_id").agg(
        F.sum("quantity").alias("_quantity"),
        F.sum(F.col("unit_price") * F.col("quantity")).alias("_revenue"),
    )
    counts = order_items.groupBy("product_id").agg(F.count_distinct("order_id").alias("total_orders"))
    # One row per product on each side. Grouping the union, unlike a join, also pairs the NULL ids.
    both = sums.unionByName(counts, allowMissingColumns=True)
    sold = both.groupBy("product_id").agg(*[F.max(name).alias(name) for name in figures])
    labels = with_copies(products, "product_id", "product_name", "category")
    copies = F.coalesce("copies", F.lit(1))
    return sold.join(labels, "product_id", "left").select(
        "product_id",
        "product_name",
        "category",
        "total_orders",
        (F.col("_quantity") * copies).alias("total_quantity_sold"),
        (F.col("_revenue") * copies).alias("total_revenue"),
    )


def category_performance(per_product: DataFrame) -> DataFrame:
    """Product figures summed per category; an order counts once for each of its products."""
    return (
        per_product.groupBy("category")
        .agg(*[F.sum(name).alias(name) for name in ("total_orders", "total_quantity_sold", "total_revenue")])
        .withColumn("avg_order_value", ratio(F.col("total_revenue"), F.col("total_orders")))
    )


def _both_tops(df: DataFrame, n: int, key: str) -> DataFrame:
    by_quantity = top_n(df, "total_quantity_sold", n, key).withColumn("metric", F.lit(BY_QUANTITY))
    by_revenue = top_n(df, "total_revenue", n, key).withColumn("metric", F.lit(BY_REVENUE))
    return by_quantity.union(by_revenue).distinct()


def top_selling_products(per_product: DataFrame, n: int = 10) -> DataFrame:
    """The best ``n`` products by quantity and by revenue, told apart by ``metric``."""
    return _both_tops(per_product, n, "product_id")


def top_selling_categories(per_category: DataFrame, n: int = 5) -> DataFrame:
    """The best ``n`` categories by quantity and by revenue, told apart by ``metric``."""
    return _both_tops(per_category, n, "category")


def of_metric(tops: DataFrame, metric: str) -> DataFrame:
    return tops.where(F.col("metric") == metric)


def state_category(
    orders: DataFrame,
    order_items: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    extractor: Scorer | None = None,
) -> DataFrame:
    """Distinct orders, quantity and revenue per state and category.

    Lines are reduced to one row per order and category before they meet the orders, and only the
    state, not the customer, travels with an order.
    """
    return _per_state(_placed_lines(orders, order_items, products, customers, extractor))


def clustered_state_category(
    orders: Clustered,
    order_items: Clustered,
    products: DataFrame,
    customers: DataFrame,
    extractor: Scorer | None = None,
) -> DataFrame:
    """``state_category`` of tables that lie clustered by order; no order is in both parts."""
    return _per_state(
        per_part(lambda sales, items: _placed_lines(sales, items, products, customers, extractor), orders, order_items)
    )


def _placed_lines(
    orders: DataFrame, order_items: DataFrame, products: DataFrame, customers: DataFrame, extractor: Scorer | None
) -> DataFrame:
    """One row per order and category, with the order's state."""
    labels = products.select("product_id", "category")
    lines = order_items.select("order_id", "product_id", "quantity", "unit_price")
    per_order = (
        join_suffix(lines, labels, "product_id")
        .groupBy("order_id", "category")
        .agg(
            F.sum("quantity").alias("_quantity"),
            F.sum(F.col("quantity") * F.col("unit_price")).alias("_revenue"),
        )
    )
    states = with_state(customers.select("customer_id", "address"), "address", extractor)
    placed = orders.select("order_id", "customer_id").join(
        states.select("customer_id", "state"), "customer_id", "left"
    )
    return placed.join(per_order, "order_id", "left")


def _per_state(lines: DataFrame) -> DataFrame:
    return (
        lines.groupBy("state", "category")
        .agg(
            F.count_distinct("order_id").alias("order_count"),
            F.sum("_quantity").alias("total_quantity"),
            F.sum("_revenue").alias("total_revenue"),
        )
        .withColumn("avg_order_value", ratio(F.col("total_revenue"), F.col("order_count")))
    )


def state_category_top(per_state: DataFrame, depth: int = 3) -> DataFrame:
    """The states with the highest revenue in each category, ties included."""
    return top_ranked(per_state, "category", "total_revenue", depth)
