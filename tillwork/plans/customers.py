"""Customer, order-month, stock and price figures.

These drop rows whose grouping key is NULL, and a sum over nothing but NULLs is 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwork.functions.measures import mean_of, month_text, sum_or_zero, with_copies


def customer_stats(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Spend, order count and mean order value of each known, named customer with orders.

    Orders are reduced to one row per customer before names are joined. Customer rows that repeat
    an id multiply its figures as a row-by-row join would: all rows of the id multiply the order count, equal rows
    the spend. Customers are placed by id once; the grouping, the total per id and the join use that placement.
    """
    spend = orders.dropna(subset=["customer_id"]).groupBy("customer_id").agg(
        sum_or_zero("total_amount").alias("_spend"),
        F.count("order_id").alias("_orders"),
        mean_of("total_amount").alias("avg_order_value"),
    )
    placed = customers.dropna(subset=["customer_id"]).select("customer_id", "first_name", "last_name").repartition("customer_id")
    names = with_copies(placed, "customer_id", "first_name", "last_name")
    names = names.withColumn("_matches", F.sum("copies").over(Window.partitionBy("customer_id")))
    return (
        spend.join(names.dropna(subset=["first_name", "last_name"]), "customer_id")
        .select(
            "customer_id",
            "first_name",
            "last_name",
            (F.col("_spend") * F.col("copies")).alias("total_spend"),
            (F.col("_orders") * F.col("_matches")).alias("order_count"),
            "avg_order_value",
        )
    )


def with_order_month(orders: DataFrame) -> DataFrame:
    return orders.withColumn("order_month", month_text("order_date"))


def monthly_revenue(orders: DataFrame) -> DataFrame:
    dated = with_order_month(orders).dropna(subset=["order_month"])
    return dated.groupBy("order_month").agg(sum_or_zero("total_amount").alias("monthly_revenue"))


def order_status_counts(orders: DataFrame) -> DataFrame:
    keys = ["order_month", "status"]
    return with_order_month(orders).dropna(subset=keys).groupBy(*keys).count()


def payment_method_counts(orders: DataFrame) -> DataFrame:
    keys = ["order_month", "payment_method"]
    return with_order_month(orders).dropna(subset=keys).groupBy(*keys).count()


def inventory_per_product(products: DataFrame, inventory: DataFrame) -> DataFrame:
    """Every product with its stock over all warehouses; NULL where there is none."""
    stock = inventory.dropna(subset=["product_id"]).groupBy("product_id").agg(
        sum_or_zero("quantity").alias("total_stock")
    )
    return products.select("product_id", "product_name", "category").join(stock, "product_id", "left")


def inventory_per_category(per_product: DataFrame) -> DataFrame:
    return per_product.dropna(subset=["category"]).groupBy("category").agg(
        sum_or_zero("total_stock").alias("category_stock")
    )


def inventory_per_warehouse(inventory: DataFrame) -> DataFrame:
    return inventory.dropna(subset=["warehouse_id"]).groupBy("warehouse_id").agg(
        sum_or_zero("quantity").alias("warehouse_stock")
    )


def product_price_stats(products: DataFrame) -> DataFrame:
    return products.dropna(subset=["category"]).groupBy("category").agg(
        mean_of("price").alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
    )
