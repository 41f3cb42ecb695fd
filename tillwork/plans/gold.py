"""Gold layer: customer insights, review analytics, monthly product performance.

Facts are aggregated before they meet a dimension, so a key that holds much of the rows is
reduced inside the map tasks and never travels as a whole.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions.measures import RATING_TYPE, mean_of, month_start, with_copies
from tillwork.operators.clustering import Clustered, per_part
from tillwork.operators.joins import join_suffix

# Rated aspects and the columns they become.
ASPECTS = {
    "Battery Life": "avg_battery_rating",
    "Quality": "avg_quality_rating",
    "Value for Money": "avg_value_rating",
}

# The columns that tell reviews apart.
_REVIEW_COLUMNS = (
    "product_id", "review_id", "customer_id", "rating", "title", "content", "review_date",
    "verified_purchase", "sentiment_score",
)


def customer_insights(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Order figures per customer and state; customers without orders count 0 orders."""
    per_customer = orders.groupBy("customer_id", "state").agg(
        F.count("order_id").alias("_orders"),
        F.sum("total_amount").alias("_spent"),
        mean_of("total_amount").alias("avg_order_value"),
        F.max(F.col("order_date").cast("timestamp_ntz")).alias("last_order_date"),
    )
    known = with_copies(customers, "customer_id")
    return known.join(per_customer, "customer_id", "left").select(
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("state").cast("string").alias("state"),
        F.coalesce(F.col("_orders") * F.col("copies"), F.lit(0)).alias("total_orders"),
        (F.col("_spent") * F.col("copies")).alias("total_spent"),
        "avg_order_value",
        "last_order_date",
        F.current_timestamp().alias("last_updated"),
    )


def _best_rating(aspect: str) -> Column:
    """The highest rating a review's own array gives to ``aspect``."""
    named = F.filter("aspects", lambda one: one["name"] == F.lit(aspect))
    return F.array_max(F.transform(named, lambda one: one["rating"].cast("double")))


def _pivoted(reviews: DataFrame, keys: Mapping[str, Column], outer: bool) -> DataFrame:
    """One row per distinct review with a column per aspect.

    Ratings are read from each row's array, so aspects are never exploded and the shuffle carries
    one row per review. Reviews without aspects drop out, as an inner explode would have it,
    unless ``outer``.
    """
    kept = reviews if outer else reviews.where(F.array_size("aspects") > 0)
    ratings = {aspect: _best_rating(aspect) for aspect in ASPECTS}
    rows = kept.select(
        *[value.alias(name) for name, value in keys.items()],
        *[value.alias(aspect) for aspect, value in ratings.items()],
    )
    return rows.groupBy(*keys).agg(*[F.max(aspect).alias(aspect) for aspect in ratings])


def review_aspects(reviews: DataFrame, outer: bool = False) -> DataFrame:
    """Distinct reviews with the best rating of each aspect."""
    return _pivoted(reviews, {name: F.col(name) for name in _REVIEW_COLUMNS}, outer)


def review_analytics(reviews: DataFrame, outer: bool = False) -> DataFrame:
    """Rating, aspect and sentiment figures per product.

    Title and content only tell reviews apart here, so their SHA-256 digests are shuffled in
    place of the texts.
    """
    texts = {"title", "content"}
    keys = {
        name: F.sha2(F.col(name).cast("string"), 256) if name in texts else F.col(name)
        for name in _REVIEW_COLUMNS
    }
    rows = _pivoted(reviews, keys, outer)
    return (
        rows.groupBy(F.col("product_id").cast("string").alias("product_id"))
        .agg(
            mean_of("rating").alias("avg_rating"),
            F.count("review_id").alias("total_reviews"),
            F.count_if(F.col("verified_purchase") == "true").alias("verified_reviews"),
            *[mean_of(F.col(aspect).cast(RATING_TYPE)).alias(out) for aspect, out in ASPECTS.items()],
            F.count_if(F.col("sentiment_score") == "Positive").alias("positive_reviews"),
            F.count_if(F.col("sentiment_score") == "Negative").alias("negative_reviews"),
        )
        .withColumn("last_updated", F.current_timestamp())
    )


def monthly_metrics(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """Sales per product and month. ``total_orders`` counts lines, not distinct orders."""
    return _per_month(_dated_lines(order_items, orders))


def clustered_monthly_metrics(order_items: Clustered, orders: Clustered) -> DataFrame:
    """``monthly_metrics`` of tables that lie clustered by order: lines get their dates without a shuffle."""
    return _per_month(per_part(_dated_lines, order_items, orders))


def _dated_lines(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    dates = orders.select("order_id", "order_date")
    return join_suffix(order_items.select("order_id", "product_id", "quantity", "unit_price"), dates, "order_id")


def _per_month(lines: DataFrame) -> DataFrame:
    return lines.groupBy("product_id", month_start("order_date").alias("order_month")).agg(
        F.count("order_id").alias("total_orders"),
        F.sum("quantity").alias("total_quantity"),
        F.sum(F.col("unit_price") * F.col("quantity")).alias("total_sales"),
        mean_of("unit_price").alias("avg_price"),
    )


def product_performance_by_month(products: DataFrame, metrics: DataFrame) -> DataFrame:
    """Products with their monthly sales; a product without sales keeps one row."""
    return join_suffix(products, metrics, "product_id").select(
        "product_id", "product_name", "category", "order_month", "total_sales", "total_orders",
        "avg_price", "specifications",
    )
