"""Result sets behind the dashboard, each from the tables the layers write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork import schemas
from tillwork.functions.measures import AVERAGE_TYPE, mean_of
from tillwork.functions.text import first_number, preference_key, same_text
from tillwork.operators.ranking import top_n
from tillwork.plans.silver import nested_specifications
from tillwork.sinks.csv_export import export_csv

# Specification names the technical charts look for, in any case.
BATTERY = "battery life"
STORAGE = "storage"


def kpi_summary(top_categories_by_revenue: DataFrame, gold_performance: DataFrame) -> DataFrame:
    """The four headline figures as ``kpi, value`` rows.

    The first three describe the listed top categories, not all sales.
    """
    listed = top_categories_by_revenue.agg(
        F.sum("total_revenue").cast("double").alias("total_revenue"),
        F.sum("total_orders").cast("double").alias("total_orders"),
        mean_of(F.col("avg_order_value").cast(AVERAGE_TYPE)).alias("avg_order_value"),
    ).unpivot([], ["total_revenue", "total_orders", "avg_order_value"], "kpi", "value")
    # Distinct first, count second: Catalyst can then leave out the outer join behind the table.
    products = (
        gold_performance.select("product_id").distinct()
        .agg(F.count("product_id").cast("double").alias("value"))
        .select(F.lit("total_products").alias("kpi"), "value")
    )
    return listed.union(products)


def category_chart(top_categories_by_revenue: DataFrame) -> DataFrame:
    return top_n(top_categories_by_revenue.select("category", "total_revenue"), "total_revenue", 10, "category")


def status_distribution(status_counts: DataFrame) -> DataFrame:
    return status_counts.groupBy("status").agg(F.sum("count").alias("total_count"))


def top_customers_by_spend(stats: DataFrame, n: int = 100) -> DataFrame:
    best = top_n(stats, "total_spend", n, "customer_id")
    return best.select(
        *[F.col(name).cast("double").alias(name) for name in ("total_spend", "order_count", "avg_order_value")]
    )


def state_revenue_treemap(state_category: DataFrame, n: int = 20) -> DataFrame:
    present = state_category.where("state IS NOT NULL AND category IS NOT NULL AND total_revenue > 0").select(
        F.col("state").cast("string").alias("state"),
        F.col("category").cast("string").alias("category"),
        "total_revenue",
    )
    return top_n(present, "total_revenue", n, "state", "category").withColumn(
        "total_revenue", F.col("total_revenue").cast("double")
    )


def top_products_table(top_products_by_revenue: DataFrame, n: int = 10) -> DataFrame:
    return top_n(top_products_by_revenue, "total_revenue", n, "product_id").select(
        "product_name", "category", "total_orders", "total_quantity_sold", "total_revenue"
    )


def top_reviewed_products(
    review_analytics: DataFrame, products: DataFrame, specifications: DataFrame, n: int = 10
) -> DataFrame:
    """The most reviewed products with name and specifications.

    A left join keeps every left row, so the ``n`` rows needed come from the ``n`` best on the
    left; products and specifications are reduced to those ids before anything is nested.
    """
    best = top_n(review_analytics, "total_reviews", n, "product_id")
    # At most n rows, hence safe to broadcast.
    listed = F.broadcast(best.select("product_id"))

    def of_listed(rows: DataFrame) -> DataFrame:
        return rows.withColumn("product_id", F.col("product_id").cast("string")).join(listed, "product_id", "left_semi")

    names = of_listed(products.select("product_id", "product_name"))
    nested = nested_specifications(of_listed(specifications.select("product_id", "spec_name", "spec_value")))
    wanted = names.join(nested, "product_id", "left")
    return top_n(best.join(wanted, "product_id", "left"), "total_reviews", n, "product_id").select(
        "product_id", "product_name", "specifications", "avg_rating", "total_reviews",
        "positive_reviews", "negative_reviews",
    )


def specification_rows(products: DataFrame) -> DataFrame:
    """``product_id, name, value`` from the specification array, or from its JSON text."""
    specifications = F.col("specifications")
    if products.schema["specifications"].dataType.typeName() == "string":
        specifications = F.from_json(specifications, schemas.SPECIFICATIONS_TYPE)
    return products.select("product_id", F.explode(specifications).alias("_spec")).select(
        "product_id", F.col("_spec.NAME").alias("name"), F.col("_spec.VALUE").alias("value")
    )


def spec_pivot(silver_products: DataFrame, specifications: DataFrame) -> DataFrame:
    """Battery life and storage of every product. Specifications are reduced before the join."""
    def largest(name: str):
        return F.max(F.when(same_text(F.col("spec_name"), name), F.col("spec_value")))

    per_product = specifications.groupBy("product_id").agg(
        largest(BATTERY).alias("battery_life"), largest(STORAGE).alias("storage")
    )
    named = silver_products.select("product_id", "product_name").distinct()
    joined = named.join(per_product, "product_id", "left")
    return joined.select("product_id", "product_name", "battery_life", "storage")


def with_spec_numbers(pivot: DataFrame) -> DataFrame:
    return pivot.withColumns(
        {"battery_life_hours": first_number(F.col("battery_life")), "storage_gb": first_number(F.col("storage"))}
    )


def ranked_spec(numbers: DataFrame, measure: str) -> DataFrame:
    """Products that have ``measure`` (``battery_life_hours`` or ``storage_gb``), largest first."""
    return numbers.dropna(subset=[measure]).orderBy(F.desc(measure), "product_id")


def preference_counts(preferences: DataFrame) -> DataFrame:
    return preferences.groupBy(preference_key().alias("preference")).count()


def top_preferences(preferences: DataFrame, n: int = 10) -> DataFrame:
    return top_n(preference_counts(preferences), "count", n, "preference")


def export_top_preferences(preferences: DataFrame, path: str, n: int = 10) -> None:
    """One file: the report has ``n`` rows at most."""
    export_csv(top_preferences(preferences, n).coalesce(1), path)


def dashboard(spark: SparkSession) -> dict[str, DataFrame]:
    """Every result set of the dashboard, lazily, from the tables of the nightly run."""
    by_revenue = spark.table("analytics_top_selling_categories_by_revenue")
    goods = spark.table(schemas.SILVER_PRODUCTS)
    specifications = spark.table(schemas.BRONZE_PRODUCT_SPECIFICATIONS)
    specs = with_spec_numbers(spec_pivot(goods, specifications))
    reviewed = top_reviewed_products(spark.table(schemas.GOLD_PRODUCT_REVIEWS_ANALYTICS), goods, specifications)
    return {
        "kpis": kpi_summary(by_revenue, spark.table(schemas.GOLD_PRODUCT_PERFORMANCE)),
        "categories": category_chart(by_revenue),
        "statuses": status_distribution(spark.table("analytics_order_status_counts")),
        "customers": top_customers_by_spend(spark.table("analytics_customer_stats")),
        "states": state_revenue_treemap(spark.table("analytics_state_category_analysis")),
        "products": top_products_table(spark.table("analytics_top_selling_products_by_revenue")),
        "reviews": reviewed,
        "review_specifications": specification_rows(reviewed),
        "battery_life": ranked_spec(specs, "battery_life_hours"),
        "storage": ranked_spec(specs, "storage_gb"),
        "preferences": top_preferences(spark.table(schemas.BRONZE_CUSTOMER_PREFERENCES)),
    }
