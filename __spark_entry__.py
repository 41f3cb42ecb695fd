"""

Each query reads whole tables. Library results keep exact decimals; ``_plain`` turns those into
doubles so that both engines report the same type.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_queries import NEGATIVE, ORACLES, POSITIVE  # noqa: E402
from tillwork import schemas  # noqa: E402
from tillwork.functions.names import clean_names, trim_names  # noqa: E402
from tillwork.functions.text import lexicon_score  # noqa: E402
from tillwork.operators import clustering, nesting, quality  # noqa: E402
from tillwork.plans import customers, gold, nightly, orders, reports, silver  # noqa: E402
from tillwork.plans.driver_tables import DriverTables  # noqa: E402
from tillwork.session import new_folder, remove_folder, use_scale_settings  # noqa: E402
from tillwork.sinks import tables  # noqa: E402
from tillwork.sinks.partitions import overwrite_partitions  # noqa: E402
from tillwork.sources import files  # noqa: E402

try:
    import corpus_pipeline
    from tillwork.llm import queries as corpus
except ImportError:  # the subpackage of corpus operators is optional
    corpus = None

SMOKE_FOLDER = "/root/testdata/sf0.001"


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles."""
    return df.select(
        *[
            F.col(f"`{field.name}`").cast("double").alias(field.name)
            if isinstance(field.dataType, DecimalType)
            else F.col(f"`{field.name}`")
            for field in df.schema
        ]
    )


def _joined(array: str, first: str, second: str):
    """An array of two-field structs as text, NULL kept."""
    texts = F.transform(array, lambda one: F.concat(one[first], F.lit("="), one[second]))
    return F.when(F.col(array).isNotNull(), F.concat_ws("|", texts)).alias(array)


def _lexicon(text):
    return lexicon_score(text, POSITIVE, NEGATIVE)


# Building blocks shared by several queries.


def _details(t: DriverTables) -> DataFrame:
    return orders.order_details(t.orders, t.order_items, t.products, t.customers)


_DETAIL_COLUMNS = (
    "order_id", "customer_id", "order_date", "total_amount", "status", "payment_method", "product_id",
    "quantity", "unit_price", "product_name", "category", "state", "line_total",
)
# The right keys of the three joins, under their suffixed names.
_JOINED_KEYS = ("order_id_order_items", "product_id_products", "customer_id_customer")


def _performance(t: DriverTables) -> DataFrame:
    return orders.product_performance(t.order_items, t.products)


def _categories(t: DriverTables) -> DataFrame:
    return orders.category_performance(_performance(t))


def _top_products(t: DriverTables, metric: str) -> DataFrame:
    return orders.of_metric(orders.top_selling_products(_performance(t)), metric)


def _top_categories(t: DriverTables, metric: str) -> DataFrame:
    return orders.of_metric(orders.top_selling_categories(_categories(t)), metric)


def _by_state(t: DriverTables) -> DataFrame:
    return orders.state_category(t.orders, t.order_items, t.products, t.customers)


def _silver_products(t: DriverTables) -> DataFrame:
    return silver.silver_products(t.products, silver.nested_specifications(t.specifications))


def _preferences_hot_key(t: DriverTables) -> DataFrame:
    """All preferences under five customers: every array holds every child."""
    five = t.preferences.withColumn("customer_id", F.col("customer_id") % 5 + 1)
    nested = silver.silver_customers(t.customers, silver.nested_preferences(five)).where("customer_id_right IS NOT NULL")
    return nested.select(
        "customer_id",
        F.size("preferences").cast("bigint").alias("n"),
        F.sha2(_joined("preferences", "TYPE", "VALUE"), 256).alias("preferences_sha256"),
    )


def _silver_orders(t: DriverTables) -> DataFrame:
    return silver.silver_orders(t.orders, t.customers)


def _silver_reviews(t: DriverTables) -> DataFrame:
    return silver.silver_reviews(t.reviews, _lexicon)


def _gold_performance(t: DriverTables) -> DataFrame:
    return gold.product_performance_by_month(_silver_products(t), gold.monthly_metrics(t.order_items, t.orders))


# Queries that need more than one expression.


def _clean_names(t: DriverTables) -> DataFrame:
    odd = t.raw("customer").select(
        F.col("c_custkey").alias("'C_CustKey'"),
        F.col("c_name").alias('C_"Name"'),
        F.col("c_mktsegment").alias('"C_MktSegment"'),
    )
    cleaned = clean_names(odd)
    again = cleaned.select("c_custkey", "c_name", F.col("c_mktsegment").alias("'Market\"Segment'"))
    return trim_names(again, lower=False).withColumnRenamed('Market"Segment', "Market Segment")


def _order_history(t: DriverTables) -> DataFrame:
    return orders.customer_order_history(t.orders, t.order_items, t.products, t.customers, 7).select(
        *_DETAIL_COLUMNS
    )


def _gold_specifications_text(df: DataFrame) -> DataFrame:
    return df.withColumn("specifications", _joined("specifications", "NAME", "VALUE"))


def _spec_json_rows(t: DriverTables) -> DataFrame:
    nested = silver.nested_specifications(t.specifications).select("product_id", F.to_json("specifications").alias("specifications"))
    return reports.specification_rows(nested)


def _json_paths(t: DriverTables) -> DataFrame:
    events = t.raw("events").select("event_id", "props")
    return files.project_paths(events, "props", {"votes": ("$.k", "bigint"), "votes_text": ("$.k", "string")})


def _reviews_json(t: DriverTables) -> str:
    """Reviews as JSON arrays, one array of up to four reviews per line, in a compressed file per task."""
    path = new_folder(t.spark, "reviews-json")
    fields = t.unrounded_reviews.withColumnRenamed("review_date", "date")
    arrays = fields.groupBy(F.floor(F.col("review_id") / 4)).agg(F.collect_list(F.struct(*fields.columns)).alias("reviews"))
    arrays.select(F.to_json("reviews").alias("value")).write.text(path, compression="gzip")
    return path


def _indented_reviews_json(t: DriverTables) -> str:
    """Reviews as indented JSON arrays, whose elements span many lines."""
    path = new_folder(t.spark, "reviews-indented")
    fields = t.unrounded_reviews.withColumnRenamed("review_date", "date")
    arrays = fields.groupBy(F.floor(F.col("review_id") / 400)).agg(F.collect_list(F.struct(*fields.columns)).alias("reviews"))
    arrays.select(F.to_json("reviews", {"pretty": "true"}).alias("value")).write.text(path)
    return path


def _preferences_xml(t: DriverTables, compression: str = "none") -> str:
    path = new_folder(t.spark, "preferences-xml")
    fields = {"preference_type": "type", "preference_value": "value"}
    records = nesting.nest_children(t.preferences, "customer_id", fields, "preference")
    records.select("customer_id", "preference").write.options(rootTag="customers", rowTag="customer", compression=compression).xml(path)
    return path


def _specifications_xml(t: DriverTables, compression: str = "none") -> str:
    path = new_folder(t.spark, "specifications-xml")
    fields = {"spec_name": "name", "spec_value": "value"}
    records = nesting.nest_children(t.specifications, "product_id", fields, "specification")
    records.select("product_id", "specification").write.options(rootTag="products", rowTag="product", compression=compression).xml(path)
    return path


def _reviews_roundtrip(t: DriverTables) -> DataFrame:
    return _rated(files.read_reviews(t.spark, _reviews_json(t), "lines"))


def _reviews_split(t: DriverTables) -> DataFrame:
    return _rated(files.read_reviews(t.spark, _indented_reviews_json(t), "split"))


def _rated(read: DataFrame) -> DataFrame:
    rated = F.transform("aspects", lambda one: F.concat(one["name"], F.lit("="), one["rating"].cast("string")))
    return read.withColumn("aspects", F.concat_ws("|", rated))


def _preferences_roundtrip(t: DriverTables) -> DataFrame:
    read = files.read_preferences(t.spark, _preferences_xml(t), "records")
    return read.select("customer_id", "preference_type", "preference_value")


def _preferences_split(t: DriverTables) -> DataFrame:
    read = files.read_preferences(t.spark, _preferences_xml(t), "split")
    return read.select("customer_id", "preference_type", "preference_value")


def _specifications_roundtrip(t: DriverTables) -> DataFrame:
    read = files.read_specifications(t.spark, _specifications_xml(t), "document")
    return read.select("product_id", "spec_name", "spec_value")


def _csv_roundtrip(t: DriverTables) -> DataFrame:
    path = new_folder(t.spark, "preference-counts-csv")
    reports.export_top_preferences(t.preferences, path)
    return files.read_preference_counts(t.spark, path)


def _new_database(t: DriverTables) -> str:
    """A fresh database whose tables lie below the shared folder."""
    database = f"tillwork_{uuid.uuid4().hex}"
    t.spark.sql(f"CREATE DATABASE {database} LOCATION '{new_folder(t.spark, 'tables')}'")
    return database


def _settled(t: DriverTables, database: str, result: DataFrame, *folders: str) -> DataFrame:
    """A short summary of the tables of ``database``, which then goes with the folders it was loaded from."""
    rows, schema = result.collect(), result.schema
    location = t.spark.sql(f"DESCRIBE DATABASE {database}").where("info_name = 'Location'").first()[1]
    t.spark.sql(f"DROP DATABASE {database} CASCADE")
    for folder in (location, *folders):
        remove_folder(t.spark, folder)
    return t.spark.createDataFrame(rows, schema)


def _table_write_modes(t: DriverTables) -> DataFrame:
    """Every write mode on catalog tables, then one SQL text over them and the row counts that the writes reported."""
    database = _new_database(t)
    sales, changed, log = (f"{database}.{name}" for name in ("sales", "changed", "log"))
    counts = {"overwrite": 0, "replace": 0, "append": 0}
    tables.overwrite_table(t.orders.select("order_id", "status"), sales)
    counts["overwrite"] = tables.overwrite_table(t.orders, sales, ("status",))
    tables.replace_rows(t.orders.select("order_id", "status", "total_amount"), changed)
    # Reads the table it replaces.
    counts["replace"] = tables.replace_rows(
        t.spark.table(changed).select("order_id", F.lower("status").alias("status"), "total_amount"), changed
    )
    for _ in range(2):
        counts["append"] += tables.append_rows(t.orders.select("order_id", "status"), log)
    many = tables.write_many(
        {
            f"{database}.months": customers.monthly_revenue(t.orders),
            f"{database}.payments": customers.payment_method_counts(t.orders),
        }
    )
    written = " ".join(f"UNION ALL SELECT 'written', '{mode}', {count}, NULL" for mode, count in counts.items())
    result = t.spark.sql(
        f"""
        SELECT 'overwrite' AS mode, status AS item, count(*) AS n, sum(total_amount) AS amount FROM {sales} GROUP BY status
        UNION ALL SELECT 'replace', status, count(*), sum(total_amount) FROM {changed} GROUP BY status
        UNION ALL SELECT 'append', status, count(*), NULL FROM {log} GROUP BY status
        UNION ALL SELECT 'many', order_month, 1, monthly_revenue FROM {database}.months
        UNION ALL SELECT 'many', payment_method, sum(count), NULL FROM {database}.payments GROUP BY payment_method
        {written} UNION ALL SELECT 'written', 'many', {sum(many)}, NULL
        """
    )
    return _settled(t, database, result)


def _changed_partitions(t: DriverTables) -> DataFrame:
    """Orders laid out by status, written again with other amounts under one status: rows, and which partitions were written anew."""
    database = _new_database(t)
    name = f"{database}.by_status"
    sales = t.orders.select("order_id", "total_amount", "status")
    overwrite_partitions(sales, name, ("status",))
    raised = F.when(F.col("status") == "F", F.col("total_amount") + 1).otherwise(F.col("total_amount"))
    overwrite_partitions(sales.withColumn("total_amount", raised.cast("decimal(12,2)")), name, ("status",))
    version = tables.current_version(t.spark, name)
    inside = F.contains(F.lower(F.input_file_name()), F.lit(version.rpartition(".")[2].lower()))
    result = t.spark.table(name).withColumn("written", inside).groupBy("status", "written").agg(
        F.count("*").alias("n"), F.sum("total_amount").alias("amount")
    )
    return _settled(t, database, result)


def _clustered_orders(t: DriverTables) -> DataFrame:
    """Orders and lines clustered by order, a third of the lines in one order; sales per month out of them."""
    database = _new_database(t)
    order = F.when(F.col("product_id") % 3 == 0, F.lit(1)).otherwise(F.col("order_id"))
    items = t.order_items.withColumn("order_id", order)
    hot = clustering.hot_keys(items, "order_id")
    sales, lines = f"{database}.sales", f"{database}.lines"
    clustering.write_clustered(t.orders, sales, "order_id", hot, 16)
    clustering.write_clustered(items, lines, "order_id", hot, 16)
    metrics = gold.clustered_monthly_metrics(
        clustering.read_clustered(t.spark, lines), clustering.read_clustered(t.spark, sales)
    )
    result = metrics.groupBy("order_month").agg(
        *[F.sum(name).alias(name) for name in ("total_orders", "total_quantity", "total_sales")]
    )
    return _settled(t, database, result)


# What to sum in each table of the nightly run; money in cents.
_NIGHTLY_FIGURES = {
    "BRONZE_CUSTOMERS": "length(address)",
    "BRONZE_PRODUCTS": "100 * price",
    "BRONZE_ORDERS": "100 * total_amount",
    "BRONZE_ORDER_ITEMS": "100 * unit_price * quantity",
    "BRONZE_CUSTOMER_PREFERENCES": "length(preference_value)",
    "BRONZE_PRODUCT_SPECIFICATIONS": "length(spec_value)",
    "analytics_monthly_revenue": "100 * monthly_revenue",
    "analytics_product_price_stats": "100 * (min_price + max_price)",
    "BRONZE_INVENTORY": "quantity",
    "BRONZE_PRODUCT_REVIEWS": "helpful_votes",
    "SILVER_CUSTOMERS": "size(preferences)",
    "SILVER_PRODUCTS": "size(specifications)",
    "SILVER_PRODUCT_REVIEWS": "if(sentiment_score = 'Positive', 1, 0)",
    "SILVER_ORDERS": "if(state IS NULL, 0, 1)",
    "GOLD_CUSTOMER_INSIGHTS": "total_orders",
    "GOLD_PRODUCT_REVIEWS_ANALYTICS": "positive_reviews",
    "GOLD_PRODUCT_PERFORMANCE": "total_orders",
    "analytics_top_selling_products_by_quantity": "total_quantity_sold",
    "analytics_top_selling_products_by_revenue": "total_quantity_sold",
    "analytics_top_selling_categories_by_quantity": "total_quantity_sold",
    "analytics_top_selling_categories_by_revenue": "total_quantity_sold",
    "analytics_state_category_analysis": "order_count",
    "analytics_customer_stats": "order_count",
    "analytics_order_status_counts": "count",
    "analytics_payment_method_counts": "count",
    "analytics_inventory_per_product": "total_stock",
    "analytics_inventory_per_category": "category_stock",
    "analytics_inventory_per_warehouse": "warehouse_stock",
}


def _nightly_tables(t: DriverTables) -> DataFrame:
    """The whole nightly run into a fresh database: rows, reported rows and one figure of each table, and the audit row."""
    sources = {
        "customers": t.customers, "products": t.products, "orders": t.orders,
        "inventory": t.inventory, "order_items": t.order_items,
    }
    inputs = nightly.Inputs(
        table=sources.__getitem__,
        reviews=_reviews_json(t),
        preferences=_preferences_xml(t, "gzip"),
        specifications=_specifications_xml(t, "gzip"),
        reviews_layout="lines",
        xml_layout="records",
    )
    database, previous = _new_database(t), t.spark.catalog.currentDatabase()
    t.spark.catalog.setCurrentDatabase(database)
    try:
        written = nightly.run_nightly(t.spark, inputs, "driver-tables", nightly.Models(sentiment=_lexicon))
    finally:
        t.spark.catalog.setCurrentDatabase(previous)
    counted = [
        f"SELECT '{name}' AS table_name, count(*) AS n, CAST({rows} AS BIGINT) AS n_written, "
        f"CAST(sum({_NIGHTLY_FIGURES[name]}) AS BIGINT) AS figure FROM {database}.{name}"
        for name, rows in written.items()
    ]
    audit = f"{database}.{schemas.VALIDATION_RESULTS}"
    counted.append(
        f"SELECT concat('audit of ', variant_get(RunId, '$.run_name', 'string'), if(RunStatus, ' passed', ' failed')), "
        f"count(*), CAST(1 AS BIGINT), CAST(sum(variant_get(RunValidation, '$[0].unexpected_count', 'bigint')) AS BIGINT) "
        f"FROM {audit} GROUP BY 1"
    )
    return _settled(
        t, database, t.spark.sql(" UNION ALL ".join(counted)), inputs.reviews, inputs.preferences, inputs.specifications
    )


_EXPECTATIONS = (
    *quality.REVIEW_EXPECTATIONS,
    quality.ValuesInSet("verified_purchase", ("true", "false")),
    quality.MinBetween("helpful_votes", 0, 20),
    quality.ValuesInSet("title", ("click", "purchase", "signup")),
)


def _expectation_results(t: DriverTables) -> DataFrame:
    return quality.check(t.review_facts, _EXPECTATIONS)


def _validation_record(t: DriverTables) -> DataFrame:
    record = quality.validation_record(quality.check(t.review_facts, _EXPECTATIONS), "whole-table")
    return record.select(
        F.col("RunStatus").alias("run_status"),
        F.variant_get("RunId", "$.run_name", "string").alias("run_name"),
        F.variant_get("RunValidation", "$[0].success", "boolean").alias("first_success"),
        F.variant_get("RunValidation", "$[0].unexpected_count", "bigint").alias("first_unexpected"),
    )


def _validation_sample(t: DriverTables) -> DataFrame:
    """The sampled form: the 2000 rows whose ids have the smallest hashes, or all if there are fewer."""
    sampled = quality.check(t.review_facts, _EXPECTATIONS, 2000, ("review_id",))
    return sampled.select("check_no", "success", "element_count", "missing_count", "unexpected_count", "observed_value")


def _state_by_extractor(t: DriverTables) -> DataFrame:
    """The place extractor path: once per distinct address, joined back."""
    shortened = silver.silver_orders(t.orders, t.customers, lambda address: F.replace(address, F.lit(" Main St")))
    return shortened.select("order_id", "state")


def _spec_ranking(t: DriverTables, measure: str) -> DataFrame:
    return reports.ranked_spec(reports.with_spec_numbers(reports.spec_pivot(t.products, t.specifications)), measure)


def _lineage(t: DriverTables) -> DataFrame:
    return files.with_lineage(t.customers, "customers.xml").select(
        "customer_id", "source_file", F.col("last_updated").isNotNull().alias("loaded")
    )


_QUERIES: dict[str, Callable[[DriverTables], DataFrame]] = {
    "clean_names": _clean_names,
    "order_details": lambda t: _details(t).select(*_DETAIL_COLUMNS, *_JOINED_KEYS),
    "product_performance": _performance,
    "category_performance": _categories,
    "customer_order_history": _order_history,
    "top_products": lambda t: orders.top_selling_products(_performance(t)),
    "top_products_by_quantity": lambda t: _top_products(t, orders.BY_QUANTITY),
    "top_products_by_revenue": lambda t: _top_products(t, orders.BY_REVENUE),
    "top_categories": lambda t: orders.top_selling_categories(_categories(t)),
    "top_categories_by_quantity": lambda t: _top_categories(t, orders.BY_QUANTITY),
    "top_categories_by_revenue": lambda t: _top_categories(t, orders.BY_REVENUE),
    "state_category": _by_state,
    "state_category_top3": lambda t: orders.state_category_top(_by_state(t)),
    "silver_customers": lambda t: silver.silver_customers(
        t.customers, silver.nested_preferences(t.preferences)
    ).withColumn("preferences", _joined("preferences", "TYPE", "VALUE")),
    "silver_preferences_hot_key": _preferences_hot_key,
    "silver_products": lambda t: _gold_specifications_text(_silver_products(t)),
    "silver_reviews_sentiment": lambda t: silver.silver_reviews(t.review_texts, _lexicon).select(
        "review_id", "sentiment_score"
    ),
    "silver_orders_state": _silver_orders,
    "silver_orders_state_by_extractor": _state_by_extractor,
    "gold_customer_insights": lambda t: gold.customer_insights(t.customers, _silver_orders(t)).drop("last_updated"),
    "gold_review_aspects_pivot": lambda t: gold.review_aspects(_silver_reviews(t)),
    "gold_review_analytics": lambda t: gold.review_analytics(_silver_reviews(t)).drop("last_updated"),
    "gold_monthly_metrics": lambda t: gold.monthly_metrics(t.order_items, t.orders),
    "gold_product_performance": lambda t: _gold_specifications_text(_gold_performance(t)),
    "customer_stats": lambda t: customers.customer_stats(t.customers, t.orders),
    "monthly_revenue": lambda t: customers.monthly_revenue(t.orders),
    "order_status_counts": lambda t: customers.order_status_counts(t.orders),
    "payment_method_counts": lambda t: customers.payment_method_counts(t.orders),
    "inventory_per_product": lambda t: customers.inventory_per_product(t.products, t.inventory),
    "inventory_per_category": lambda t: customers.inventory_per_category(
        customers.inventory_per_product(t.products, t.inventory)
    ),
    "inventory_per_warehouse": lambda t: customers.inventory_per_warehouse(t.inventory),
    "product_price_stats": lambda t: customers.product_price_stats(t.products),
    "kpi_summary": lambda t: reports.kpi_summary(_top_categories(t, orders.BY_REVENUE), _gold_performance(t)),
    "category_chart": lambda t: reports.category_chart(_top_categories(t, orders.BY_REVENUE)),
    "status_distribution": lambda t: reports.status_distribution(customers.order_status_counts(t.orders)),
    "top_customers_by_spend": lambda t: reports.top_customers_by_spend(
        customers.customer_stats(t.customers, t.orders)
    ),
    "state_revenue_treemap": lambda t: reports.state_revenue_treemap(orders.state_category_top(_by_state(t))),
    "top_products_table": lambda t: reports.top_products_table(_top_products(t, orders.BY_REVENUE)),
    "top_reviewed_products": lambda t: _gold_specifications_text(
        reports.top_reviewed_products(gold.review_analytics(_silver_reviews(t)), t.products, t.specifications)
    ),
    "spec_pivot": lambda t: reports.spec_pivot(t.products, t.specifications),
    "spec_numbers": lambda t: _spec_ranking(t, "battery_life_hours"),
    "spec_numbers_storage": lambda t: _spec_ranking(t, "storage_gb"),
    "spec_json_rows": _spec_json_rows,
    "preference_counts": lambda t: reports.preference_counts(t.preferences),
    "top_preferences": lambda t: reports.top_preferences(t.preferences),
    "json_path_projection": _json_paths,
    "reviews_json_roundtrip": _reviews_roundtrip,
    "reviews_json_split": _reviews_split,
    "preferences_xml_roundtrip": _preferences_roundtrip,
    "preferences_xml_split": _preferences_split,
    "specs_xml_roundtrip": _specifications_roundtrip,
    "csv_export_roundtrip": _csv_roundtrip,
    "table_write_modes": _table_write_modes,
    "changed_partitions": _changed_partitions,
    "clustered_orders": _clustered_orders,
    "expectation_results": _expectation_results,
    "validation_record": _validation_record,
    "validation_sample": _validation_sample,
    "nightly_tables": _nightly_tables,
    "lineage_columns": _lineage,
}


def entry(spark: SparkSession) -> DataFrame:
    """Category performance on the smallest scale."""
    return queries()["category_performance"](spark, SMOKE_FOLDER)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(build: Callable[[DriverTables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            use_scale_settings(spark, folder)
            return _plain(build(DriverTables(spark, folder)))

        return run

    found = {name: bound(build) for name, build in _QUERIES.items()}
    return found | ({} if corpus is None else {**corpus.QUERIES, "pipeline": corpus_pipeline.run})


def oracle_sql() -> dict[str, str]:
    return ORACLES | ({} if corpus is None else corpus.ORACLES)
