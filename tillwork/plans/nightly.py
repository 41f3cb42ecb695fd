"""The nightly jobs in dependency order, from source systems to analytics tables.

A run has a name. Each table keeps, in the step that shows it, the run that wrote it and the versions of the tables it was
computed from. So a run that is started again under its name does only what is missing: a table that this run has
written from the versions its inputs still show is left as it is, and the run's audit row is written once.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork import schemas
from tillwork.functions.names import clean_names
from tillwork.functions.text import Scorer, lexicon_score
from tillwork.operators import quality
from tillwork.plans import customers, gold, orders, silver
from tillwork.sinks.partitions import overwrite_partitions
from tillwork.sinks.tables import append_rows, current_version, note_of, overwrite_table, replace_rows, write_many
from tillwork.sources import files

# Target table of each source table.
DATABASE_TARGETS = {
    "customers": schemas.BRONZE_CUSTOMERS,
    "products": schemas.BRONZE_PRODUCTS,
    "inventory": schemas.BRONZE_INVENTORY,
    "orders": schemas.BRONZE_ORDERS,
    "order_items": schemas.BRONZE_ORDER_ITEMS,
}

# The order in which the customer analytics hand out the five tables.
ANALYTICS_TABLES = ("customers", "products", "orders", "inventory", "order_items")


@dataclass(frozen=True)
class Inputs:
    """Where the data comes from.

    ``table`` gives the DataFrame of a source table by name, for example
    ``lambda name: bronze.database_table(spark, source, name, splits[name])``; each is read once a night. The
    layouts are those of ``sources.files``; ``document`` reads a file per task, the others split large files.
    """

    table: Callable[[str], DataFrame]
    reviews: str
    preferences: str
    specifications: str
    reviews_layout: str
    xml_layout: str
    #: Called when the rows of a source table are read and before they are shown, such as ``Snapshot.verify``.
    verify: Callable[[], None] | None = None


@dataclass(frozen=True)
class Models:
    """Pluggable text scorers; the defaults are plain column expressions."""

    sentiment: Scorer = lexicon_score
    place: Scorer | None = None


class Run:
    """What one named run has already written. Without a name nothing counts as written."""

    def __init__(self, spark: SparkSession, name: str | None = None):
        self.spark, self.name = spark, name

    def note(self, inputs: Iterable[str]) -> dict[str, str]:
        versions = {one: current_version(self.spark, one) or "" for one in sorted(inputs)}
        return {} if self.name is None else {"run": self.name, "inputs": json.dumps(versions)}

    def written(self, target: str, inputs: Iterable[str]) -> int | None:
        """The rows of ``target`` if this run has written it from the present versions of ``inputs``."""
        found = note_of(self.spark, target)
        done = self.name is not None and found.items() >= self.note(inputs).items()
        return int(found["rows"]) if done else None


@dataclass(frozen=True)
class Job:
    """One table: how its rows are computed, from which tables of the catalog, and how it is written."""

    target: str
    build: Callable[[], DataFrame]
    inputs: tuple[str, ...] = ()
    write: Callable[..., int] = overwrite_table

    def do(self, run: Run) -> int:
        rows = run.written(self.target, self.inputs)
        if rows is None:
            note = run.note(self.inputs)
            rows = self.write(self.build(), self.target, note=note)
        return rows


def _together(run: Run, jobs: list[Job]) -> dict[str, int]:
    """Do independent jobs at the same time and wait for all of them."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = {job.target: pool.submit(inheritable_thread_target(run.spark)(job.do), run) for job in jobs}
        return {name: future.result() for name, future in futures.items()}


def load_bronze(spark: SparkSession, inputs: Inputs, run: Run | None = None) -> dict[str, int]:
    """All eight loads. Silver waits for every one of them."""
    checked = partial(overwrite_table, verify=inputs.verify)
    jobs = [
        Job(target, lambda name=name: clean_names(inputs.table(name)), write=checked)
        for name, target in DATABASE_TARGETS.items()
    ]
    xml = inputs.xml_layout
    read = {
        schemas.BRONZE_PRODUCT_REVIEWS: lambda: files.read_reviews(spark, inputs.reviews, inputs.reviews_layout),
        schemas.BRONZE_CUSTOMER_PREFERENCES: lambda: files.read_preferences(spark, inputs.preferences, xml),
        schemas.BRONZE_PRODUCT_SPECIFICATIONS: lambda: files.read_specifications(spark, inputs.specifications, xml),
    }
    return _together(run or Run(spark), jobs + [Job(target, build) for target, build in read.items()])


def bronze_to_silver(spark: SparkSession, models: Models = Models(), run: Run | None = None) -> dict[str, int]:
    def cleaned(name: str) -> DataFrame:
        return clean_names(spark.table(name))

    people, goods, sales = schemas.BRONZE_CUSTOMERS, schemas.BRONZE_PRODUCTS, schemas.BRONZE_ORDERS
    preferences, specifications = schemas.BRONZE_CUSTOMER_PREFERENCES, schemas.BRONZE_PRODUCT_SPECIFICATIONS
    reviews = schemas.BRONZE_PRODUCT_REVIEWS
    jobs = [
        Job(
            schemas.SILVER_CUSTOMERS,
            lambda: silver.silver_customers(cleaned(people), silver.nested_preferences(spark.table(preferences))),
            (people, preferences),
        ),
        Job(
            schemas.SILVER_PRODUCTS,
            lambda: silver.silver_products(cleaned(goods), silver.nested_specifications(spark.table(specifications))),
            (goods, specifications),
        ),
        Job(schemas.SILVER_PRODUCT_REVIEWS, lambda: silver.silver_reviews(spark.table(reviews), models.sentiment), (reviews,)),
        Job(schemas.SILVER_ORDERS, lambda: silver.silver_orders(cleaned(sales), cleaned(people), models.place), (sales, people)),
    ]
    return _together(run or Run(spark), jobs)


def validate_reviews(
    spark: SparkSession,
    run_name: str,
    expectations=quality.REVIEW_EXPECTATIONS,
    sample_rows: int | None = None,
) -> None:
    """Check the silver reviews and append the outcome to the audit table, once per run. It does not gate gold."""
    if spark.catalog.tableExists(schemas.VALIDATION_RESULTS):
        named = F.variant_get("RunId", "$.run_name", "string") == run_name
        if not spark.table(schemas.VALIDATION_RESULTS).where(named).isEmpty():
            return
    results = quality.check(spark.table(schemas.SILVER_PRODUCT_REVIEWS), expectations, sample_rows, ("review_id",))
    append_rows(quality.validation_record(results, run_name), schemas.VALIDATION_RESULTS)


def silver_to_gold(spark: SparkSession, run: Run | None = None) -> dict[str, int]:
    people, sales, reviews = schemas.SILVER_CUSTOMERS, schemas.SILVER_ORDERS, schemas.SILVER_PRODUCT_REVIEWS
    goods, items = schemas.SILVER_PRODUCTS, schemas.BRONZE_ORDER_ITEMS
    jobs = [
        Job(
            schemas.GOLD_CUSTOMER_INSIGHTS,
            lambda: gold.customer_insights(spark.table(people), spark.table(sales)),
            (people, sales),
            replace_rows,
        ),
        Job(
            schemas.GOLD_PRODUCT_REVIEWS_ANALYTICS,
            lambda: gold.review_analytics(spark.table(reviews)),
            (reviews,),
            replace_rows,
        ),
        Job(
            schemas.GOLD_PRODUCT_PERFORMANCE,
            lambda: gold.product_performance_by_month(
                spark.table(goods), gold.monthly_metrics(clean_names(spark.table(items)), spark.table(sales))
            ),
            (goods, items, sales),
            # Most nights change few months.
            partial(overwrite_partitions, partition_by=("order_month",)),
        ),
    ]
    return _together(run or Run(spark), jobs)


def order_analytics(spark: SparkSession, models: Models = Models(), run: Run | None = None) -> dict[str, int]:
    """The five order tables. Product figures are computed once for four of them."""
    run = run or Run(spark)
    names = (schemas.BRONZE_ORDERS, schemas.BRONZE_ORDER_ITEMS, schemas.BRONZE_PRODUCTS, schemas.BRONZE_CUSTOMERS)
    sales, items, goods, people = (clean_names(spark.table(name)) for name in names)
    per_product = orders.product_performance(items, goods).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        top_products = orders.top_selling_products(per_product)
        top_categories = orders.top_selling_categories(orders.category_performance(per_product))
        by_state = orders.state_category(sales, items, goods, people, models.place)
        tables = {
            "analytics_top_selling_products_by_quantity": orders.of_metric(top_products, orders.BY_QUANTITY),
            "analytics_top_selling_products_by_revenue": orders.of_metric(top_products, orders.BY_REVENUE),
            "analytics_top_selling_categories_by_quantity": orders.of_metric(top_categories, orders.BY_QUANTITY),
            "analytics_top_selling_categories_by_revenue": orders.of_metric(top_categories, orders.BY_REVENUE),
            "analytics_state_category_analysis": orders.state_category_top(by_state),
        }
        return {name: Job(name, lambda df=df: df, names).do(run) for name, df in tables.items()}
    finally:
        per_product.unpersist()


def customer_analytics(
    table: Callable[[str], DataFrame], degree: int = 10, run: Run | None = None
) -> dict[str, int]:
    """The eight customer, order, stock and price tables, written concurrently."""
    people, goods, sales, stock, _ = (clean_names(table(name)) for name in ANALYTICS_TABLES)
    run = run or Run(people.sparkSession)
    inputs = tuple(DATABASE_TARGETS[name] for name in ANALYTICS_TABLES) if run.name is not None else ()
    per_product = customers.inventory_per_product(goods, stock).persist(StorageLevel.MEMORY_AND_DISK)
    tables = {
        "analytics_customer_stats": customers.customer_stats(people, sales),
        "analytics_monthly_revenue": customers.monthly_revenue(sales),
        "analytics_order_status_counts": customers.order_status_counts(sales),
        "analytics_payment_method_counts": customers.payment_method_counts(sales),
        "analytics_inventory_per_product": per_product,
        "analytics_inventory_per_category": customers.inventory_per_category(per_product),
        "analytics_inventory_per_warehouse": customers.inventory_per_warehouse(stock),
        "analytics_product_price_stats": customers.product_price_stats(goods),
    }
    done = {name: rows for name in tables if (rows := run.written(name, inputs)) is not None}
    missing = {name: df for name, df in tables.items() if name not in done}
    try:
        done |= dict(zip(missing, write_many(missing, degree, run.note(inputs))))
        return {name: done[name] for name in tables}
    finally:
        per_product.unpersist()


def run_nightly(spark: SparkSession, inputs: Inputs, run_name: str, models: Models = Models()) -> dict[str, int]:
    """Every stage once; returns the row count of each table written. After a failure, start it again under the same name."""
    run = Run(spark, run_name)
    written = load_bronze(spark, inputs, run)
    written |= bronze_to_silver(spark, models, run)
    validate_reviews(spark, run_name)
    written |= silver_to_gold(spark, run)
    written |= order_analytics(spark, models, run)
    written |= customer_analytics(lambda name: spark.table(DATABASE_TARGETS[name]), run=run)
    return written
