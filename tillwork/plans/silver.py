"""Silver layer: nested children, sentiment labels, places."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillwork.functions.text import Scorer, lexicon_score, with_sentiment, with_state
from tillwork.operators.joins import join_suffix
from tillwork.operators.nesting import nest_children


def nested_preferences(preferences: DataFrame) -> DataFrame:
    fields = {"preference_type": "TYPE", "preference_value": "VALUE"}
    return nest_children(preferences, "customer_id", fields, "preferences")


def nested_specifications(specifications: DataFrame) -> DataFrame:
    fields = {"spec_name": "NAME", "spec_value": "VALUE"}
    return nest_children(specifications, "product_id", fields, "specifications")


def silver_customers(customers: DataFrame, nested: DataFrame) -> DataFrame:
    """Customers with their preference array; the key of the array side is ``customer_id_right``."""
    return join_suffix(customers, nested, "customer_id")


def silver_products(products: DataFrame, nested: DataFrame) -> DataFrame:
    """Products with their specification array; the key of the array side is ``product_id_right``."""
    return join_suffix(products, nested, "product_id")


def silver_reviews(reviews: DataFrame, scorer: Scorer = lexicon_score) -> DataFrame:
    return with_sentiment(reviews, "content", scorer)


def silver_orders(orders: DataFrame, customers: DataFrame, extractor: Scorer | None = None) -> DataFrame:
    """Orders with the state of their customer."""
    states = with_state(customers.select("customer_id", "address"), "address", extractor)
    return orders.join(states.select("customer_id", "state"), "customer_id", "left")
