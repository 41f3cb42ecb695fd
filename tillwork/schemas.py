"""Column names and types of the logical tables.

Money is ``DECIMAL(12,2)`` so that sums are exact and do not depend on the order in which
partitions arrive. Timestamps carry no zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
MOMENT = T.TimestampNTZType()


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


def _texts(*names: str) -> dict[str, T.DataType]:
    return dict.fromkeys(names, T.StringType())


# The columns of the source tables.
_LOADED = {"created_date": MOMENT, "last_updated": MOMENT}

CUSTOMERS = _table(**_texts("customer_id", "first_name", "last_name", "email", "phone", "address"), **_LOADED)
PRODUCTS = _table(
    **_texts("product_id", "product_name", "category"), price=MONEY, **_texts("description"), **_LOADED
)
ORDERS = _table(
    **_texts("order_id", "customer_id"), order_date=MOMENT, total_amount=MONEY,
    **_texts("status", "payment_method"), **_LOADED,
)
ORDER_ITEMS = _table(
    **_texts("order_id", "product_id"), quantity=T.IntegerType(), unit_price=MONEY, **_LOADED
)
INVENTORY = _table(
    **_texts("inventory_id", "product_id"), quantity=T.IntegerType(), **_texts("warehouse_id"),
    last_updated=MOMENT,
)

DATABASE_TABLES = {
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "inventory": INVENTORY,
    "order_items": ORDER_ITEMS,
}

ASPECTS_TYPE = "array<struct<name:string,rating:double>>"
ASPECT_TYPE = "struct<name:string,rating:double>"

# Scalars arrive as text, so quoted and bare JSON values load alike and the casts below decide.
REVIEWS_JSON = _table(
    **_texts(
        "review_id", "product_id", "customer_id", "rating", "title", "content", "date",
        "verified_purchase", "helpful_votes",
    ),
    aspects=T.VariantType(),
)

# The array type is stated because inference would read a single child as a struct.
PREFERENCES_XML = _table(
    **_texts("customer_id"), preference=T.ArrayType(_table(**_texts("type", "value")))
)
SPECIFICATIONS_XML = _table(
    **_texts("product_id"), specification=T.ArrayType(_table(**_texts("name", "value")))
)

PREFERENCE_COUNTS = _table(**_texts("preference"), count=T.LongType())

SPECIFICATIONS_TYPE = "array<struct<NAME:string,VALUE:string>>"

# Table names that readers of the warehouse already use.
BRONZE_CUSTOMERS = "BRONZE_CUSTOMERS"
BRONZE_PRODUCTS = "BRONZE_PRODUCTS"
BRONZE_INVENTORY = "BRONZE_INVENTORY"
BRONZE_ORDERS = "BRONZE_ORDERS"
BRONZE_ORDER_ITEMS = "BRONZE_ORDER_ITEMS"
BRONZE_PRODUCT_REVIEWS = "BRONZE_PRODUCT_REVIEWS"
BRONZE_CUSTOMER_PREFERENCES = "BRONZE_CUSTOMER_PREFERENCES"
BRONZE_PRODUCT_SPECIFICATIONS = "BRONZE_PRODUCT_SPECIFICATIONS"
SILVER_CUSTOMERS = "SILVER_CUSTOMERS"
SILVER_PRODUCTS = "SILVER_PRODUCTS"
SILVER_PRODUCT_REVIEWS = "SILVER_PRODUCT_REVIEWS"
SILVER_ORDERS = "SILVER_ORDERS"
GOLD_CUSTOMER_INSIGHTS = "GOLD_CUSTOMER_INSIGHTS"
GOLD_PRODUCT_REVIEWS_ANALYTICS = "GOLD_PRODUCT_REVIEWS_ANALYTICS"
GOLD_PRODUCT_PERFORMANCE = "GOLD_PRODUCT_PERFORMANCE"
VALIDATION_RESULTS = "GreatExpeactionValidationsResults"
