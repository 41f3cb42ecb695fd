"""A small shop with the awkward cases, as plain Python rows and as DataFrames."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from tillwork import schemas

DAY = dt.datetime(2024, 5, 1)


def _money(text):
    return None if text is None else Decimal(text)


# customer_id, first, last, address
CUSTOMERS = [
    ("C1", "Ann", "Ames", "1 Pine St, Austin"),
    ("C2", "Bob", "Burr", "Boston"),
    ("C3", "Cem", None, None),
    ("C4", "Dee", "Dorn", "9 Oak Ave,  Denver , CO"),
    ("C5", "Eve", "East", "3 Elm St, Austin"),
]

# product_id, name, category, price
PRODUCTS = [
    ("P1", "Lamp", "Home", "10.00"),
    ("P2", "Desk", "Home", "99.99"),
    ("P3", "Mouse", "Office", "25.50"),
    ("P4", "Ghost", None, "1.00"),
    ("P5", "Unsold", "Toys", "5.00"),
    ("P6", "Rug", "Home", "45.10"),
]

# order_id, customer_id, date, amount, status, payment
ORDERS = [
    ("O1", "C1", dt.datetime(2024, 5, 3, 10), "50.00", "Shipped", "Card"),
    ("O2", "C1", dt.datetime(2024, 6, 30, 23, 59, 59), "20.00", "Shipped", "PayPal"),
    ("O3", "C2", dt.datetime(2024, 5, 9), "75.25", "Pending", "Card"),
    ("O4", "C3", dt.datetime(2024, 7, 1), "12.00", "Cancelled", None),
    ("O5", "C9", dt.datetime(2024, 7, 2), "8.00", "Pending", "Card"),
    ("O6", None, dt.datetime(2024, 7, 2), "3.00", None, "Card"),
    ("O7", "C5", dt.datetime(2024, 5, 3), None, "Pending", "Card"),
]

# order_id, product_id, quantity, unit_price
ITEMS = [
    ("O1", "P1", 2, "10.00"),
    ("O1", "P1", 1, "11.00"),
    ("O1", "P3", 1, "25.50"),
    ("O2", "P1", 1, "10.00"),
    ("O2", "PX", 4, "2.50"),
    ("O3", "P2", 1, "99.99"),
    ("O3", "P4", 3, "1.00"),
    ("O4", "P3", 2, "25.50"),
    ("O5", "PX", 1, "7.00"),
    ("O5", None, 1, "7.00"),
    ("O6", "P6", 5, "45.10"),
    ("O8", "P6", 1, "45.10"),
]

# product_id, quantity, warehouse
INVENTORY = [
    ("P1", 5, "W1"), ("P1", 7, "W2"), ("P2", None, "W1"), ("P3", 4, None), (None, 9, "W2"), ("PX", 3, "W3"),
]

PREFERENCES = [("C1", "Colour", "Red"), ("C1", "Colour", "Red"), ("C1", "Channel", "Mail"), ("C2", "Size", None), (None, "A", "B")]

SPECIFICATIONS = [
    ("P1", "Battery Life", "12 hours"), ("P1", "STORAGE", "64 GB"), ("P1", "battery life", "9 hours"),
    ("P2", "storage", "none"), ("PX", "storage", "8 GB"),
]


class Shop:
    def __init__(self, spark):
        self.spark = spark

    def _make(self, schema, rows):
        return self.spark.createDataFrame(rows, schema)

    @property
    def customers(self):
        return self._make(
            schemas.CUSTOMERS, [(c, f, l, f"{f}@x.org", "1", a, DAY, DAY) for c, f, l, a in CUSTOMERS]
        )

    @property
    def products(self):
        return self._make(schemas.PRODUCTS, [(p, n, c, _money(m), "d", DAY, DAY) for p, n, c, m in PRODUCTS])

    @property
    def orders(self):
        return self._make(schemas.ORDERS, [(o, c, d, _money(m), s, p, DAY, DAY) for o, c, d, m, s, p in ORDERS])

    @property
    def items(self):
        return self._make(schemas.ORDER_ITEMS, [(o, p, q, _money(m), DAY, DAY) for o, p, q, m in ITEMS])

    @property
    def inventory(self):
        return self._make(
            schemas.INVENTORY, [(f"I{i}", p, q, w, DAY) for i, (p, q, w) in enumerate(INVENTORY)]
        )

    @property
    def preferences(self):
        return self.spark.createDataFrame(
            PREFERENCES, "customer_id string, preference_type string, preference_value string"
        )

    @property
    def specifications(self):
        return self.spark.createDataFrame(SPECIFICATIONS, "product_id string, spec_name string, spec_value string")

    def table(self, name):
        return {
            "customers": self.customers, "products": self.products, "orders": self.orders,
            "order_items": self.items, "inventory": self.inventory,
        }[name]
