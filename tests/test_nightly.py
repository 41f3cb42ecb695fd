import dataclasses
import json

import pytest
import shop as data
from pyspark.sql import functions as F

from tillwork import schemas
from tillwork.plans import nightly, reports
from tillwork.sinks import tables
from tillwork.sources.files import read_preference_counts

REVIEWS = [
    {"review_id": f"R{n}", "product_id": f"P{1 + n % 3}", "customer_id": "C1", "rating": 1 + n % 5, "title": "t",
     "content": ["great and good", "awful", None][n % 3], "date": "2025-01-02", "verified_purchase": n % 2 == 0,
     "helpful_votes": 12 + n, "aspects": [{"name": "Quality", "rating": n % 5}]}
    for n in range(12)
]


def _write_inputs(folder):
    (folder / "reviews.json").write_text(json.dumps(REVIEWS))
    people = {}
    for customer, kind, value in data.PREFERENCES:
        if customer:
            people.setdefault(customer, []).append((kind, value))
    preferences = "".join(
        f"<customer><customer_id>{key}</customer_id>"
        + "".join(f"<preference><type>{k}</type>{f'<value>{v}</value>' if v else ''}</preference>" for k, v in found)
        + "</customer>"
        for key, found in people.items()
    )
    (folder / "preferences.xml").write_text(f"<customers>{preferences}</customers>")
    specifications = "".join(
        f"<product><product_id>{p}</product_id><specification><name>{n}</name><value>{v}</value></specification></product>"
        for p, n, v in data.SPECIFICATIONS
    )
    (folder / "specifications.xml").write_text(f"<products>{specifications}</products>")


def _inputs(folder, table):
    return nightly.Inputs(
        table=table,
        reviews=str(folder / "reviews.json"),
        preferences=str(folder / "preferences.xml"),
        specifications=str(folder / "specifications.xml"),
        reviews_layout="document",
        xml_layout="records",
    )


def test_every_stage_twice(spark, tmp_path, rows):
    _write_inputs(tmp_path)
    shop = data.Shop(spark)
    inputs = _inputs(tmp_path, lambda name: shop.table(name).withColumnsRenamed({"order_id": "'ORDER_ID'"}))
    first = nightly.run_nightly(spark, inputs, "night-1")
    second = nightly.run_nightly(spark, inputs, "night-2")
    assert first == second
    assert len(first) == 8 + 4 + 3 + 5 + 8
    assert all(spark.table(name).count() == count for name, count in first.items())
    assert first[schemas.BRONZE_ORDERS] == len(data.ORDERS)
    assert first["analytics_customer_stats"] == 3
    assert spark.table(schemas.BRONZE_ORDERS).columns[0] == "order_id"
    assert {row[0] for row in spark.table(schemas.SILVER_PRODUCT_REVIEWS).select("sentiment_score").collect()} == {
        "Positive", "Negative", "Neutral",
    }
    audit = spark.table(schemas.VALIDATION_RESULTS).select(
        "RunStatus", F.variant_get("RunId", "$.run_name", "string").alias("run")
    )
    assert rows(audit) == [(False, "night-1"), (False, "night-2")]
    assert spark.table(schemas.GOLD_PRODUCT_REVIEWS_ANALYTICS).agg(F.sum("total_reviews")).first()[0] == len(REVIEWS)

    sets = reports.dashboard(spark)
    counts = {name: df.count() for name, df in sets.items()}
    assert counts == {
        "kpis": 4, "categories": 3, "statuses": 3, "customers": 3, "states": 3, "products": 7, "reviews": 3,
        "review_specifications": 4, "battery_life": 1, "storage": 1, "preferences": 3,
    }
    kpis = {row.kpi: row.value for row in sets["kpis"].collect()}
    assert kpis["total_products"] == len(data.PRODUCTS)
    reports.export_top_preferences(spark.table(schemas.BRONZE_CUSTOMER_PREFERENCES), str(tmp_path / "export"))
    assert read_preference_counts(spark, str(tmp_path / "export")).count() == 3


def test_every_source_table_is_read_once(spark, tmp_path):
    _write_inputs(tmp_path)
    shop, asked = data.Shop(spark), []

    def table(name):
        asked.append(name)
        return shop.table(name)

    nightly.run_nightly(spark, _inputs(tmp_path, table), "night-3")
    assert sorted(asked) == sorted(nightly.DATABASE_TARGETS)


def test_the_partitioned_gold_table_prunes_by_month(spark, tmp_path):
    _write_inputs(tmp_path)
    nightly.run_nightly(spark, _inputs(tmp_path, data.Shop(spark).table), "night-4")
    months = spark.table(schemas.GOLD_PRODUCT_PERFORMANCE).where("order_month = timestamp_ntz'2024-05-01 00:00:00'")
    plan = months._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan and months.count() > 0


def _tables(spark, rows, written):
    return {name: rows(spark.table(name).select(*[F.col(c).cast("string") for c in spark.table(name).columns if c != "last_updated"])) for name in written}


class Broken(RuntimeError):
    pass


def test_a_run_that_fails_anywhere_goes_on_where_it_stopped(spark, tmp_path, rows, monkeypatch):
    """Every table in turn cannot be written; the same run started again writes what is missing, and only that."""
    _write_inputs(tmp_path)
    shop, asked = data.Shop(spark), []

    def table(name):
        asked.append(name)
        return shop.table(name)

    inputs = _inputs(tmp_path, table)
    whole = nightly.run_nightly(spark, inputs, "undisturbed")
    expected, audits = _tables(spark, rows, whole), spark.table(schemas.VALIDATION_RESULTS).count()
    write, append = tables.Replacement.write, nightly.append_rows
    order = list(whole)
    # One table of each group that is written together, and some that are written one after the other.
    stages = [order[0], order[8], "audit", order[12], order[15], order[17], order[19], order[20]]
    broken, wrote = [], []

    def failing_write(self, df):
        if broken and self.name == broken[0]:
            raise Broken(self.name)
        wrote.append(self.name)
        write(self, df)

    def failing_append(df, name):
        if broken and broken[0] == "audit":
            raise Broken(name)
        return append(df, name)

    monkeypatch.setattr(tables.Replacement, "write", failing_write)
    monkeypatch.setattr(nightly, "append_rows", failing_append)
    asked.clear()
    for name in stages:
        broken[:] = [name]
        with pytest.raises(Broken):
            nightly.run_nightly(spark, inputs, "disturbed")
    broken.clear()
    assert nightly.run_nightly(spark, inputs, "disturbed") == whole
    assert sorted(wrote) == sorted(whole), "every table was written once"
    assert sorted(asked) == sorted([*nightly.DATABASE_TARGETS, "customers"]), "read once, and again where the write failed"
    assert _tables(spark, rows, whole) == expected
    assert spark.table(schemas.VALIDATION_RESULTS).count() == audits + 1
    assert nightly.run_nightly(spark, inputs, "disturbed") == whole and len(wrote) == len(whole)
    # A table that somebody else has written since is an input that has changed.
    tables.overwrite_table(spark.table(schemas.BRONZE_CUSTOMERS), schemas.BRONZE_CUSTOMERS, note=tables.note_of(spark, schemas.BRONZE_CUSTOMERS))
    wrote.clear()
    nightly.run_nightly(spark, inputs, "disturbed")
    assert schemas.SILVER_CUSTOMERS in wrote and schemas.GOLD_CUSTOMER_INSIGHTS in wrote and schemas.SILVER_PRODUCTS not in wrote


def test_a_source_that_has_changed_is_not_shown(spark, tmp_path):
    _write_inputs(tmp_path)

    def changed():
        raise Broken("changed")

    inputs = dataclasses.replace(_inputs(tmp_path, data.Shop(spark).table), verify=changed)
    nightly.run_nightly(spark, _inputs(tmp_path, data.Shop(spark).table), "before")
    shown = tables.current_version(spark, schemas.BRONZE_ORDERS)
    with pytest.raises(Broken):
        nightly.run_nightly(spark, inputs, "refused")
    assert tables.current_version(spark, schemas.BRONZE_ORDERS) == shown
