"""The logical tables over the benchmark's Parquet tables.

Every adapter keeps all rows of its table. Missing keys and texts, which the Parquet tables do not
have, come from attributes: orders in status P are guest orders without a customer, lines taxed at
8 % are of delisted products, and two market segments have no full address.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class DriverTables:
    """Lazy logical tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def customers(self) -> DataFrame:
        name = F.col("c_name")
        full = F.concat(F.col("c_custkey").cast("string"), F.lit(" Main St, "), F.col("n_name"))
        address = (
            F.when(F.col("c_mktsegment") == "BUILDING", F.col("n_name"))
            .when(F.col("c_mktsegment") == "MACHINERY", F.lit(None))
            .otherwise(full)
        )
        nation = self.raw("nation").select("n_nationkey", "n_name")
        return self.raw("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("customer_id"),
            F.split_part(name, F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part(name, F.lit("#"), F.lit(2)).alias("last_name"),
            address.alias("address"),
        )

    @property
    def orders(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("customer_id"),
            F.col("o_orderdate").alias("order_date"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("payment_method"),
        )

    @property
    def order_items(self) -> DataFrame:
        product = F.when(F.col("l_tax") >= 0.08, -1 - F.col("l_partkey")).otherwise(F.col("l_partkey"))
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            product.alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("unit_price"),
        )

    @property
    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").cast("decimal(12,2)").alias("price"),
        )

    @property
    def inventory(self) -> DataFrame:
        product = F.when(F.col("l_returnflag") == "R", -1 - F.col("l_partkey")).otherwise(F.col("l_partkey"))
        return self.raw("lineitem").select(
            product.alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_suppkey").alias("warehouse_id"),
        )

    @property
    def preferences(self) -> DataFrame:
        return self.raw("conversations").select(
            F.col("conv_id").alias("customer_id"),
            F.col("role").alias("preference_type"),
            F.col("turn").cast("string").alias("preference_value"),
        )

    @property
    def specifications(self) -> DataFrame:
        size = F.col("p_size")
        specs = F.array(
            F.struct(F.lit("Battery Life").alias("spec_name"), F.concat(size.cast("string"), F.lit(" hours")).alias("spec_value")),
            F.struct(F.lit("storage").alias("spec_name"), F.concat((size * 8).cast("string"), F.lit(" GB")).alias("spec_value")),
            F.struct(F.lit("Brand").alias("spec_name"), F.col("p_brand").alias("spec_value")),
        )
        return self.raw("part").select(F.col("p_partkey").alias("product_id"), F.inline(specs))

    @property
    def reviews(self) -> DataFrame:
        """Events as reviews; the text is that of the document of the same id."""
        return self._with_texts(self.review_facts)

    @property
    def unrounded_reviews(self) -> DataFrame:
        """Reviews as a source would send them, their ratings with decimals."""
        return self._with_texts(self._review_facts(F.col("value").cast("decimal(12,2)")))

    @property
    def review_facts(self) -> DataFrame:
        """All of a review but its text."""
        return self._review_facts(F.round(F.col("value").cast("decimal(12,2)"), 0).cast("decimal(38,0)"))

    def _with_texts(self, facts: DataFrame) -> DataFrame:
        texts = self.raw("documents").select(F.col("doc_id").alias("_doc_id"), F.col("text").alias("content"))
        joined = facts.join(texts, facts["review_id"] == texts["_doc_id"], "left")
        names = facts.columns
        return joined.select(*names[: names.index("title") + 1], "content", *names[names.index("title") + 1 :])

    def _review_facts(self, rating) -> DataFrame:
        """Views carry no aspects."""
        votes = F.col("_votes")
        half = votes / F.lit(2.0)

        def aspect(name: str, rating):
            return F.struct(F.lit(name).alias("name"), rating.cast("double").alias("rating"))

        kind = F.col("event_type")
        aspects = (
            F.when(kind == "click", F.array(aspect("Quality", votes)))
            .when(kind == "purchase", F.array(aspect("Quality", votes), aspect("Battery Life", half)))
            .when(
                kind == "signup",
                F.array(aspect("Value for Money", votes), aspect("Quality", half), aspect("Quality", votes)),
            )
            .when(kind == "error", F.array(aspect("Packaging", votes)))
            .otherwise(F.expr("cast(array() as array<struct<name:string,rating:double>>)"))
        )
        # A column of its own, so that the JSON is parsed once per event.
        events = self.raw("events").withColumn("_votes", F.get_json_object("props", "$.k").cast("int"))
        return events.select(
            F.col("event_id").alias("review_id"),
            F.col("user_id").alias("product_id"),
            F.col("user_id").alias("customer_id"),
            rating.alias("rating"),
            kind.alias("title"),
            F.col("ts").cast("date").alias("review_date"),
            F.when(kind == "purchase", "true").otherwise("false").alias("verified_purchase"),
            votes.cast("long").alias("helpful_votes"),
            aspects.alias("aspects"),
        )

    @property
    def review_texts(self) -> DataFrame:
        return self.raw("documents").select(F.col("doc_id").alias("review_id"), F.col("text").alias("content"))
