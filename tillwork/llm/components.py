"""Connected components of a link table, by alternating star contraction on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm import tables


def connected(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(vertex, component) for every vertex of the undirected ``links(a, b)``; the component is its smallest vertex.

    Each round hangs the larger neighbours of a vertex on its smallest one, then the smaller ones. Links
    only ever move towards the smallest vertex, so the rounds end with one star per component, after
    about log(n) of them. The state is a written table, never held by the driver. An empty link table
    gives no rows.
    """
    edges = tables.cut(
        spark,
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("vertex"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("vertex"), F.col("b").alias("component")).distinct()
            )
        before = state
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges = _hang(both, F.col("b") > F.col("a"))
        edges = tables.cut(spark, _hang(edges, F.lit(True), itself=True), "links")


def _hang(edges: DataFrame, chosen, itself: bool = False) -> DataFrame:
    """Per ``a``: its chosen neighbours, and itself if asked, linked to the smallest of ``a`` and its neighbours."""
    smallest = edges.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    hung = edges.where(chosen).join(smallest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    if itself:
        hung = hung.union(smallest.select("a", F.col("low").alias("b")))
    return hung.where("a <> b").distinct()
