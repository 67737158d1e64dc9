"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); the root is the smallest node reached.

    Each round hangs a node's larger neighbours on its smallest one, then a
    node and its smaller neighbours on the smallest of them, until every edge
    points at a root; the rounds grow with the logarithm of the longest chain.
    Each round is written to the checkpoint folder, so lineage stays short.
    """
    edges = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large.filter("a <> b"), "stars")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        edges = materialize(small.filter("a <> b").distinct(), "edges")
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return materialize(roots.union(edges.select("b", "b")).distinct(), "components")
        before = state
