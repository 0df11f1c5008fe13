"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spliceloom.session import durable


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the smallest node of its component.

    Each round links larger neighbours, then smaller ones, to the smallest neighbour. Only minima are grouped, so a node
    with any number of neighbours is combined on the map side; rounds grow with the logarithm of the component size.
    """
    now = durable(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter(F.col("u") != F.col("v")).distinct())
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter(F.col("u") != F.col("v")).unionByName(least.withColumnRenamed("m", "v"))
        new = durable(small.distinct())
        # done when every node has one edge and no root has one
        tops = new.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
        if tops.filter("n > 1").isEmpty() and new.join(tops.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            return new.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(new.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        now = new
