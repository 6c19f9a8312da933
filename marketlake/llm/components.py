"""Connected components of a graph given by its edges, in rounds of joins; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import release, written


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node that an edge (a, b) of `edges` touches.

    Large-star and small-star rounds in turn: every node hands its larger neighbours, then its smaller ones, to the
    smallest node near it, until only stars are left; that takes a number of rounds that grows as a power of the logarithm
    of the longest path. A hub's edges are joined, never gathered, so a hub may be of any size: minima are taken before
    the shuffle, and the other side of each join has one row a node, so adaptive execution can split a hub's edges.
    Edges with a null end are left out.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where((F.col("a") != F.col("b"))).distinct()
    e = written(e, "edges")
    if e.isEmpty():
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    mark = None
    while True:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        last, e = e, written(small, "edges")
        release(last)
        # the stars have settled once neither their number nor their centres change
        now = e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("decimal(20,0)")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v").distinct().toDF("node", "component"))
        mark = now
