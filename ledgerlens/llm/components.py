"""Connected components of links, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b, longs): root
    is the smallest node that can be reached. Large-star and small-star steps
    in turn: the edges only ever get fewer or point lower, and a step never
    gathers a node's neighbours (minimum by partial aggregation, then a join that
    can split a hot node). Each round is a written table; rounds grow with the
    logarithm of the nodes. Self-links and repeated links do no harm; no links
    give no rows."""
    edges = written(links.filter("a is not null and b is not null").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        # large star: higher neighbours of a node go to the least it knows
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = large.union(edges.filter("u = v")).distinct()
        # small star: a node and its lower neighbours go to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = written(small.select("e.u", "e.v").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
        before = tuple(now)
