"""Connected components of a graph whose links are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.tables import checkpointed


def _with_nearest(pairs: DataFrame) -> DataFrame:
    """The pairs (u, v) with the smallest v of their u. Both inputs of the join are written, so that Spark can split the
    rows of a node with very many links."""
    return pairs.join(checkpointed(pairs.groupBy("u").agg(F.min("v").alias("least"))), "u")


def components(links: DataFrame) -> DataFrame:
    """(node, label) for all nodes in the links (a, b), which are numbers; the label is the smallest of the component.

    Alternates two steps until each node has one link, to a node that has none itself: each node links its larger
    neighbours to the smallest of its neighbours and itself, then its smaller ones and itself.
    """
    pair = lambda u, v: F.struct(F.col(u).alias("u"), F.col(v).alias("v"))
    current = checkpointed(links.select("a", "b").filter("a != b").distinct())
    while True:
        both = current.select(F.explode(F.array(pair("a", "b"), pair("b", "a"))).alias("p")).select("p.u", "p.v")
        large = _with_nearest(both).filter("v > u").select(F.col("v").alias("u"), F.least("u", "least").alias("v"))
        small = _with_nearest(checkpointed(large.distinct()))
        ends = F.explode(F.array("u", "v")).alias("a")
        current = checkpointed(small.select(ends, F.col("least").alias("b")).filter("a != b").distinct())
        marks = current.select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.lit(1).alias("k")), F.struct(F.col("b").alias("x"), F.lit(0).alias("k")))).alias("m"))
        marks = marks.groupBy("m.x").agg(F.sum("m.k").alias("out"), F.min("m.k").alias("root"))
        if marks.filter("out > 1 or (out = 1 and root = 0)").isEmpty():
            labelled = current.select(F.col("a").alias("node"), F.col("b").alias("label"))
            return labelled.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
