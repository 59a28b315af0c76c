"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.common import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Tie neighbours of each node to the smallest of them; minima are found before rows are joined."""
    if large:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        lowest = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return near.where("v > u").join(lowest, "u").select(F.col("v").alias("b"), F.col("m").alias("a"))
    down = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    lowest = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(lowest, "u").where("v <> m").select(F.col("v").alias("b"), F.col("m").alias("a"))
    return tied.union(lowest.select(F.col("u").alias("b"), F.col("m").alias("a")))


def components(edges: DataFrame) -> DataFrame:
    """Columns a, b (long) of links -> node, root: the smallest node that it reaches.

    Only nodes with a link to another node come out. Null ends and loops are
    left out. Each round is written to the shared folder; the driver sees a
    count and a checksum.
    """
    ends = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    current = stage(ends.distinct(), "links")
    seen = None
    while True:
        sign = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sign == seen or not sign[0]:
            return current.select(F.col("b").alias("node"), F.col("a").alias("root"))
        seen = sign
        current = stage(_star(_star(current, True).distinct(), False).select("a", "b").distinct(), "links")
