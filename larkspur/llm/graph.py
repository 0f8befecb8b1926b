"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import written


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, component`` for the ends of ``edges`` (``a, b``, 64-bit integers) that aren't their component's smallest.

    The component is its smallest node.  Rounds of large-star and small-star: each node
    first links its larger neighbours, then its smaller ones, to the smallest node that
    it knows, until nothing changes; the number of rounds grows with the logarithm of
    the longest path.  Edges are written once a round to the shared folder.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    for _ in range(max_rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u != v").distinct()
        now = written(small, "edges")
        # Done when all are stars: one edge for each node but the centres, which have none.
        ends = now.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).union(now.select("v", F.lit(0), F.lit(1)))
        if ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1").isEmpty():
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    raise RuntimeError(f"no fixpoint after {max_rounds} rounds")
