"""Connected components of an edge table, without collecting links or groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo.llm.frames import stored


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)``: the smallest id reachable from each id of ``edges``.

    ``edges`` has columns ``a`` and ``b``; null ends and loops are ignored, no
    edges give no rows. Each round is one small-star and one large-star step:
    the neighbours of a vertex are linked to the smallest of them, which keeps
    components and ends in stars after a logarithmic number of rounds. Steps are
    aggregates and joins on vertex ids; the driver sees two row counts a round.
    """
    ends = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    ends = stored(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        # Small star: b is the smaller end; a vertex and its smaller neighbours go to the smallest.
        smallest = ends.groupBy("a").agg(F.min("b").alias("low"))
        linked = ends.join(smallest, "a")
        moved = linked.select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").unionByName(
            smallest.select("a", F.col("low").alias("b"))
        )
        # Large star: the larger neighbours of a vertex go to the smallest around it, itself included.
        moved = moved.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        both = moved.unionByName(moved.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        grown = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        ends = stored(grown.distinct(), "edges")
        # A star forest: every vertex has one edge, and no centre is a leaf.
        many = ends.groupBy("a").count().where("count > 1").limit(1).count()
        if not many and not ends.join(ends.select(F.col("b").alias("a")).distinct(), "a", "left_semi").limit(1).count():
            break
    tips = ends.select(F.col("a").alias("id"), F.col("b").alias("component"))
    centres = ends.select(F.col("b").alias("id")).distinct()
    return tips.unionByName(centres.select("id", F.col("id").alias("component")))

