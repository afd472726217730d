"""Connected components of an edge table by alternating large-star and small-star rounds.

Every round is two aggregations with map-side partial minima and two equi-joins.
The minima are written before the join, so that both its sides are plain
exchanges, which AQE can split where a node has very many edges.  No edge, node or label is
collected; the driver sees one row of totals a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import discard, stage


def _both(e: DataFrame) -> DataFrame:
    return e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """Rows (node, root) for every node with an edge to another one; root is the smallest node of the component.

    Nulls and loops are ignored, repeated edges count once; no edges give no rows.
    """
    e = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u is not null and v is not null and u <> v")
    e = stage(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while True:
        # a star forest has no node that is both a larger and a smaller end, and one smaller end a node
        sums = e.groupBy("u").agg(F.count("*").alias("n"))
        many = sums.where("n > 1").limit(1).count()
        if not many and not e.select(F.col("v").alias("u")).join(e, "u", "left_semi").limit(1).count():
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        both = _both(e)
        least = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = stage(large.distinct(), "large-star")
        low = stage(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        kept = large.join(low, "u")
        small = kept.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        after = stage(small.distinct(), "small-star")
        for done in (e, least, large, low):
            discard(done)
        e = after
