"""Connected components of an edge list, as alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickline.llm.common import discard, stage


def _nearest(pairs: DataFrame) -> DataFrame:
    """Each u with its neighbours v and the least of them.  The minimum comes
    from an aggregate and a join (not a window), so a vertex with very many
    neighbours is combined before the shuffle and split by the skew join."""
    low = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(low, "u")


def components(edges: DataFrame) -> DataFrame:
    """Rows (id, root): every vertex of ``edges`` (columns u, v of type long)
    with the least vertex of its component.  Vertices without an edge, and
    edges from a vertex to itself, are left out."""
    e = stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    seen = None
    while True:
        # every vertex hands its larger neighbours to its least neighbour
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stage(_nearest(both).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct(), "edges")
        # every vertex hands its smaller neighbours, and itself, to the least
        small = _nearest(large)
        old, e = e, stage(small.select("u", F.col("m").alias("v")).unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct(), "edges")
        discard(old, large)
        now = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now == seen:
            return e.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
        seen = now
