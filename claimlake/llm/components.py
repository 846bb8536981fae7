"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from claimlake.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b``; ``root`` is the smallest node reachable (also for itself).

    A large-star step links each node's larger neighbours to its smallest one, a small-star step its smaller
    neighbours and itself. Both keep what is reachable and end in stars, after some log n rounds. Every round is
    a written table. Minima are pre-aggregated, and the joins leave a hub's many rows to adaptive execution's skew
    splitting; no component is ever gathered in one task.
    """
    now = _smaller_last(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    now, mark = _kept(now)
    while mark["edges"]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _smaller_last(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        before = mark
        now, mark = _kept(_smaller_last(small))
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _smaller_last(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _kept(edges: DataFrame) -> tuple[DataFrame, dict]:
    """The edges as a written table, with their number and a digest of them, whatever their order, from the same job."""
    seen = Observation()
    watched = edges.observe(seen, F.count(F.lit(1)).alias("edges"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("digest"))
    table = stored(watched, "edges")
    return table, {"edges": 0, "digest": None} | seen.get
