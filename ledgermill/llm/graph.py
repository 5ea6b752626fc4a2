"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import settle


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (both.join(least, "u").where("v > u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).where("u <> v").distinct())


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v): for each node with an edge to a smaller one in its component, the component's least node.

    `edges` has the long columns u and v.  Every round is written to the shared folder; the rounds
    end when a round changes nothing, after a number that grows with the logarithm of the longest
    path.  A node with very many edges is pre-aggregated for its minimum and left to adaptive skew
    joins for its edges.
    """
    now = settle(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == before or not seen[0]:
            return now
        before = seen
        now = settle(_small(_large(now)), "edges")
