"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goalpost.llm.common import saved


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge; root is the least node of its component.

    Each step joins every edge to its node's least neighbour, a per-node aggregate, so a hub is many small rows and
    never one group; every round is written to the shared folder.  Null ends and loops are no edges."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = (e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
                if large else e)
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        joined = both.join(least, "u")
        if large:
            out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
                joined.select("u", F.col("m").alias("v")))
        # larger end first
        return (out.where(F.col("u") != F.col("v"))
                   .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())

    def mark(e: DataFrame) -> tuple:
        r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    now = saved(edges.where(F.col(a) != F.col(b))
                     .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "star")
    seen = mark(now)
    while seen[0]:
        now = saved(star(star(now, True), False), "star")
        last, seen = seen, mark(now)
        if last == seen:
            break
    return (now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
               .unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
