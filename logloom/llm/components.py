"""Connected components by alternating large-star and small-star rounds.

Each round is a few joins and minimum aggregations over the edge table, written
to the shared folder; no links or labels reach the driver, which only sees a
count and a checksum to tell when nothing changes any more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logloom.llm.common import discard, staged


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) -> (node, root), root the least node of the component.

    Nodes without an edge don't appear.  Self-loops and repeated edges are
    allowed, nulls are not.
    """
    stars = staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while (now := _sum(stars)) != before:
        last = stars
        before, stars = now, staged(_round(last), "stars")
        discard(last)
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).union(stars.select("b", "b").distinct())


def _sum(stars: DataFrame):
    return stars.select(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def _round(stars: DataFrame) -> DataFrame:
    """Links go from the greater node a to the lesser b."""
    both = stars.union(stars.select("b", "a")).toDF("a", "b")
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.union(least).distinct()
