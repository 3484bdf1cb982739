"""Connected components of a graph whose links are a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostersync.operators.staging import materialise


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(a, b) numbers -> (node, root): every node of a link with the smallest node it is connected to.

    Alternates two steps until nothing changes: each node passes the smallest of its neighbourhood to its
    larger neighbours, then each node hangs its smaller neighbours on the smallest of them. Both are an
    aggregation and a join, so that a node with many links is split like any hot key. Every round is
    written down. Self-links and repeated links do not matter; no links give no rows.
    """
    ordered = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = materialise(ordered.distinct(), "links")
    mark = _mark(now)
    while mark[0]:
        near = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = near.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
        large = near.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        large = materialise(large, "links")
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        now = materialise(small.unionByName(least.select("a", F.col("least").alias("b"))).distinct(), "links")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
