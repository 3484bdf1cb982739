"""Keys that hold very many rows, from a sketch of constant size."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys a sketch keeps track of, keys it may report, and the partial sketches that are merged by tasks of their own.
TRACKED, REPORTED, PARTS = 10_000, 1_000, 64


@dataclass(frozen=True)
class HotKeys:
    """The keys of one column with more rows than a limit, with about how many each has.

    At most ``REPORTED`` keys. Counts are off by at most 4 rows in ``TRACKED``; a key with fewer rows than
    that, in a table so large that it still exceeds the limit, may be missing: it is a smaller share of
    the table than any task's. What uses the list only spreads rows by it, so no result depends on it.
    """

    counts: tuple[tuple[str, int], ...]

    def relation(self, like: DataFrame, name: str, count: str) -> DataFrame:
        """As a relation of two columns; small by construction."""
        return like.sparkSession.createDataFrame(list(self.counts), f"`{name}` string, `{count}` long")


def hot_keys(df: DataFrame, key: Column, limit: int, tracked: int = TRACKED, most: int = REPORTED) -> HotKeys:
    """Keys of ``df``, as text, with more than ``limit`` rows; NULLs do not count.

    One pass over the key column. Each task fills a sketch, so no key is shuffled; sketches are merged in
    two steps, lest one task merge those of all tasks.
    """
    rows = df.select(key.cast("string").alias("k"), F.pmod(F.spark_partition_id(), F.lit(PARTS)).alias("part")).where("k IS NOT NULL")
    parts = rows.groupBy("part").agg(F.expr(f"approx_top_k_accumulate(k, {tracked})").alias("sketch"))
    whole = F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {tracked}), {most})")
    # Grouped by a constant: without any row there is no sketch to merge, and no group.
    found = parts.groupBy(F.lit(0).alias("all")).agg(whole.alias("found")).first()
    return HotKeys(tuple((r["item"], r["count"]) for r in (found["found"] if found else ()) if r["count"] > limit))
