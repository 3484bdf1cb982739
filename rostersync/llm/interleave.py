"""Sharding by proportional stratified interleaving, with DataFrame operations only.

Rows are shuffled by a seeded hash and ranked within their source. Rank r of n gets the fractional rank
(r - 1/2) / n. In the order of fractional ranks every stretch holds the sources in their overall
proportions, so equal cuts of that order are shards with the same mixture.

No window spans a source or the table. Within a source rows are counted per small cell of their hashes, the
running sum over the counts gives each cell its offset, and only inside a cell rows are numbered. The order
of all rows is cut into ranges instead, since many small sources share their fractional ranks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostersync.llm.common import col, hash_key
from rostersync.operators.staging import broadcast_if_small, materialise

#: Rows a cell holds on average; a window over one cell sorts that many.
CELL_ROWS = 4096


def _numbered(rows: DataFrame, group: str, cell: str, order: list[Column | str], label: str) -> DataFrame:
    """Adds ``rank`` (from 0, in ``group`` by cell and order) and ``n`` (rows of the group)."""
    keys = [group]
    counts = rows.groupBy(*keys, cell).agg(F.count("*").alias("rows"))
    counts = materialise(counts, label)
    upto = Window.partitionBy(*keys).orderBy(cell)
    whole = Window.partitionBy(*keys)
    offsets = counts.select(
        *[F.col(k).alias("of") for k in keys],
        F.col(cell).alias("at"),
        (F.sum("rows").over(upto) - F.col("rows")).alias("offset"),
        F.sum("rows").over(whole).alias("n"),
    )
    offsets = materialise(offsets, label)
    on = rows[group].eqNullSafe(offsets["of"]) & (rows[cell] == offsets["at"])
    within = Window.partitionBy(*keys, cell).orderBy(*order)
    joined = rows.join(broadcast_if_small(offsets), on)
    return joined.withColumn("rank", F.col("offset") + F.row_number().over(within) - 1).drop("of", "at", "offset")


def _numbered_by_range(rows: DataFrame, order: list[Column], label: str) -> DataFrame:
    """Adds ``rank`` (from 0, in the order of all rows) and ``n`` (all rows).

    The order is cut into ranges of about equal numbers of rows, also where many rows agree in its first
    column. Where it is cut depends on a sample, so the ranges are written down; the ranks don't.
    """
    ranges = materialise(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), label)
    sizes = ranges.groupBy("range").agg(F.count("*").alias("rows"))
    # One row a range, as many as there are shuffle partitions.
    upto = Window.orderBy("range")
    offsets = sizes.select(
        F.col("range").alias("at"), (F.sum("rows").over(upto) - F.col("rows")).alias("offset"),
        F.sum("rows").over(Window.partitionBy()).alias("n"),
    )
    joined = ranges.join(broadcast_if_small(materialise(offsets, label)), F.col("range") == F.col("at"))
    within = Window.partitionBy("range").orderBy(*order)
    return joined.withColumn("rank", F.col("offset") + F.row_number().over(within) - 1).drop("at", "offset", "range")


def interleave(
    docs: DataFrame,
    shards: int = 8,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 5,
) -> DataFrame:
    """Shard and slot of every row; the law is ``rows``: shard sizes differ by one row at most.

    Returns ``doc_id``, ``source``, ``size`` (UTF-8 bytes of the text plus 1), ``text_crc32`` (null
    for a null text), ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0). A null source is a
    stratum of its own, a null text has size 1. Rows that agree in id, text and source are
    interchangeable; among them the numbering is arbitrary, the multiset of results is not. An empty
    table gives no rows. Other columns are not looked at.
    """
    body = col(text)
    rows = materialise(
        docs.select(
            col(doc_id).alias("doc_id"),
            col(source).alias("source"),
            (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            hash_key(col(doc_id), body, seed=seed).alias("key"),
        ),
        "shard-rows",
    )
    total = rows.count()
    cells = max(1, -(-total // CELL_ROWS))
    tie = ["key", "doc_id", "text_crc32", "size"]
    # The key's leading bits; a source with a third of all rows has cells of a third of CELL_ROWS.
    rows = rows.withColumn("cell", F.floor(F.col("key") / F.lit(2.0**60) * cells).cast("long"))
    ranked = _numbered(rows, "source", "cell", tie, "shard-ranks").withColumn("part", (F.col("rank") + 0.5) / F.col("n"))
    ranked = materialise(ranked.select("doc_id", "source", "size", "text_crc32", "rank", "part"), "shard-ranked")
    order = [F.col("part"), F.col("source").asc_nulls_last(), F.col("place")]
    placed = _numbered_by_range(ranked.withColumnRenamed("rank", "place"), order, "shard-places")
    # Shard s takes the positions from ceil(s * n / shards) on.
    shard = F.floor(F.col("rank") * shards / F.col("n")).cast("int")
    first = F.ceil(F.col("shard") * F.col("n") / shards).cast("long")
    return (
        placed.withColumn("shard", shard)
        .withColumn("slot", F.col("rank") - first)
        .select("doc_id", "source", "size", "text_crc32", "shard", "slot")
    )
