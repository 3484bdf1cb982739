"""Mixing sources to target weights by hash thresholds, without a sort of the documents.

Each document has a hash key made of its id. A source keeps the documents whose key is at most its
threshold. The threshold comes from histograms: sizes summed by (source, bucket of the key), a running
sum over the buckets, and then the same again inside the one bucket where the budget is crossed. Two
such rounds leave a 2^24th of a source, in which the running sum goes over single keys. Larger budgets
have larger thresholds, so the mixes of several budgets are nested.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostersync.llm.common import col, packed
from rostersync.operators.staging import broadcast_if_small, materialise

KEY_BITS, BUCKET_BITS = 60, 12


def mix_key(doc_id: Column, seed: int) -> Column:
    """60 bits of MD5, which every engine has."""
    text = F.concat(F.lit(f"{seed}/"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """(source, source_size) -> the same with target.

    Sources by code point (null last) weigh ``weights`` in turn and divide ``share`` times all sizes;
    no target is above ``most`` times its source's size, the excess goes to the others by weight.
    One row per source; the windows run over sources, never over documents.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, -1)
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * F.lit(float(most))
    filled = (
        sizes.withColumn("place", place)
        .withColumn("weight", weight)
        .withColumn("cap", cap)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        # What a unit of weight gets if just the sources before this one are at their caps.
        .withColumn("level", (F.col("total") * F.lit(float(share)) - F.col("capped")) / F.col("left"))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "place", "level"))).over(everything))
    )
    target = F.least(F.col("cap"), F.coalesce(F.col("level.level") * F.col("weight"), F.col("cap")))
    return filled.select("source", "source_size", target.alias("target"))


def _boundary(histogram: DataFrame, budgets: DataFrame) -> DataFrame:
    """Of each budget the bucket in which the running sum reaches it, and the sum before it."""
    running = Window.partitionBy("k", "source").orderBy("bucket")
    return (
        histogram.withColumn("base", F.col("base") + F.sum("size").over(running) - F.col("size"))
        .filter((F.col("base") < F.col("rest")) & (F.col("rest") <= F.col("base") + F.col("size")))
        .select("k", "source", "rest", "base", F.col("bucket").alias("at"))
    )


def cuts(rows: DataFrame, weights: Sequence[int], shares: Sequence[float], most: float) -> DataFrame:
    """(source, size, key) -> per source: source_size and, for each share, target, passes, threshold.

    A source takes ``passes`` whole passes over itself and one more over the keys up to the threshold,
    chosen so that what is taken comes nearest to the target (the smaller one of two equally near).
    """
    shift = KEY_BITS - BUCKET_BITS
    histogram = materialise(
        rows.groupBy("source", F.shiftright("key", shift).alias("bucket")).agg(F.sum("size").alias("size")), "mix-histogram"
    )
    sizes = materialise(histogram.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sizes")
    budget = materialise(
        reduce(
            DataFrame.unionByName,
            [targets(sizes, weights, share, most).withColumn("k", F.lit(k)) for k, share in enumerate(shares)],
        )
        .withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")),
        "mix-targets",
    )
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    open_ = budget.filter("rest > 0").select("k", "source", "rest")
    first = open_.join(histogram, same(open_, histogram)).select("k", open_["source"], "rest", F.lit(0).cast("long").alias("base"), "bucket", "size")
    at = materialise(_boundary(first, open_), "mix-boundary")
    bounded = broadcast_if_small(at)
    inside = rows.join(bounded, same(rows, at) & (F.shiftright(rows["key"], shift) == at["at"]))
    inside = inside.select("k", at["source"], "rest", "base", "size", "key")
    shift -= BUCKET_BITS
    second = (
        inside.groupBy("k", "source", "rest", "base", F.shiftright("key", shift).alias("bucket")).agg(F.sum("size").alias("size"))
    )
    at = materialise(_boundary(second, open_), "mix-boundary")
    bounded = broadcast_if_small(at)
    last = (
        rows.join(bounded, same(rows, at) & (F.shiftright(rows["key"], shift) == at["at"]))
        .groupBy("k", at["source"], "rest", "base", "key")
        .agg(F.sum("size").alias("size"))
    )
    running = Window.partitionBy("k", "source").orderBy("key")
    upto = last.select("k", "source", "rest", "key", (F.col("base") + F.sum("size").over(running)).alias("sum"))
    none = at.select("k", "source", "rest", (F.shiftleft("at", shift) - 1).alias("key"), F.col("base").alias("sum"))
    best = (
        upto.unionByName(none)
        .groupBy("k", "source")
        .agg(F.min_by("key", F.struct(F.abs(F.col("sum") - F.col("rest")), "sum", "key")).alias("threshold"))
    )
    joined = budget.join(best, (budget["k"] == best["k"]) & same(budget, best), "left").select(
        budget["source"],
        "source_size",
        F.struct(budget["k"], "target", "passes", F.coalesce("threshold", F.lit(-1)).alias("threshold")).alias("cut"),
    )
    return materialise(joined.groupBy("source", "source_size").agg(F.sort_array(F.collect_list("cut")).alias("cuts")), "mix-cuts")


def _copies(found: DataFrame, key: Column, size: Column) -> Column:
    """Copies of a document for each share, given its source's ``cuts``."""
    taken = F.transform(found["cuts"], lambda c: c["passes"] + (key <= c["threshold"]).cast("long"))
    return F.when(size > 0, taken).otherwise(F.transform(found["cuts"], lambda c: F.lit(0).cast("long")))


def _narrow(docs: DataFrame, size: Column, doc_id: str, source: str, seed: int) -> DataFrame:
    own = col(doc_id)
    size = F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("long")
    return docs.select(own.alias("doc_id"), col(source).alias("source"), size.alias("size"), mix_key(own, seed).alias("key"))


def mix(
    docs: DataFrame,
    size: Column,
    weights: Sequence[int] = (5, 2, 1),
    shares: Sequence[float] = (1.5,),
    most: float = 2.0,
    doc_id: str = "doc_id",
    source: str = "source",
    seed: int = 17,
) -> DataFrame:
    """Decide how often each document goes into the mix.

    Returns one row per input row: ``doc_id``, ``size``, ``source_size``, ``target`` and ``copies`` of
    the last share, and ``nested`` (copies for every share, in order). Whole documents are taken, 0 to
    ceil(``most``) times. A null source is a source of its own; a null or negative size counts as 0, and
    sources without any size take nothing. Rows with one id are taken or left together. An empty table
    gives no rows. Columns other than id, source and size do not matter.
    """
    rows = materialise(_narrow(docs, size, doc_id, source, seed), "mix-rows")
    found = broadcast_if_small(cuts(rows, weights, shares, most))
    return (
        rows.join(found, rows["source"].eqNullSafe(found["source"]))
        .withColumn("nested", _copies(found, F.col("key"), F.col("size")))
        .select(
            "doc_id",
            "size",
            "source_size",
            F.element_at("cuts", -1)["target"].alias("target"),
            F.element_at("nested", -1).alias("copies"),
            "nested",
        )
    )


def mixture(
    docs: DataFrame,
    size: Column,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    doc_id: str = "doc_id",
    source: str = "source",
    seed: int = 17,
) -> DataFrame:
    """The mixed rows themselves, with the columns of the input, each as often as ``mix`` says.

    A row's copies follow from its source and key, so no row is moved to find them. Rows of one source
    and id come as often as each other; a null id is an id like others, a null source a source of its own,
    the last in order. Rows of size 0 or null, empty and null texts among them, add no words and follow the
    same rule as the rest of their source. An empty table gives no rows. Other columns pass through, whatever
    their names.
    """
    rows = materialise(_narrow(docs, size, doc_id, source, seed), "mix-rows")
    found = broadcast_if_small(cuts(rows, weights, (share,), most))
    whole = packed(docs, source=col(source), key=mix_key(col(doc_id), seed), size=size)
    often = F.element_at(_copies(found, F.col("key"), F.col("size")), -1)
    mixed = whole.join(found, whole["source"].eqNullSafe(found["source"])).select("row", often.alias("often"))
    return mixed.filter("often > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), "often")).alias("copy")).select("row.*")
