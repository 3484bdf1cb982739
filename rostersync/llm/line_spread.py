"""Removing boilerplate lines that many sites share, with DataFrame operations only.

Each line hash gets a HyperLogLog sketch of the sites it occurs on; sketches merge in partial
aggregation, so a line on a third of all pages costs one sketch per task. Lines whose estimate is near
the threshold get an exact count of distinct sites. A boilerplate line stays where it first occurs and
goes everywhere else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostersync.llm.common import col, packed
from rostersync.operators.staging import materialise

BLANKS = " \t\r\v\f"
#: Estimates this far (as a ratio) from the threshold are settled; the sketch's error is about 1.6 %.
BAND = 0.25
SKETCH_BITS = 12
BITS = 32


def _is_site(site: str | Column) -> Column:
    return col(site) if isinstance(site, str) else site


def line_verdicts(lines: DataFrame, min_sites: int) -> DataFrame:
    """(line, site, at) -> the boilerplate lines with their first place (``line``, ``first``).

    A null site is no site: it adds nothing to a line's spread.
    """
    spread = lines.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH_BITS))).alias("sites"), F.min("at").alias("first")
    )
    # Lines seen on fewer sites than the band's lower end are settled here; the others are few.
    spread = materialise(spread.filter(F.col("sites") >= min_sites * (1 - BAND)), "line-spread")
    clear = F.col("sites") > min_sites * (1 + BAND)
    near = spread.filter(~clear).select("line", "first")
    exact = (
        lines.select("line", "site")
        .join(near.select("line"), "line", "left_semi")
        .distinct()
        .groupBy("line")
        .agg(F.count("site").alias("n"))
        .filter(F.col("n") >= min_sites)
        .select("line")
    )
    return spread.filter(clear).select("line", "first").unionByName(near.join(exact, "line", "left_semi"))


def drop_shared_lines(
    docs: DataFrame,
    min_sites: int = 3,
    doc_id: str = "doc_id",
    text: str = "text",
    site: str | Column = "source",
) -> DataFrame:
    """Every input row as ``row``, with ``clean`` (its text without boilerplate), ``n_lines``, ``n_removed``.

    Lines are cut at ``\\n`` and compared without white space around them; a line of white space only is
    never boilerplate. A line on at least ``min_sites`` sites is removed, except at its first place in
    the order of (id, line number), null ids first. A null text stays null with 0 lines; an empty one is
    one blank line. Rows without a site count for no line's spread but lose its copies. Rows that agree
    in id, site and text are treated alike, so all of them keep a first place. An empty table gives no rows.
    Lines are compared by 64-bit hashes.
    """
    body, own, place = col(text), col(doc_id), _is_site(site)
    # One number per (id, site, text): rows alike share it.
    keyed = packed(docs, key=F.xxhash64(own, place, body))
    read = docs.select(
        F.xxhash64(own, place, body).alias("key"), own.alias("id"), F.xxhash64(place).alias("hash"), place.isNotNull().alias("known"), body.alias("text")
    )
    cut = read.select("key", "id", "hash", "known", F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
    line = F.btrim("raw", F.lit(BLANKS))
    lines = materialise(
        cut.filter(F.length(line) > 0).select(
            "key",
            F.struct("id", "pos").alias("at"),
            F.when(F.col("known"), F.col("hash")).alias("site"),
            F.xxhash64(line).alias("line"),
        ),
        "lines",
    )
    bad = materialise(line_verdicts(lines, min_sites), "line-verdicts")
    hits = (
        lines.join(bad, "line")
        .filter(~F.col("at").eqNullSafe(F.col("first")))
        .select("key", F.floor(F.col("at.pos") / BITS).cast("int").alias("block"), F.expr(f"shiftleft(1L, at.pos % {BITS})").alias("bit"))
        # Bits per block of lines: a document's removals stay small whatever their number.
        .groupBy("key", "block")
        .agg(F.bit_or("bit").alias("bits"))
        .groupBy("key")
        .agg(F.map_from_entries(F.collect_list(F.struct("block", "bits"))).alias("gone"), F.sum(F.bit_count("bits")).alias("n_removed"))
    )
    pieces = F.split(F.col("row")[text], "\n")
    stays = F.filter(
        pieces,
        lambda x, i: F.getbit(F.coalesce(F.element_at("gone", F.floor(i / BITS).cast("int")), F.lit(0).cast("long")), i % BITS) == 0,
    )
    return keyed.join(hits, "key", "left").select(
        "row",
        F.when(F.col("gone").isNull(), F.col("row")[text]).otherwise(F.array_join(stays, "\n")).alias("clean"),
        F.greatest(F.coalesce(F.size(pieces), F.lit(0)), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
    )


def without_shared_lines(docs: DataFrame, min_sites: int = 3, doc_id: str = "doc_id", text: str = "text", site: str = "source", length: str = "n_chars") -> DataFrame:
    """The input with clean texts and, where there is such a column, their lengths in ``length``.

    Documents that had words and lost all of them are copies line by line; they go. Null and empty texts
    stay as they are, rows without a site keep their lines, and repeated rows are treated alike. An empty
    table gives no rows. Other columns pass through, whatever their names.
    """
    cleaned = drop_shared_lines(docs, min_sites, doc_id, text, site)
    left = F.coalesce(F.col("clean").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kinds = dict(docs.dtypes)

    def column(name: str) -> Column:
        old = F.col("row")[name]
        if name == text:
            return F.col("clean").alias(name)
        if name == length:
            return F.when(F.col("n_removed") > 0, F.length("clean").cast(kinds[name])).otherwise(old).alias(name)
        return old.alias(name)

    return cleaned.filter((F.col("n_removed") == 0) | left).select(*[column(c) for c in docs.columns])
