"""Left joins that keep hot and NULL keys from ending in one task."""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostersync.functions.text import matches_part, text_key
from rostersync.operators.hot import HotKeys
from rostersync.operators.staging import broadcast_if_small, materialise

# NULL keys are spread over this many join keys.
SPREAD = 256
# A key with more rows than this is hot; a table of N rows has fewer than N / HOT_ROWS of them.
HOT_ROWS = 1_000_000
# Buckets of a hot key for each HOT_ROWS rows it has.
SALTS = 4


def _any_null(cols: list[Column]) -> Column:
    test = cols[0].isNull()
    for c in cols[1:]:
        test = test | c.isNull()
    return test


def _spread(df: DataFrame, ways: int | Column, by: Sequence[str] | None) -> Column:
    """A number below ``ways`` fixed by the row's content, so a re-run task repeats it."""
    ways = ways if isinstance(ways, Column) else F.lit(ways)
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in by or df.columns]), ways).cast("int")


def attach(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    null_safe: Collection[str] = (),
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """LEFT JOIN ``left`` to a ``right`` side, on ``left`` column -> ``right`` column equality.

    The right key columns are dropped. Left columns in ``null_safe`` match NULL with NULL; rows with
    another key NULL can match nothing, and a salt spreads them instead of sending all to one task.
    The salt also gives the right side an exchange of its own when it is an aggregate on the same
    key, which lets adaptive execution split a hot left key.

    The salt is a hash of ``spread_by``, by default of all left columns; naming a few that the query
    reads anyway keeps the scan narrow.
    """
    keys = {f"__k{i}": pair for i, pair in enumerate(on.items())}
    side = right.withColumnsRenamed({r: k for k, (_, r) in keys.items()})
    # Always 0, but not a constant the optimizer could fold out of the join keys.
    side = side.withColumn("__salt_r", F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int"))
    lost = _any_null([F.col(l) for l in on if l not in null_safe])
    rows = left.withColumn("__salt_l", F.when(lost, _spread(left, SPREAD, spread_by) + 1).otherwise(0))
    test = F.col("__salt_l") == F.col("__salt_r")
    for k, (l, _) in keys.items():
        test = test & (F.col(l).eqNullSafe(F.col(k)) if l in null_safe else F.col(l) == F.col(k))
    return rows.join(side, test, "left").drop("__salt_l", "__salt_r", *keys)


def attach_many(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
    staged: bool = False,
    spread_by: Sequence[str] | None = None,
    bucket_by: Sequence[str] | None = None,
    count_from: DataFrame | None = None,
    hot_list: HotKeys | None = None,
) -> DataFrame:
    """LEFT JOIN to a ``right`` side that may repeat a key, any number of times.

    Adaptive execution cannot split the right side of a left join, so hot right keys are salted:
    their rows go to ``salts`` buckets per ``hot_rows`` rows of the key, by content, and a left row
    with such a key is copied once per bucket that is really occupied, so no copy stays without its
    match. The list of hot keys holds fewer than rows / ``hot_rows`` entries, that of buckets at most
    ``salts`` times as many; how both are joined is left to adaptive execution, which sees their sizes.
    ``staged`` writes them down first: they are then found once however often the join runs, broadcast if
    their size allows, and where no key is hot nothing is salted. ``hot_list`` (for a single text key)
    gives the hot keys beforehand, so that several joins share one pass and none counts its right side.
    ``spread_by`` and ``bucket_by`` name the columns the salts of the two sides are hashed from;
    ``count_from`` is a cheaper relation with the right keys, each at least as often, to find hot keys in.
    """
    keys = {f"__k{i}": pair for i, pair in enumerate(on.items())}
    hot_names = [f"{k}h" for k in keys]
    side = right.withColumnsRenamed({r: k for k, (_, r) in keys.items()})
    side = side.where(~_any_null([F.col(k) for k in keys]))
    if hot_list is not None:
        if not hot_list.counts:
            return attach(left, right, on, spread_by=spread_by)
        counts = hot_list.relation(left, *hot_names, "__n")
    else:
        counted = (right if count_from is None else count_from).select(
            *[F.col(r).alias(h) for (_, r), h in zip(keys.values(), hot_names)]
        )
        counts = counted.where(~_any_null([F.col(h) for h in hot_names])).groupBy(*hot_names).agg(F.count("*").alias("__n"))
    hot = counts.where(F.col("__n") > hot_rows).select(
        *hot_names, F.ceil(F.col("__n") * salts / hot_rows).cast("long").alias("__ways")
    )
    if staged and hot_list is None:
        hot = materialise(hot, "hot")
        if hot.isEmpty():
            return attach(left, right, on, spread_by=spread_by)

    def spread_out(small: DataFrame) -> DataFrame:
        return broadcast_if_small(small) if staged else small

    def same(columns: Iterable[str]) -> Column:
        test = F.lit(True)
        for c, h in zip(columns, hot_names):
            test = test & (F.col(c) == F.col(h))
        return test

    renamed = {r: k for k, (_, r) in keys.items()}
    bucket = _spread(side, F.col("__ways"), [renamed.get(c, c) for c in bucket_by or ()])
    side = (
        side.join(spread_out(hot), same(keys), "left")
        # No bucket for a key that is not hot.
        .withColumn("__bucket", bucket)
        .withColumn("__salt_r", F.coalesce("__bucket", F.lit(0)))
    )
    occupied = side.where("__ways IS NOT NULL").select(*hot_names, "__bucket").distinct()
    if staged:
        occupied = materialise(occupied, "buckets")
    lost = _any_null([F.col(l) for l in on])
    alone = F.when(lost, _spread(left, SPREAD, spread_by) + 1).otherwise(0)
    rows = (
        left.withColumn("__alone", alone)
        .join(spread_out(occupied), same(on), "left")
        .withColumn("__salt_l", F.coalesce("__bucket", "__alone"))
        .drop("__alone", "__bucket", *hot_names)
    )
    side = side.drop("__bucket", "__ways", *hot_names)
    test = F.col("__salt_l") == F.col("__salt_r")
    for k, (l, _) in keys.items():
        test = test & (F.col(l) == F.col(k))
    return rows.join(side, test, "left").drop("__salt_l", "__salt_r", *keys)


def join_identity(
    workers: DataFrame,
    accounts: DataFrame,
    worker_key: str = "worker_id",
    account_key: str = "employee_number",
    strip_zeros: bool = False,
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
    staged: bool = False,
    spread_by: Sequence[str] | None = None,
    bucket_by: Sequence[str] | None = None,
    count_from: DataFrame | None = None,
    hot_list: HotKeys | None = None,
) -> DataFrame:
    """Workers LEFT JOIN accounts on the identifiers compared as text; fans out per account.

    The account key is dropped: where it matched it equals the worker's.
    """
    left = workers.withColumn("__worker", text_key(F.col(worker_key), strip_zeros))
    number = text_key(F.col(account_key), strip_zeros).alias("__account")
    right = accounts.select(*[c for c in accounts.columns if c != account_key], number)
    counted = None if count_from is None else count_from.select(number)
    joined = attach_many(
        left, right, {"__worker": "__account"}, hot_rows, salts, staged, spread_by, bucket_by, counted, hot_list
    )
    return joined.drop("__worker")


def with_active_account(
    workers: DataFrame,
    accounts: DataFrame,
    status: str = "ACTIVE",
    strip_zeros: bool = False,
) -> DataFrame:
    """Workers that have an account in the given status, once each however many there are."""
    held = accounts.where(F.col("status") == status).select(
        text_key(F.col("employee_number"), strip_zeros).alias("__account")
    )
    rows = workers.withColumn("__worker", text_key(F.col("worker_id"), strip_zeros))
    found = exists_flag(rows, held, {"__worker": "__account"}, "__held")
    return found.where("__held").drop("__worker", "__held")


def join_lookup(
    df: DataFrame,
    lookup: DataFrame,
    title: str = "okta_title",
    department: str = "okta_department",
    literal: bool = False,
) -> DataFrame:
    """LEFT JOIN on equal title and a department that contains the lookup's pattern.

    ``lookup`` holds ``title``, ``department``, ``group_name``; several matches give several rows.
    """
    side = lookup.select(
        F.col("title").alias("title"),
        F.col("department").alias("department"),
        F.col("group_name").alias("group_name"),
    )
    test = (F.col(title) == F.col("title")) & matches_part(
        F.col(department), F.col("department"), literal
    )
    return df.join(side, test, "left")


def join_lookup_distinct(
    df: DataFrame,
    lookup: DataFrame,
    title: str = "okta_title",
    department: str = "okta_department",
    literal: bool = False,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """The same as ``join_lookup``, each distinct (title, department) being held against the patterns once.

    The pairs are taken down and joined to the lookup, so a pattern is compiled for pairs, not for rows;
    rows then find their matches by equality. Matches are broadcast if their size allows. Reads ``df``
    twice, the first time two columns of it.
    """
    pairs = df.select(F.col(title).alias("__t"), F.col(department).alias("__d")).distinct()
    pairs = materialise(pairs.where(F.col("__t").isNotNull() & F.col("__d").isNotNull()), "lookup-pairs")
    matches = join_lookup(pairs, lookup, "__t", "__d", literal).where(F.col("title").isNotNull())
    matches = broadcast_if_small(materialise(matches, "lookup-matches"))
    return attach(df, matches, {title: "__t", department: "__d"}, spread_by=spread_by)


def exists_flag(
    df: DataFrame,
    keys: DataFrame,
    on: Mapping[str, str],
    name: str,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """A boolean column: is the row's key among ``keys``? Never fans out, NULL keys give false."""
    side = keys.select(*on.values()).distinct().withColumn("__hit", F.lit(True))
    return (
        attach(df, side, on, spread_by=spread_by)
        .withColumn(name, F.coalesce("__hit", F.lit(False)))
        .drop("__hit")
    )
