"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


PARTITION_BYTES = 192 * 1024 * 1024
MOST_PARTITIONS = 50_000


def partitions_for(input_bytes: int) -> int:
    """Shuffle partitions for a full-width shuffle of the input.

    Adaptive execution merges partitions that turn out small but never adds any, so start high. Past
    ``MOST_PARTITIONS`` the bookkeeping of blocks costs more than larger partitions, which spill.
    """
    return min(max(200, -(-input_bytes // PARTITION_BYTES)), MOST_PARTITIONS)


def build_session(
    app: str = "rostersync",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    input_bytes: int | None = None,
    **extra: str,
) -> SparkSession:
    """A session with adaptive execution on; on a cluster leave ``master`` to spark-submit.

    ``input_bytes`` sets the shuffle partitions for an input of that size, unless they are given.
    """
    if input_bytes and not shuffle_partitions:
        shuffle_partitions = partitions_for(input_bytes)
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Split hot partitions earlier than by default (256 MB, 5 times the median).
        .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "128MB")
        .config("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "3")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
