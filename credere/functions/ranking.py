"""Stable hashing and distributed ordering helpers.

``global_position`` gives every row its 0-based position in a total order
without a single-partition window: the rows are range-partitioned and sorted,
each partition counts its rows, and the (partition -> offset) table, whose
size is bounded by the number of partitions, is broadcast back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def key_text(key: Column | str | list[str]) -> Column:
    """One column, or several joined as text (NULL as empty) - a content key."""
    if isinstance(key, (list, tuple)):
        return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key])
    return F.col(key) if isinstance(key, str) else key


def stable_bucket(key: Column | str | list[str], buckets: int) -> Column:
    """Bucket in [0, buckets) from the first 32 bits of md5(key as text).

    Unlike ``randomSplit``/``sample`` it does not move rows when the input is
    re-partitioned, and any SQL engine with md5 computes the same bucket.
    A list of columns hashes the row content (for tables without an id).
    """
    key = key_text(key)
    h = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")
    return (h % F.lit(buckets)).cast("int")


def _tag_partitions(sorted_df: DataFrame) -> DataFrame:
    return (sorted_df
            .withColumn("_pid", F.spark_partition_id())
            .withColumn("_mid", F.monotonically_increasing_id()))


def _partition_offsets(tagged: DataFrame, weight: Column | None = None) -> DataFrame:
    w = F.count(F.lit(1)) if weight is None else F.sum(weight)
    sizes = tagged.groupBy("_pid").agg(w.alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: tiny, so the unpartitioned window is harmless
    return sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("bigint").alias("_off"))


def global_position(df: DataFrame, order: list[Column], name: str = "pos") -> DataFrame:
    """Append ``name``: the row's 0-based position in ``order`` (must be total).

    The sorted, tagged rows are checkpointed (reliable, under the shared
    checkpoint folder) so positions are computed exactly once and survive the
    loss of an executor.
    """
    tagged = _tag_partitions(df.orderBy(*order)).checkpoint(eager=True)
    offsets = _partition_offsets(tagged)
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_off") + local)
            .drop("_pid", "_mid", "_off"))


def exclusive_prefix_sum(df: DataFrame, order: list[Column], value: str, name: str) -> DataFrame:
    """Append ``name`` = sum of ``value`` over all rows strictly before, in ``order``.

    Distributed: partition offsets are broadcast (bounded by the partition
    count); the running sum inside a partition is a window per partition.
    """
    tagged = _tag_partitions(df.orderBy(*order)).checkpoint(eager=True)
    offsets = _partition_offsets(tagged, F.col(value))
    within = Window.partitionBy("_pid").orderBy("_mid").rowsBetween(Window.unboundedPreceding, -1)
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_off") + F.coalesce(F.sum(value).over(within), F.lit(0)))
            .drop("_pid", "_mid", "_off"))
