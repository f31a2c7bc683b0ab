"""Sort, limit, sample and split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import key_text, stable_bucket

SPLIT_BUCKETS = 100
SAMPLE_BUCKETS = 10_000


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """L1-L3: ``orderBy(...).limit(k)`` - planned as TakeOrderedAndProject
    (per-partition top-k, then a k-row merge), never a full sort."""
    return df.orderBy(*order).limit(k)


def hash_split(df: DataFrame, key, train_percent: int = 80,
               column: str | None = None) -> tuple[DataFrame, DataFrame] | DataFrame:
    """Split by a stable hash of ``key`` (no shuffle, no sort).

    Rows sharing a key land on the same side, and a row never moves when the
    input is re-partitioned. With ``column`` the split is returned as a label
    column instead of two frames.
    """
    bucket = stable_bucket(key, SPLIT_BUCKETS)
    is_train = bucket < F.lit(train_percent)
    if column:
        return df.withColumn(column, F.when(is_train, F.lit("train")).otherwise(F.lit("test")))
    return df.filter(is_train), df.filter(~is_train)


def hash_sample(df: DataFrame, key, fraction: float) -> DataFrame:
    """Keep the keys whose stable bucket falls under ``fraction``."""
    cut = int(round(fraction * SAMPLE_BUCKETS))
    return df.filter(stable_bucket(key, SAMPLE_BUCKETS) < F.lit(cut))


def random_split(df: DataFrame, weights=(0.8, 0.2), seed: int = 100):
    """Spark's native split (rows-only parity: depends on partitioning)."""
    return df.randomSplit(list(weights), seed=seed)


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Native Bernoulli sample, always seeded."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def bottom_k(df: DataFrame, key, k: int, step: int = 4, edge: int = 10_000) -> DataFrame:
    """L5 to a size: the ``k`` rows with the smallest md5 of ``key`` (ties by the key's text), under any partitioning.

    The threshold is found from counts by leading hash digits, ``step`` more digits at a time, until the digits at
    the edge hold at most ``edge`` rows; only those are ordered. All rows if there are no more than
    ``k``; none for ``k`` = 0. Rows with the same key are taken in any order. NULL keys count as ''.
    """
    if k <= 0:
        return df.limit(0)
    text = F.coalesce(key_text(key).cast("string"), F.lit(""))
    hashed = df.withColumn("__md5", F.md5(text))
    prefix, left = "", k
    whole = None      # rows that are in for sure
    while True:
        at = F.substring("__md5", 1, len(prefix) + step)
        inside = hashed.filter(F.col("__md5").startswith(prefix)) if prefix else hashed
        counts = sorted((r["p"], r["n"]) for r in inside.groupBy(at.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())  # 16^step at most
        if not prefix and sum(n for _, n in counts) <= k:
            return df
        for p, n in counts:
            if n > left:
                break
            left -= n
        whole = F.col("__md5") < F.lit(p)
        prefix = p
        if left == 0 or n <= edge or len(prefix) >= 32:
            break
    sure = hashed.filter(whole)
    rest = hashed.filter(F.col("__md5").startswith(prefix)).orderBy("__md5", text).limit(left)
    return (sure.unionByName(rest) if left else sure).drop("__md5")


def sample_to_size(df: DataFrame, target_rows: int, seed: int = 42, key=None) -> DataFrame:
    """L5 as called in the original notebook: fraction = target / total rows; with a ``key``, exactly ``target_rows`` rows."""
    if key is not None:
        return bottom_k(df, key, target_rows)
    total = df.count()
    return df if total <= target_rows else bernoulli_sample(df, target_rows / total, seed)
