"""Data-quality aggregates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import missing_flag


SKETCH_BITS = 14
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)   # standard error of an estimate, as a share


def row_count(df: DataFrame) -> DataFrame:
    """A1 as a one-row table (``rows``)."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def missing_census(df: DataFrame, cols: Iterable[str] | None = None, nan: bool = True,
                   sentinel: str | None = "NA") -> DataFrame:
    """A2/A3: one wide row, per column the count of missing values.

    Missing is NULL, NaN (float columns) or the sentinel (string columns); the
    tests are type-aware so the census runs with ANSI on. ``nan=False,
    sentinel=None`` gives the NULL-only census (A3).
    """
    cols = list(cols) if cols is not None else df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.agg(*[F.count_if(missing_flag(c, types[c], nan, sentinel)).alias(c) for c in cols])


def group_count(df: DataFrame, *cols: str) -> DataFrame:
    """A4: rows per value (NULL is its own group); column ``count``."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("count"))


def mode_frame(df: DataFrame, col: str, null_counts: bool = True) -> DataFrame:
    """A5 as a one-row table (``value``, ``count``).

    ``null_counts=True`` is the original job's meaning: NULL is a group and can
    win. Ties go to the lowest value, NULL first. The winner is picked with a
    ``min_by`` aggregate over the per-value counts, so no sort and no single
    task sees all values.
    """
    src = df if null_counts else df.filter(F.col(col).isNotNull())
    counts = src.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    order = F.struct((-F.col("_n")).alias("a"), F.col(col).isNotNull().alias("b"), F.col(col).alias("c"))
    return counts.agg(F.min_by(F.col(col), order).alias("value"),
                      F.min_by(F.col("_n"), order).alias("count"))


def mode_value(df: DataFrame, col: str, null_counts: bool = True):
    """A5 -> the winning value on the driver (one row)."""
    row = mode_frame(df, col, null_counts).first()
    return None if row is None else row["value"]


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    """A6."""
    return df.select(*cols).distinct()


def _as_text(c: str, t: T.DataType):
    """A column's value as text, one text a value."""
    col = F.col(f"`{c}`")
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return (col + F.lit(0.0).cast(t)).cast("string")   # -0.0 is 0.0
    if isinstance(t, T.TimestampType):
        return F.unix_micros(col).cast("string")
    return F.hex(col) if isinstance(t, T.BinaryType) else col.cast("string")


def distinct_by_column(df: DataFrame, cols: Iterable[str] | None = None, null_as_value: bool = True) -> DataFrame:
    """A7 in rows: (column, n). Stacked (column, value) pairs, counted in two stages: no Expand of the whole rows."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = list(cols) if cols is not None else df.columns
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), _as_text(c, types[c]).alias("value")) for c in cols])
    seen = df.select(F.inline(pairs)).groupBy("column", "value").agg(F.lit(1).alias("one"))
    return seen.groupBy("column").agg(F.count(F.lit(1) if null_as_value else F.col("value")).alias("n"))


def distinct_sketches(df: DataFrame, cols: Iterable[str] | None = None, bits: int = SKETCH_BITS) -> DataFrame:
    """One wide row of HyperLogLog sketches, one a column; NULL is no value. ``merge_sketches`` unites such rows."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = list(cols) if cols is not None else df.columns
    return df.agg(*[F.hll_sketch_agg(_as_text(c, types[c]), F.lit(bits)).alias(c) for c in cols])


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """The union of rows of sketches, as of daily tables, without reading the data again."""
    return sketches.agg(*[F.hll_union_agg(F.col(f"`{c}`")).alias(c) for c in sketches.columns])


def sketch_counts(sketches: DataFrame) -> DataFrame:
    """(column, n): the estimates of one row of sketches."""
    return sketches.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.hll_sketch_estimate(F.col(f"`{c}`")).alias("n")) for c in sketches.columns])))


def distinct_counts(df: DataFrame, cols: Iterable[str] | None = None, approx: bool = False,
                    null_as_value: bool = True) -> DataFrame:
    """One wide row of distinct counts of all columns; ``approx`` takes them from sketches."""
    cols = list(cols) if cols is not None else df.columns
    if approx:
        nulls = [F.max(F.col(f"`{c}`").isNull().cast("int")).alias(c) for c in cols]
        one = sketch_counts(distinct_sketches(df, cols))
        if null_as_value:
            own = df.agg(*nulls).select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("null")) for c in cols])))
            one = one.join(F.broadcast(own), "column").select("column", (F.col("n") + F.coalesce("null", F.lit(0))).alias("n"))
    else:
        one = distinct_by_column(df, cols, null_as_value)
    return one.agg(*[F.coalesce(F.max(F.when(F.col("column") == c, F.col("n"))), F.lit(0)).cast("bigint").alias(c) for c in cols])


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows and share per label value in one pass."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())  # over the (few) label groups only
    return counts.withColumn("share", F.col("count") / total)
