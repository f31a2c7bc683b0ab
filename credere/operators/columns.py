"""Projection and column operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import guarded_cast, missing_flag
from ..profile import Profile
from .quality import distinct_counts


def select_groups(df: DataFrame, *groups: Iterable[str]) -> DataFrame:
    """Project the concatenation of several column groups, in order."""
    names: list[str] = []
    for g in groups:
        names += [c for c in g if c not in names]
    return df.select(*names)


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """P3."""
    return df.drop(*cols)


def typed_cast(df: DataFrame, profile: Profile, keep_other: bool = False) -> DataFrame:
    """Every profile column cast in ONE projection; malformed text -> NULL."""
    exprs = [guarded_cast(c, profile.spark_type(c)).alias(c) for c in profile.names]
    if keep_other:
        exprs += [F.col(c) for c in df.columns if c not in profile.names]
    return df.select(*exprs)


def binarise_label(df: DataFrame, code_col: str, positive, out_col: str | None = None,
                   strict: bool = False) -> DataFrame:
    """1 if the code equals ``positive`` else 0.

    Default keeps the original rule ``when(code != positive, 0).otherwise(1)``,
    under which a NULL code counts as positive. ``strict=True`` drops rows whose
    code is NULL instead.
    """
    out_col = out_col or code_col
    if strict:
        df = df.filter(F.col(code_col).isNotNull())
    label = F.when(F.col(code_col) != F.lit(positive), F.lit(0)).otherwise(F.lit(1))
    df = df.withColumn(out_col, label.cast("int"))
    if out_col != code_col:
        df = df.drop(code_col)
    return df


def column_profile(df: DataFrame, approx: bool = False, sentinel: str | None = "NA") -> DataFrame:
    """One row per column: column, type, rows, missing, distinct (NULL counts as one more value).

    Rows and missing values come from one aggregate over the table; distinct counts from stacked
    (column, value) pairs in two stages, or from sketches with ``approx``. No per-column jobs, no Expand.
    """
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(df.schema.fields):
        aggs.append(F.count_if(missing_flag(f.name, f.dataType, True, sentinel)).alias(f"_m{i}"))
    rows = F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
                 F.col("_rows").alias("rows"), F.col(f"_m{i}").alias("missing"))
        for i, f in enumerate(df.schema.fields)])
    told = df.agg(*aggs).select(F.inline(rows))
    wide = distinct_counts(df, approx=approx)
    counts = wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("distinct")) for c in wide.columns])))
    return told.join(F.broadcast(counts), "column").select("column", "type", "rows", "missing", "distinct")
