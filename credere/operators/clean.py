"""Filters and imputation.

Imputation is split into *fit* (statistics from any frame, one fused scan for
medians and means plus one small aggregation per mode column) and *apply*
(statistics inlined as literals, so Catalyst folds them and the apply step is
a plain projection that also works on streams).
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import value_or_null
from ..functions.ranking import exclusive_prefix_sum
from .quality import mode_value


def nonzero_filter(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """``c != 0``; NULL rows go too (three-valued logic)."""
    for c in cols:
        df = df.filter(F.col(c) != F.lit(0))
    return df


def sentinel_filter(df: DataFrame, cols: Iterable[str], sentinel: str = "NA") -> DataFrame:
    """``c != 'NA'``; NULL rows go too."""
    for c in cols:
        df = df.filter(F.col(c) != F.lit(sentinel))
    return df


def dropna_any(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """F8: drop rows with NULL (or NaN) in any of ``cols``."""
    return df.dropna(how="any", subset=list(cols))


@dataclass
class ImputeModel:
    """Fitted statistics, applied as literals."""
    median: dict = field(default_factory=dict)
    mean: dict = field(default_factory=dict)
    mode: dict = field(default_factory=dict)

    def as_row(self) -> dict:
        out = {}
        for kind in ("median", "mean", "mode"):
            for c, v in getattr(self, kind).items():
                out[f"{kind}_{c}"] = v
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        types = {f.name: f.dataType for f in df.schema.fields}
        exprs = {}
        for c, v in list(self.median.items()) + list(self.mean.items()):
            # Imputer semantics: NULL and NaN are both missing.
            exprs[c] = F.coalesce(value_or_null(c, types[c]), F.lit(v).cast(types[c])) if v is not None \
                else F.col(c)
        for c, v in self.mode.items():
            # The original job fills NULL only; a NULL mode leaves the column as it is.
            exprs[c] = F.when(F.col(c).isNull(), F.lit(v).cast(types[c])).otherwise(F.col(c))
        return df.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in df.columns])


def value_counts(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """(column, v, n): how often each non-missing value of each numeric column occurs, from one scan."""
    types = {f.name: f.dataType for f in df.schema.fields}
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), value_or_null(c, types[c]).cast("double").alias("v")) for c in cols])
    return df.select(F.inline(pairs)).filter(F.col("v").isNotNull()).groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))


def exact_quantiles(df: DataFrame, cols: Iterable[str], qs: Iterable[float] = (0.5,)) -> dict[str, list]:
    """Exact discrete quantiles (the ceil(q*n)-th smallest non-missing value) of many columns at any scale.

    One scan counts the distinct values of all columns (partial aggregation), one range sort by
    column and value gives the counts a distributed prefix sum, and one more pass over the counts picks
    the value that holds each rank. A column without values has None. No task sorts a raw column.
    """
    cols, qs = list(cols), list(qs)
    if not cols:
        return {}
    ranked = exclusive_prefix_sum(value_counts(df, cols), [F.col("column"), F.col("v")], "n", "below")  # checkpointed: the scan runs once
    spans = {r["column"]: (r["first"], r["n"]) for r in ranked.groupBy("column").agg(F.min("below").alias("first"), F.sum("n").alias("n")).collect()}
    picks = [F.max(F.when((F.col("column") == c) & (F.col("below") < first + k) & (F.col("below") + F.col("n") >= first + k), F.col("v"))).alias(f"{i}_{j}")
             for i, c in enumerate(cols) if c in spans for first, n in [spans[c]] for j, q in enumerate(qs) for k in [max(1, math.ceil(q * n))]]
    row = ranked.agg(*picks).first().asDict() if picks else {}
    return {c: [row.get(f"{i}_{j}") for j in range(len(qs))] for i, c in enumerate(cols)}


def exact_quantile(df: DataFrame, col: str, q: float = 0.5):
    """:func:`exact_quantiles` of one column."""
    return exact_quantiles(df, [col], [q])[col][0]


def sketch_certificate(df: DataFrame, sketched: dict, relative_error: float = 0.001) -> DataFrame:
    """(column, rows, low, high, certified): whether each sketched median keeps its promise.

    ``low`` and ``high`` are the exact values at the ranks 0.5 - error and 0.5 + error; a median from a
    sketch of that error must lie between them. ``rows`` counts the non-missing values.
    """
    cols = list(sketched)
    counts = {r["column"]: r["n"] for r in value_counts(df, cols).groupBy("column").agg(F.sum("n").alias("n")).collect()}
    bounds = exact_quantiles(df, cols, (0.5 - relative_error, 0.5 + relative_error))
    rows = [(c, counts.get(c, 0), low, high, low is None or low <= sketched[c] <= high) for c, (low, high) in bounds.items()]
    return df.sparkSession.createDataFrame(rows, "`column` string, rows bigint, low double, high double, certified boolean")


def fit_impute(df: DataFrame, median: Iterable[str] = (), mean: Iterable[str] = (),
               mode: Iterable[str] = (), relative_error: float = 0.001,
               mode_null_counts: bool = True) -> ImputeModel:
    """Fit approximate medians and means in ONE aggregate scan; each mode is one small aggregation.

    ``relative_error > 0`` uses the mergeable GK sketch (``Imputer`` default
    0.001). ``relative_error=0`` asks for exact medians, computed by
    :func:`exact_quantiles` (one counting aggregation for all columns).
    """
    median, mean, mode = list(median), list(mean), list(mode)
    types = {f.name: f.dataType for f in df.schema.fields}
    exact = relative_error <= 0
    aggs = []
    if not exact:
        accuracy = max(1, int(round(1.0 / relative_error)))
        for c in median:
            aggs.append(F.percentile_approx(value_or_null(c, types[c]).cast("double"), F.lit(0.5),
                                            F.lit(accuracy)).alias(f"median_{c}"))
    for c in mean:
        aggs.append(F.avg(value_or_null(c, types[c]).cast("double")).alias(f"mean_{c}"))
    model = ImputeModel()
    if aggs:
        row = df.agg(*aggs).first()
        if not exact:
            model.median = {c: row[f"median_{c}"] for c in median}
        model.mean = {c: row[f"mean_{c}"] for c in mean}
    if exact:
        model.median = {c: found[0] for c, found in exact_quantiles(df, median).items()}
    model.mode = {c: mode_value(df, c, null_counts=mode_null_counts) for c in mode}
    return model


def impute(df: DataFrame, fit_source: DataFrame | None = None, **kw) -> tuple[DataFrame, ImputeModel]:
    """Fit on ``fit_source`` (default: ``df`` itself, the original order) and apply to ``df``."""
    model = fit_impute(fit_source if fit_source is not None else df, **kw)
    return model.transform(df), model
