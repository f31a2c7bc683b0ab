"""The cleaning job: select -> cast -> impute -> filter -> label.

``fit_on`` keeps the original order by default (statistics from every typed
row, before filters and split, so test rows leak into them); ``"filtered"``
fits after the row filters and ``"train"`` on the training side of the
stable split only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import stable_bucket
from ..operators.clean import ImputeModel, fit_impute, nonzero_filter, sentinel_filter
from ..operators.columns import binarise_label, drop_columns, select_groups, typed_cast
from ..profile import Profile


@dataclass
class Cleaned:
    df: DataFrame
    impute: ImputeModel
    typed: DataFrame


BUCKET = "split_bucket"


def typed_table(raw: DataFrame, profile: Profile, bucket: bool = False) -> DataFrame:
    """Select the profile's raw columns, drop the unused ones, cast in one projection.

    With ``bucket`` each row carries the bucket that places it on a side of the split, taken from
    the raw row without its outcome: no later step can move a row to the other side.
    """
    selected = select_groups(raw, profile.raw_columns)
    if not bucket:
        return typed_cast(drop_columns(selected, *profile.drop_cols), profile)
    marked = selected.select("*", stable_bucket(profile.raw_split_key, 100).alias(BUCKET))
    return typed_cast(drop_columns(marked, *profile.drop_cols), profile, keep_other=True)


def split_by_bucket(df: DataFrame, train_percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """(train, held-out) by the carried bucket, which is dropped."""
    return df.filter(F.col(BUCKET) < train_percent).drop(BUCKET), df.filter(F.col(BUCKET) >= train_percent).drop(BUCKET)


def row_filters(df: DataFrame, profile: Profile) -> DataFrame:
    df = nonzero_filter(df, profile.nonzero_cols)
    return sentinel_filter(df, profile.sentinel_cols, profile.sentinel)


def clean_table(raw: DataFrame, profile: Profile, fit_on: str = "all", strict_label: bool = False,
                relative_error: float = 0.001, train_percent: int = 80, bucket: bool = False) -> Cleaned:
    """The whole job on raw rows; with ``bucket`` the result keeps the split bucket for ``split_by_bucket``."""
    typed = typed_table(raw, profile, bucket=bucket or fit_on == "train")
    out = clean_typed(typed, profile, fit_on, strict_label, relative_error, train_percent)
    if BUCKET in typed.columns and not bucket:
        return Cleaned(out.df.drop(BUCKET), out.impute, typed.drop(BUCKET))
    return out


def clean_typed(typed: DataFrame, profile: Profile, fit_on: str = "all", strict_label: bool = False,
                relative_error: float = 0.001, train_percent: int = 80) -> Cleaned:
    """The cleaning steps after the cast (impute -> filter -> label)."""
    if fit_on == "all":
        source = typed
    elif fit_on == "filtered":
        source = row_filters(typed, profile)
    elif fit_on == "train":
        source = split_by_bucket(typed, train_percent)[0]
    else:
        raise ValueError(f"fit_on must be all, filtered or train, not {fit_on!r}")
    model = fit_impute(source, profile.median_cols, profile.mean_cols, profile.mode_cols,
                       relative_error=relative_error)
    out = row_filters(model.transform(typed), profile)
    out = binarise_label(out, profile.label_code, profile.label_positive, profile.label_out,
                         strict=strict_label)
    return Cleaned(out, model, typed)
