"""How far fitted linear weights are from an optimum of their loss (M1, M2).

Optimisers differ in their last digits, so predictions have no twin. The gradient of the stated
loss at the fitted weights has: it is zero at an optimum and at no other point, for both losses are convex.
One aggregation over at most four groups computes it for all slots.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOSSES = ("log", "hinge")


def subgradient(scored: DataFrame, loss: str, features_col: str = "features", label_col: str = "label",
                raw_col: str = "rawPrediction", band: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """(low, high) of the mean loss's subgradients at the weights behind ``raw_col``; the last entry is the intercept's.

    Without a penalty. ``log`` is smooth, so both are the gradient. ``hinge`` has a kink where the signed
    margin is 1: rows within ``band`` of it may count with any share from none to all. Weights
    are optimal if 0 lies between low and high in every slot. An empty table is an error.
    """
    if loss not in LOSSES:
        raise ValueError(f"unknown loss {loss!r}, expected one of {LOSSES}")
    raw, sign = vector_to_array(F.col(raw_col))[1], F.when(F.col(label_col) == 1, 1.0).otherwise(-1.0)
    rows = scored.select(F.col(features_col).alias("x"), sign.alias("sign"), (raw * sign).alias("m"))
    if loss == "log":
        weight, kink = 1.0 / (1.0 + F.exp("m")), F.lit(False)
    else:
        kink = F.abs(F.col("m") - 1.0) <= band
        weight = F.when(kink | (F.col("m") < 1.0), 1.0).otherwise(0.0)
    rows = rows.select("x", "sign", weight.alias("weight"), kink.alias("kink"))
    # weights are never negative, so each sign is a group of its own
    parts = rows.groupBy("sign", "kink").agg(Summarizer.metrics("mean", "normL1").summary(F.col("x"), F.col("weight")).alias("s"),
                                             F.sum("weight").alias("w"), F.count("*").alias("n")).collect()
    if not parts:
        raise ValueError("no rows to certify weights on")
    size = len(parts[0]["s"]["mean"])
    low, high, n = np.zeros(size + 1), np.zeros(size + 1), 0
    for p in parts:
        n += p["n"]
        if not p["w"]:
            continue
        total = -p["sign"] * p["w"] * np.append(p["s"]["mean"].toArray(), 1.0)
        if p["kink"]:
            spread = np.append(p["s"]["normL1"].toArray(), p["w"])   # sum of absolute values
            low += (total - spread) / 2
            high += (total + spread) / 2
        else:
            low += total
            high += total
    return low / n, high / n


def optimality_gap(scored: DataFrame, loss: str, **columns) -> float:
    """The largest distance of 0 from a slot's subgradients: 0 at an optimum."""
    low, high = subgradient(scored, loss, **columns)
    return float(np.max(np.maximum(0.0, np.maximum(low, -high))))
