"""Factorization machines on blocks (M3).

The parameters, start, loss, AdamW steps and stopping rule are ``FMClassifier``'s, and the fitted model is an MLlib
``FMClassificationModel``; a test holds its coefficients to MLlib's. Only the pass over the rows differs: a
block's gradient is a few products of matrices instead of a loop over the slots of one vector at a time.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import FMClassificationModel, FMClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import DenseMatrix, Vectors
from pyspark.sql import DataFrame

from .blocks import STORED, blocks, slots

CHUNK = 2048   # rows whose products stay in a core's cache


def gradient(y, x, factors, linear, intercept):
    """(sums of the loss's gradient by factors, linear weights and intercept, sum of the loss) of logistic loss over the rows."""
    s = x @ factors
    xx = x * x
    raw = intercept + x @ linear + 0.5 * (np.einsum("ij,ij->i", s, s) - xx @ (factors * factors).sum(axis=1))
    e = np.exp(-np.abs(raw))
    m = np.where(raw > 0, 1.0, e) / (1.0 + e) - y
    loss = np.log1p(e) + np.maximum(np.where(y > 0, -raw, raw), 0.0)
    by_factor = x.T @ (m[:, None] * s) - factors * (xx.T @ m)[:, None]
    return by_factor, x.T @ m, m.sum(), loss.sum()


def _partial(factors, linear, intercept):
    def of(part):
        total = None
        for y, x in part:
            for i in range(0, len(y), CHUNK):
                g = (*gradient(y[i:i + CHUNK], x[i:i + CHUNK], factors, linear, intercept), len(y[i:i + CHUNK]))
                total = g if total is None else tuple(a + b for a, b in zip(total, g))
        return [] if total is None else [total]
    return of


def _sum(a, b):
    return b if a is None else a if b is None else tuple(x + y for x, y in zip(a, b))


class BlockFMClassifier(FMClassifier):
    """``FMClassifier`` whose AdamW steps over all rows read blocks; mini-batches and the ``gd`` solver stay MLlib's."""

    def _fit(self, dataset: DataFrame) -> FMClassificationModel:
        if self.getSolver() != "adamW" or self.getMiniBatchFraction() < 1.0:
            return super()._fit(dataset)
        width, _ = slots(dataset, self.getFeaturesCol())
        rows = blocks(dataset, self.getFeaturesCol(), self.getLabelCol()).persist(STORED)
        try:
            factors, linear, intercept, losses = self._descend(dataset.sparkSession, rows, width)
        finally:
            rows.unpersist()
        sc = dataset.sparkSession.sparkContext
        made = sc._jvm.org.apache.spark.ml.classification.FMClassificationModel(
            self.uid, float(intercept), _py2java(sc, Vectors.dense(linear)), _py2java(sc, DenseMatrix(*factors.shape, factors.ravel(), True)))
        model = self._copyValues(FMClassificationModel(made))
        model.objective_history = losses
        return model

    def _descend(self, spark, rows, width):
        k, linear_on, intercept_on = self.getFactorSize(), self.getFitLinear(), self.getFitIntercept()
        rnd = spark._jvm.java.util.Random(self.getSeed())
        start = [rnd.nextGaussian() * self.getInitStd() for _ in range(width * k)]
        w = np.concatenate([start, np.zeros(width * linear_on + intercept_on)])
        m, v, last, losses = np.zeros_like(w), np.zeros_like(w), None, []
        beta1, beta2, eps, reg = 0.9, 0.999, 1e-8, self.getRegParam()
        for step in range(1, self.getMaxIter() + 1):
            factors, rest = w[:width * k].reshape(width, k), w[width * k:]
            linear = rest[:width] if linear_on else np.zeros(width)
            total = rows.mapPartitions(_partial(factors, linear, rest[-1] if intercept_on else 0.0)).treeAggregate(None, _sum, _sum, depth=1 if rows.getNumPartitions() <= 256 else 2)
            if total is None:
                break
            by_factor, by_linear, by_intercept, loss, n = total
            losses.append(loss / n + 0.5 * reg * float(w @ w))
            g = np.concatenate([by_factor.ravel(), by_linear if linear_on else [], [by_intercept] if intercept_on else []]) / n
            m = beta1 * m + (1 - beta1) * g
            v = beta2 * v + (1 - beta2) * (g * g)
            w = w - (self.getStepSize() * (m / (1 - beta1 ** step)) / (np.sqrt(v / (1 - beta2 ** step)) + eps) + reg * w)
            if last is not None and np.linalg.norm(last - w) < self.getTol() * max(np.linalg.norm(w), 1.0):
                break
            last = w
        rest = w[width * k:]
        return w[:width * k].reshape(width, k), rest[:width] if linear_on else np.zeros(width), rest[-1] if intercept_on else 0.0, losses
