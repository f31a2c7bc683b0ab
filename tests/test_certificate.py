"""Optimality certificates of linear fits: near zero at the fitted weights, not beside them."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from credere.operators import certificate as C
from credere.operators import train as M


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(11)
    x = np.stack([rng.normal(size=600), rng.normal(2.0, 3.0, 600), rng.integers(0, 2, 600)], 1)
    y = (x @ [1.2, -0.5, 0.8] + rng.logistic(size=600) > -0.4).astype(float)
    return x, y


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame([(float(b), Vectors.dense(a)) for a, b in zip(*rows, strict=True)], ["label", "features"]).repartition(3).cache()


def moved(scored, by):
    return scored.withColumn("rawPrediction", array_to_vector(F.transform(vector_to_array("rawPrediction"), lambda v: v * by)))


def at(scored, x, w):
    """``scored`` with the margins of other weights, the last one the intercept."""
    margin = F.lit(float(w[-1])) + sum(vector_to_array("features")[i] * float(v) for i, v in enumerate(w[:-1]))
    return scored.withColumn("rawPrediction", array_to_vector(F.array(-margin, margin)))


def test_logistic_fit_is_certified_and_moved_weights_are_not(table, rows):
    model = M.estimator("Logistic Regression").fit(table)
    scored = model.transform(table)
    assert C.optimality_gap(scored, "log") < 1e-4
    assert C.optimality_gap(moved(scored, 1.01), "log") > 1e-4
    w = np.append(model.coefficients.toArray(), model.intercept)
    for i in range(len(w)):
        beside = w.copy()
        beside[i] *= 1.01
        assert C.optimality_gap(at(scored, rows[0], beside), "log") > 1e-4, i


def test_gradients_match_numpy(table, rows):
    x, y = rows
    one, sign = np.c_[x, np.ones(len(x))], 2 * y - 1
    w = np.array([0.7, -0.2, 0.4, 0.3])
    m = sign * (one @ w)
    scored = at(table, x, w)
    low, high = C.subgradient(scored, "log")
    assert np.allclose(low, (-sign / (1 + np.exp(m))) @ one / len(x)) and np.allclose(low, high)
    for band in (0.0, 0.2):
        near = np.abs(m - 1) <= band
        sure = (-sign * (~near & (m < 1))) @ one
        each = -sign[near, None] * one[near]
        low, high = C.subgradient(scored, "hinge", band=band)
        assert np.allclose(low, (sure + np.minimum(each, 0).sum(0)) / len(x))
        assert np.allclose(high, (sure + np.maximum(each, 0).sum(0)) / len(x))


def test_hinge_fit_is_certified_and_moved_weights_are_not(table):
    scored = M.estimator("Support Vector Machine", maxIter=400, tol=1e-9).fit(table).transform(table)
    assert C.optimality_gap(scored, "hinge", band=1e-3) < 1e-3
    assert C.optimality_gap(moved(scored, 1.01), "hinge", band=1e-3) > 1e-3


def test_no_rows_and_unknown_losses_are_errors(table):
    scored = at(table, None, [0.0, 0.0, 0.0, 0.0])
    with pytest.raises(ValueError, match="no rows"):
        C.subgradient(scored.where("label > 5"), "log")
    with pytest.raises(ValueError, match="unknown loss"):
        C.subgradient(scored, "squared")
