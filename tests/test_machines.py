"""Factorization machines on blocks of rows are MLlib's, and rows are dealt out where few tasks would read them."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import FMClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from credere.operators import features as T
from credere.operators import train as M
from credere.operators.machines import BlockFMClassifier
from credere.sources.tables import evenly_read


@pytest.fixture(scope="module")
def frame(spark):
    df = spark.range(0, 3000).select(F.rand(1).alias("a"), F.round(F.rand(2) * 30).alias("b"), (F.col("id") % 5).cast("double").alias("c0"),
                                     F.floor(F.rand(4) * 37).cast("double").alias("d0"), F.lit(1.0).alias("e"))
    df = df.withColumn("label", ((F.col("a") * F.col("b") + F.pmod(F.col("d0") * 7, F.lit(11)) * 0.4 - 0.2 * F.col("c0") + F.rand(9) * 3) > 10).cast("int"))
    df = df.withColumn("c", T.nominal("c0", "c", 5)).withColumn("d", T.nominal("d0", "d", 40))   # three categories of d never occur
    df = VectorAssembler(inputCols=list("abcde"), outputCol="features").transform(df).persist()
    yield df
    df.unpersist()


@pytest.mark.parametrize("given", [{"maxIter": 20}, {"maxIter": 15, "regParam": 0.05}, {"maxIter": 10, "fitLinear": False, "fitIntercept": False, "factorSize": 3},
                                   {"maxIter": 200, "tol": 0.05}])
def test_factorization_machines_are_mllibs(frame, given):
    ours, ref = (c(seed=42, stepSize=0.1, **given).fit(frame) for c in (BlockFMClassifier, FMClassifier))
    assert np.allclose(ours.factors.toArray(), ref.factors.toArray(), rtol=1e-8, atol=1e-10)
    assert np.allclose(ours.linear.toArray(), ref.linear.toArray(), rtol=1e-8, atol=1e-10) and math.isclose(ours.intercept, ref.intercept, rel_tol=1e-8, abs_tol=1e-10)
    theirs = ref.summary().objectiveHistory   # ends with the loss after the last step
    assert np.allclose(ours.objective_history, theirs[:len(ours.objective_history)], rtol=1e-8)


def test_queries_fit_machines_on_blocks():
    assert isinstance(M.estimator("Factorization Machine"), BlockFMClassifier)


def test_uneven_row_groups_are_seen(spark, tmp_path):
    spark.range(0, 1000).coalesce(1).write.parquet(str(tmp_path / "one"))
    spark.range(0, 4000).repartition(16).write.parquet(str(tmp_path / "many"))
    assert not evenly_read(spark.read.parquet(str(tmp_path / "one")))
    many = spark.read.parquet(str(tmp_path / "many"))
    assert evenly_read(many, slack=2.0) or many.rdd.getNumPartitions() < 4
