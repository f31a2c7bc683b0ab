"""Boosted trees on blocks of rows are MLlib's."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from credere.operators import features as T
from credere.operators import train as M
from credere.operators.boosting import BlockGBTClassifier, packs, thresholds
from credere.operators.machines import BlockFMClassifier


@pytest.fixture(scope="module")
def frame(spark):
    df = spark.range(0, 3000).select(F.rand(1).alias("a"), F.round(F.rand(2) * 30).alias("b"), (F.col("id") % 5).cast("double").alias("c0"),
                                     F.floor(F.rand(4) * 37).cast("double").alias("d0"), F.lit(1.0).alias("e"))
    df = df.withColumn("label", ((F.col("a") * F.col("b") + F.pmod(F.col("d0") * 7, F.lit(11)) * 0.4 - 0.2 * F.col("c0") + F.rand(9) * 3) > 10).cast("int"))
    df = df.withColumn("c", T.nominal("c0", "c", 5)).withColumn("d", T.nominal("d0", "d", 40))   # three categories of d never occur
    df = VectorAssembler(inputCols=list("abcde"), outputCol="features").transform(df).persist()
    yield df
    df.unpersist()


def _raw(model, df):
    return [r[0][1] for r in model.transform(df).select("rawPrediction").collect()]


def _same(ours, ref, df):
    assert np.allclose(_raw(ours, df), _raw(ref, df), rtol=1e-9, atol=1e-12) and ours.totalNumNodes == ref.totalNumNodes
    assert ours.treeWeights == ref.treeWeights and ours.numClasses == 2 and ours.numFeatures == ref.numFeatures


@pytest.mark.parametrize("given", [{"maxIter": 4}, {"maxIter": 2, "maxDepth": 0}, {"maxIter": 3, "minInstancesPerNode": 50, "minInfoGain": 0.01},
                                   {"maxIter": 3, "maxDepth": 3, "maxBins": 3000, "maxMemoryInMB": 0}])
def test_boosted_trees_are_mllibs(frame, given):
    given = {"maxBins": 40, "seed": 42, **given}
    _same(BlockGBTClassifier(**given).fit(frame), GBTClassifier(**given).fit(frame), frame)


def test_a_grid_gives_the_models_of_single_fits(spark, frame, tmp_path):
    def cached():
        return set(spark.sparkContext._jsc.getPersistentRDDs().keySet())

    before = cached()
    est = BlockGBTClassifier(seed=42, maxIter=3)
    ref = GBTClassifier(seed=42, maxIter=3)
    grid, theirs = (M.param_grid(e, {"maxDepth": [1, 3], "maxBins": [40, 64], "stepSize": [0.1, 0.5]}) for e in (est, ref))
    got = dict(est.fitMultiple(frame, grid))
    assert sorted(got) == list(range(8)) and cached() <= before
    for i, m in enumerate(theirs):
        _same(got[i], ref.fit(frame, m), frame)
    got[7].write().overwrite().save(str(tmp_path / "gbt"))
    assert _raw(GBTClassificationModel.load(str(tmp_path / "gbt")), frame) == _raw(got[7], frame)


def test_tuning_chooses_as_mllib(frame):
    ours, ref = BlockGBTClassifier(seed=42, maxIter=2, maxBins=40), GBTClassifier(seed=42, maxIter=2, maxBins=40)
    a, b = (M.tune(e, M.param_grid(e, {"maxDepth": [1, 3], "stepSize": [0.1, 0.9]}), frame, parallelism=4) for e in (ours, ref))
    assert np.allclose(a.validationMetrics, b.validationMetrics)
    _same(a.bestModel, b.bestModel, frame)


def test_queries_boost_on_blocks():
    assert isinstance(M.estimator("Gradient Boosting Trees"), BlockGBTClassifier)


@pytest.mark.parametrize("given", [{"subsamplingRate": 0.5}, {"weightCol": "a"}, {"featureSubsetStrategy": "sqrt"}])
def test_what_blocks_do_not_offer_stays_mllibs(frame, given):
    given = {"maxIter": 2, "maxBins": 40, "seed": 42, **given}
    _same(BlockGBTClassifier(**given).fit(frame), GBTClassifier(**given).fit(frame), frame)


@pytest.mark.parametrize("change,said", [({"label": 2}, "0 or 1"), ({"label": None}, "NULL"), ({"b": float("nan")}, "NaN")])
def test_bad_rows_are_errors(spark, change, said):
    rows = [{"label": i % 2, "b": float(i)} for i in range(20)]
    rows[7].update(change)
    df = VectorAssembler(inputCols=["b"], outputCol="features", handleInvalid="keep").transform(spark.createDataFrame(rows, "label int, b double"))
    for est in (BlockFMClassifier(maxIter=2), BlockGBTClassifier(maxIter=2)):
        with pytest.raises(Exception, match=said):
            est.fit(df)


def test_thresholds_lie_nearest_to_equal_shares():
    v, c = np.array([1.0, 2, 3, 4, 5, 6]), np.array([1, 1, 1, 1, 1, 1])
    assert thresholds(v, c, 5, 1.0).tolist() == [1.5, 2.5, 3.5, 4.5, 5.5]
    assert thresholds(v, c, 2, 2.0).tolist() == [2.5, 4.5]
    assert thresholds(np.array([3.0]), np.array([9]), 5, 1.0).size == 0


def test_narrow_slots_are_counted_together():
    got = packs([50, 2000, 11, 9, 2, 2, 2, 5000])
    assert sorted(f for p in got for f in p) == list(range(8)) and got[0] == [4, 5, 6, 3, 2]
    assert all(len(p) == 1 for p in got if 7 in p or 1 in p) and packs([6000]) == [[0]]
