"""Metrics, AUC, trainers, tracking and scoring."""

import math
from functools import partial

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from credere.operators import evaluate as E
from credere.operators import features as T
from credere.operators import score as X
from credere.operators import train as M
from credere.operators.tracking import Tracker, leaderboard


def test_metrics_fixture(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0), (1.0, 0.0), (0.0, 0.0), (1.0, 1.0)], "label double, prediction double")
    row = E.classification_metrics(df).first()
    for m in ("accuracy", "weightedPrecision", "weightedRecall", "f1"):
        assert math.isclose(row[m], 0.6, rel_tol=1e-12), m


def test_auc_fixture(spark):
    df = spark.createDataFrame([(1, 2.0), (0, 1.0), (1, -0.5), (0, -1.0), (1, 1.0)], "label int, score double")
    assert math.isclose(E.auc_exact(df).first().areaUnderROC, 0.75)


def test_metrics_equal_mllib_on_random_data(spark):
    df = spark.range(0, 4000).select(
        (F.rand(1) > 0.6).cast("double").alias("label"),
        F.round(F.rand(2) * 20).alias("s"))
    df = df.withColumn("score", F.col("s") + F.col("label") * 3).withColumn(
        "prediction", (F.col("score") > 12).cast("double"))
    ours = E.metrics_dict(df)
    for m in ("accuracy", "weightedPrecision", "weightedRecall", "f1"):
        ref = MulticlassClassificationEvaluator(metricName=m).evaluate(df)
        assert math.isclose(ours[m], ref, rel_tol=1e-9), m
    assert math.isclose(ours["weightedRecall"], ours["accuracy"], rel_tol=1e-12)
    raw = df.withColumn("rawPrediction", F.array(-F.col("score"), F.col("score")))
    from pyspark.ml.functions import array_to_vector
    raw = raw.withColumn("rawPrediction", array_to_vector("rawPrediction"))
    ref = BinaryClassificationEvaluator(numBins=0).evaluate(raw)
    assert math.isclose(ours["areaUnderROC"], ref, rel_tol=1e-9)


def _toy(spark, n=400):
    rows = []
    for i in range(n):
        x = (i % 20) / 20.0
        rows.append((float(x > 0.5), Vectors.dense([x, (i % 7) / 7.0])))
    return spark.createDataFrame(rows, ["label", "features"])


def test_models_beat_majority_and_are_seeded(spark):
    df = _toy(spark)
    for name in M.MODEL_NAMES:
        est = M.estimator(name, max_bins=32, n_features=2, maxIter=10) if name not in (
            "Decision Tree", "Random Forest") else M.estimator(name, max_bins=32, n_features=2)
        m = est.fit(df)
        p1 = [r.prediction for r in m.transform(df).orderBy("features").collect()]
        acc = sum(1 for (r, p) in zip(df.orderBy("features").collect(), p1) if r.label == p) / df.count()
        assert acc > 0.5, name
    a = M.estimator("Random Forest", max_bins=32).fit(df).transform(df).select("prediction").collect()
    b = M.estimator("Random Forest", max_bins=32).fit(df).transform(df).select("prediction").collect()
    assert a == b


def test_tracker_and_leaderboard(spark, tmp_path):
    tr = Tracker(spark, str(tmp_path / "track"))
    for exp, name, acc in [("e1", "a", 0.5), ("e1", "b", 0.7), ("e2", "c", 0.6)]:
        run = tr.start_run(exp, name)
        tr.log_params(run, {"maxIter": 10})
        tr.log_metrics(run, {"accuracy": acc})
        tr.end_run(run)
    best = {r.experiment: r.name for r in leaderboard(tr.runs(), tr.metrics()).collect()}
    assert best == {"e1": "b", "e2": "c"}
    assert tr.params().count() == 3


def test_model_save_load_same_predictions(spark, tmp_path):
    df = _toy(spark)
    tr = Tracker(spark, str(tmp_path / "t2"))
    run = tr.start_run("x", "lr")
    m = M.estimator("Logistic Regression").fit(df)
    tr.log_model(run, m)
    tr.end_run(run)
    from pyspark.ml.classification import LogisticRegressionModel
    m2 = tr.load_model(run, LogisticRegressionModel)
    assert m.transform(df).select("prediction").collect() == m2.transform(df).select("prediction").collect()


def test_domain_violations_and_decode(spark):
    df = spark.createDataFrame([(1, 2, "x"), (2, 9, None), (3, None, "y")], "k int, a int, b string")
    v = X.domain_violations(df, {"a": {"range": (1, 5)}, "b": {"in": ["x"]}}, ["k"])
    got = {(r.k, r.column, r.reason) for r in v.collect()}
    assert got == {(2, "a", "out_of_domain"), (2, "b", "missing"), (3, "a", "missing"), (3, "b", "out_of_domain")}
    d = X.decode_codes(df, {"b": {"x": "ex"}}, default="unknown").select("b_text").collect()
    assert sorted(r.b_text for r in d) == ["ex", "unknown", "unknown"]


def test_rejected_rows(spark):
    train = spark.createDataFrame([("a", "p"), ("b", "q")], "c string, d string")
    inputs = spark.createDataFrame([("a", "q"), ("z", "q"), ("b", None), ("z", "y")], "c string, d string")
    got = X.rejected_rows(inputs, T.fit_label_index(train, ["c", "d"]), ["c", "d"])
    assert got.columns == ["c", "d"] and sorted(map(str, map(tuple, got.collect()))) == ["('b', None)", "('z', 'q')", "('z', 'y')"]


def _small(spark, n=200):
    rows = [(f"c{i % 3}", float(i % 17), f"h{i % 5}", i % 2, i) for i in range(n)]
    df = spark.createDataFrame(rows, "c string, v double, h string, label int, id long")
    return df, T.FeatureBuilder(low_card=["c"], high_card=["h"], numeric=["v"]).fit(df)


def test_bulk_score_keeps_rejected_rows(spark):
    df, fm = _small(spark)
    lr = M.estimator("Logistic Regression").fit(fm.transform(df))
    more = df.drop("label").unionByName(spark.createDataFrame([("new", 1.0, "h1", 900), ("c1", 1.0, None, 901)], "c string, v double, h string, id long"))
    got = {r.id: r for r in X.bulk_score(more, fm, lr, ["id"]).collect()}
    assert len(got) == 202 and {i for i, r in got.items() if r.rejected} == {900, 901} == {i for i, r in got.items() if r.prediction is None}
    known = {r.id: r.score for r in M.predict(lr, fm.transform(df), ["id"]).collect()}
    assert all(math.isclose(got[i].score, s) for i, s in known.items())


def test_score_rows_checks_keys(spark):
    df, fm = _small(spark)
    lr = M.estimator("Logistic Regression").fit(fm.transform(df))
    rows = [{"c": "c1", "v": 2.0, "h": "h1", "id": 1}, {"c": "zz", "v": 2.0, "h": "h1", "id": 2, "label": 1}]
    got = {r.id: r for r in X.score_rows(spark, rows, df.schema, fm, lr, ["id", "label"], label_col="label").collect()}
    assert got[1].label == 0 and got[1].prediction in (0.0, 1.0) and got[2].rejected and got[2].label == 1
    for wrong in ({"c": "c1", "v": 2.0, "id": 1}, {"c": "c1", "v": 2.0, "h": "h1", "id": 1, "x": 3}):
        with pytest.raises(ValueError, match="do not fit"):
            X.score_rows(spark, [wrong], df.schema, fm, lr, ["id"], label_col="label")


def test_sweep_leaves_the_callers_cache_and_records_failures(spark, tmp_path):
    df, fm = _small(spark)
    train, test = fm.transform(df).persist(), fm.transform(df)
    tracker = Tracker(spark, str(tmp_path / "runs"))
    M.sweep(train, test, names=["Decision Tree"], tracker=tracker, max_bins=32)
    assert train.is_cached and not test.is_cached
    with pytest.raises(Exception, match="maxBins"):
        M.sweep(train, test, names=["Decision Tree"], tracker=tracker, max_bins=2)
    assert sorted(r.status for r in tracker.runs().collect()) == [3, 4]
    train.unpersist()


def test_feature_model_is_logged_and_loaded_by_run(spark, tmp_path):
    df, fm = _small(spark)
    tracker = Tracker(spark, str(tmp_path / "runs"))
    run = tracker.start_run("e", "features")
    tracker.log_model(run, fm, "features")
    tracker.end_run(run)
    again = tracker.load_model(run, T.FeatureModel, "features")
    a, b = (sorted((r.id, tuple(r.features)) for r in m.transform(df).collect()) for m in (fm, again))
    assert a == b


@pytest.mark.parametrize("label", [0, 1])
def test_auc_of_one_class_equals_the_evaluator(spark, label):
    df = spark.createDataFrame([(label, 0.2), (label, 0.7), (label, 0.7)], "label int, score double")
    raw = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0)
    assert E.auc_exact(df).first().areaUnderROC == raw.evaluate(df) == float(label)
    assert E.auc_exact(df.limit(0)).first().areaUnderROC is None


def test_auc_with_ties_equals_the_evaluator(spark):
    df = spark.range(0, 3000).select((F.rand(5) > 0.5).cast("int").alias("label"), F.round(F.rand(6) * 50).alias("score"))
    raw = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0)
    assert math.isclose(E.auc_exact(df).first().areaUnderROC, raw.evaluate(df), rel_tol=1e-12)


def test_tuning_query_runs_the_whole_grid_with_all_trees(spark, monkeypatch):
    from credere.plans import catalog, catalog_models
    asked = []

    def tune(est, grid, train, **kw):
        asked.append((est.getMaxIter(), len(grid), {(m[est.maxDepth], m[est.maxBins], m[est.stepSize]) for m in grid}))
        raise StopIteration

    monkeypatch.setattr(catalog_models.M, "tune", tune)
    for query in (catalog.queries()["tune_gbt"], partial(catalog_models.q_tune_gbt, max_iter=1)):
        with pytest.raises(StopIteration):
            query(spark, "/root/testdata/sf0.001")
    assert [a[:2] for a in asked] == [(20, 27), (1, 27)] and len(asked[0][2]) == 27
