"""Nominal columns with more categories than a tree's bins."""

import math

import pytest
from pyspark.sql import functions as F

from credere.operators import features as T
from credere.operators import train as M
from credere.plans import catalog
from credere.plans.catalog_features import staged_clean, train_test
from credere.profile import LINEITEM as PR


@pytest.mark.parametrize("arity,bins", [(1, 2), (20, 20), (21, 20), (60, 20), (401, 20), (9000, 20), (360_000, 2000)])
def test_digits_tell_all_categories_apart(arity, bins):
    ds = T.digits(arity, bins)

    def of(i):
        for stride, _ in ds:
            yield i // stride
            i %= stride

    seen = {tuple(of(i)) for i in range(arity)}
    assert len(seen) == arity and all(n <= bins for _, n in ds)
    assert all(max(t[k] for t in seen) < n for k, (_, n) in enumerate(ds))
    assert (len(ds) == 1) == (arity <= bins)


def _frame(spark):
    return spark.range(0, 6000).select("id", (F.col("id") % 60).cast("string").alias("h"), (F.col("id") % 7).cast("double").alias("v"),
                                       (F.col("id") % 2).cast("string").alias("c"), (F.col("id") % 60 < 18).cast("int").alias("label"))


def test_trees_fit_save_and_score_above_their_bins(spark, tmp_path):
    df = _frame(spark)
    fm = T.FeatureBuilder(low_card=["c"], high_card=["h"], numeric=["v"], tree_bins=20).fit(df)
    assert fm.check_bins(20) == 20 and fm.tree_col == "tree_features" and fm.feature_names()[-1] == "h_index"
    out = fm.transform(df)
    attrs = out.schema["tree_features"].metadata["ml_attr"]["attrs"]["nominal"]
    assert [a["num_vals"] for a in attrs if a["name"].startswith("h_")] == [20, 3]
    assert out.select("h", "tree_features").distinct().count() == df.select("h", "v", "c").distinct().count()
    model = M.estimator("Decision Tree", features_col=fm.tree_col, max_bins=20, n_features=fm.tree_width()).fit(out)
    fm.save(str(tmp_path / "fm"))
    again = T.FeatureModel.load(spark, str(tmp_path / "fm"))
    more = df.unionByName(df.limit(1).withColumn("h", F.lit("unseen")).withColumn("id", F.lit(-1)))
    for m in (fm, again):
        got = M.predict(model, m.transform_flagged(more), ["id", "label", "rejected"])
        assert got.filter("rejected").count() == 1
        right = got.filter("NOT rejected").agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]
        assert right > 0.9   # the majority rate is 0.7


def test_narrow_columns_stay_one_slot(spark):
    df = _frame(spark)
    fm = T.FeatureBuilder(low_card=["c"], high_card=["h"], numeric=["v"], tree_bins=60).fit(df)
    assert fm.tree_col == "features" and fm.tree_width() == len(fm.feature_names()) and "tree_features" not in fm.transform(df).columns


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    """sf0.001 with more suppliers than the profile's bins."""
    path = str(tmp_path_factory.mktemp("wide"))
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    lines.withColumn("l_suppkey", F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(9000))).coalesce(1).write.parquet(f"{path}/lineitem.parquet")
    return path


def test_roles_as_declared_above_the_bins(spark, wide):
    got = {r["column"]: r for r in catalog.queries()["feature_roles"](spark, wide).collect()}
    s = got["l_suppkey"]
    assert s.treatment == "nominal" and s.bins == PR.tree_bins < s.categories


@pytest.mark.parametrize("query", ["fit_lr", "fit_dt", "fit_rf", "stream_score"])
def test_fits_above_the_bins(spark, wide, query):
    rows = catalog.queries()[query](spark, wide).select("l_orderkey", "prediction", "score").collect()
    assert rows and all(r.score is None or math.isfinite(r.score) for r in rows)
    assert {r.prediction for r in rows} <= {0.0, 1.0, None}


@pytest.fixture(scope="module")
def held_out(spark, wide):
    """Keys of the held-out rows whose categories all occur on the training side: what a fit has to score."""
    train, test = train_test(spark, wide)
    test = test.dropna(how="any", subset=PR.categorical)
    for c in PR.categorical:
        test = test.join(train.select(c).distinct(), c, "left_semi")
    return sorted(tuple(r) for r in test.select("l_orderkey", "l_linenumber", "label").collect())


def _scores_all(spark, wide, held_out, query):
    rows = catalog.queries()[query](spark, wide).select("l_orderkey", "l_linenumber", "label", "prediction", "score").collect()
    assert held_out and sorted((r.l_orderkey, r.l_linenumber, r.label) for r in rows) == held_out
    assert all(r.prediction in (0.0, 1.0) and math.isfinite(r.score) for r in rows)


@pytest.mark.parametrize("query", ["fit_fm", "fit_gbt", "fit_rf", "fit_lr", "fit_svm"])
def test_fits_score_all_rows_above_the_bins(spark, wide, held_out, query):
    _scores_all(spark, wide, held_out, query)


def test_stream_scores_all_rows_above_the_bins(spark, wide):
    rows, (train, _) = staged_clean(spark, wide), train_test(spark, wide)
    for c in PR.categorical:
        rows = rows.join(train.select(c, F.lit(True).alias(f"seen_{c}")).dropna().distinct(), c, "left")
    rejected = F.coalesce(*[F.when(F.col(f"seen_{c}").isNull(), F.lit(True)) for c in PR.categorical], F.lit(False))
    want = sorted(tuple(r) for r in rows.select("l_orderkey", "l_linenumber", rejected).collect())
    got = catalog.queries()["stream_score"](spark, wide).collect()
    assert len({r[2] for r in want}) == 2 and sorted((r.l_orderkey, r.l_linenumber, r.rejected) for r in got) == want
    assert all((r.prediction is None) if r.rejected else r.prediction in (0.0, 1.0) for r in got)


def test_sweep_runs_all_models_above_the_bins(spark, wide):
    def cached():
        return set(spark.sparkContext._jsc.getPersistentRDDs().keySet())

    before = cached()
    got = catalog.queries()["model_sweep"](spark, wide).collect()
    assert {r.name for r in got} == set(M.MODEL_NAMES) and len(got) == 30 and all(math.isfinite(r.value) for r in got)
    assert cached() <= before   # the training frame is released
