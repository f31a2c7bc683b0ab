"""Splits, label index, one-hot, scaling, feature model round trip."""

from collections import Counter

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from credere.operators import features as T
from credere.operators import split as L


def test_hash_split_disjoint_cover_and_stable(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "k")
    tr, te = L.hash_split(df, "k", 80)
    a, b = {r.k for r in tr.collect()}, {r.k for r in te.collect()}
    assert not (a & b) and len(a | b) == 2000
    tr2, _ = L.hash_split(df.repartition(7), "k", 80)
    assert {r.k for r in tr2.collect()} == a
    assert 1400 < len(a) < 1800


def test_hash_sample_subset_of_keys(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "k")
    s = {r.k for r in L.hash_sample(df, "k", 0.1).collect()}
    assert 300 < len(s) < 700
    assert s == {r.k for r in L.hash_sample(df.repartition(5), "k", 0.1).collect()}


def test_index_ties_by_text(spark):
    df = spark.createDataFrame([(v,) for v in ["c", "a", "b", "a", "b", "c"]], "x string")
    idx = T.fit_label_index(df, ["x"])
    got = {r["value"]: r["index"] for r in idx.labels.collect()}
    assert got == {"a": 0.0, "b": 1.0, "c": 2.0}


def test_label_index_matches_string_indexer(spark):
    df = spark.range(0, 3000).select((F.col("id") * 7919 % 37).cast("int").alias("n"),
                                     F.concat(F.lit("v"), (F.col("id") % 11).cast("string")).alias("s"))
    idx = T.fit_label_index(df, ["n", "s"])
    ours = T.apply_label_index(df.withColumn("rid", F.monotonically_increasing_id()), idx, ["n", "s"])
    si = StringIndexer(inputCols=["n", "s"], outputCols=["n_si", "s_si"]).fit(df)
    theirs = si.transform(df.withColumn("rid", F.monotonically_increasing_id()))
    a = {(r.n, r.s, r.n_index, r.s_index) for r in ours.collect()}
    b = {(r.n, r.s, r.n_si, r.s_si) for r in theirs.collect()}
    assert a == b


def test_unseen_policies_and_report(spark):
    train = spark.createDataFrame([("a",), ("b",), ("a",)], "x string")
    test = spark.createDataFrame([("a",), ("z",), (None,)], "x string")
    idx = T.fit_label_index(train, ["x"])
    assert T.apply_label_index(test, idx, ["x"], "skip").count() == 1
    kept = {r.x: r.x_index for r in T.apply_label_index(test, idx, ["x"], "keep").collect()}
    assert kept == {"a": 0.0, "z": 2.0, None: 2.0}
    rep = {r.column: r.rows_lost for r in T.unseen_report(test, idx, ["x"]).collect()}
    assert rep == {"x": 2, "*": 2}


def test_single_category_rejected(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "c string, v double")
    with pytest.raises(ValueError):
        T.FeatureBuilder(low_card=["c"], high_card=[], numeric=["v"]).fit(df)


def test_one_hot_drop_last_and_constant_scale(spark):
    df = spark.createDataFrame([("a", 5.0, "p"), ("a", 5.0, "q"), ("b", 5.0, "p"), ("b", 5.0, "q"),
                                ("c", 5.0, "p")], "c string, v double, h string")
    fm = T.FeatureBuilder(low_card=["c"], high_card=["h"], numeric=["v"]).fit(df)
    rows = T.vector_columns(fm.transform(df), "features", fm.feature_names(), ["c"]).collect()
    got = {(r.c, r.v_scaled, r.c_ohe_0, r.c_ohe_1) for r in rows}
    # a and b tie on count (2) and come first by text; c is the dropped last category
    assert got == {("a", 0.0, 1.0, 0.0), ("b", 0.0, 0.0, 1.0), ("c", 0.0, 0.0, 0.0)}
    assert fm.check_bins(32) == 32


def test_feature_model_save_load_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0, "p"), ("b", 2.0, "q"), ("a", 3.0, "q")], "c string, v double, h string")
    fm = T.FeatureBuilder(low_card=["c"], high_card=["h"], numeric=["v"]).fit(df)
    fm.save(str(tmp_path / "fm"))
    fm2 = T.FeatureModel.load(spark, str(tmp_path / "fm"))
    a = sorted(tuple(r.features) for r in fm.transform(df).collect())
    b = sorted(tuple(r.features) for r in fm2.transform(df).collect())
    assert a == b


def test_nominal_metadata_bounded(spark):
    df = spark.range(0, 200).select((F.col("id") % 50).cast("string").alias("h"), F.lit(1.0).alias("v"),
                                    (F.col("id") % 2).cast("string").alias("c"))
    fm = T.FeatureBuilder(low_card=["c"], high_card=["h"], numeric=["v"], rank_encoded=["h"]).fit(df)
    assert fm.check_bins(32) == 32 and fm.nominal_columns() == ["c"]
    fm = T.FeatureBuilder(low_card=["c"], high_card=["h"], numeric=["v"]).fit(df)
    assert fm.check_bins(50) == 50
    with pytest.raises(ValueError, match="'h': 50"):
        fm.check_bins(49)


def test_treatment_does_not_depend_on_arity(spark):
    df = spark.range(0, 10000).select((F.col("id") % 5000).cast("string").alias("h"), F.lit(1.0).alias("v"), (F.col("id") % 2).cast("string").alias("c"))
    fm = T.FeatureBuilder(low_card=["c"], high_card=["h"], numeric=["v"]).fit(df)
    assert fm.nominal_columns() == ["c", "h"] and fm.check_bins(5000) == 5000
    attrs = fm.transform(df).schema["features"].metadata["ml_attr"]["attrs"]["nominal"]
    assert next(a["num_vals"] for a in attrs if a["name"] == "h_index") == 5000


def test_error_policy_names_the_value(spark):
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    index = T.fit_label_index(train, ["c"])
    with pytest.raises(Exception, match="unseen or NULL category in c: z"):
        T.apply_label_index(spark.createDataFrame([("z",)], "c string"), index, ["c"], policy="error").collect()


def test_label_index_ranks(spark):
    df = spark.range(0, 5000).select((F.col("id") * 31 % 97).cast("string").alias("a"),
                                     (F.col("id") % 13).cast("int").alias("b"))
    index = T.fit_label_index(df, ["a", "b"])
    got = {(r["column"], r["value"], r["index"]) for r in index.labels.collect()}
    want = set()
    for c in ("a", "b"):
        n = Counter(str(r[0]) for r in df.select(c).collect())
        want |= {(c, v, float(i)) for i, v in enumerate(sorted(n, key=lambda v: (-n[v], v)))}
    assert got == want and index.arity == {"a": 97, "b": 13}
