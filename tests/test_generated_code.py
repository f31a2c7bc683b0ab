"""The feature plans stay within what the JVM compiles: a longer method is interpreted, many times slower."""

import re

import pytest
from pyspark.sql import functions as F

from credere.functions.casts import guarded_cast
from credere.operators import features as T
from credere.plans import catalog_models as C

JIT_LIMIT = 8000   # HotSpot's HugeMethodLimit


@pytest.mark.parametrize("sf,bins", [("sf0.001", 2000), ("sf0.01", 2000), ("sf0.01", 50)])
def test_feature_plans_are_compiled(spark, sf, bins):
    clean = C.staged_clean(spark, f"/root/testdata/{sf}")
    train, _ = C.train_test(spark, None, clean)
    fm = T.FeatureBuilder(C.PR, tree_bins=bins).fit(train)
    frames = [fm.transform(train).select(*C.KEEP, fm.tree_col), fm.transform_flagged(clean).select(*C.KEEP, fm.tree_col, "rejected")]
    codegen = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in frames:
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", df._jdf.queryExecution().explainString(codegen))]
            assert sizes and max(sizes) < JIT_LIMIT
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_integer_texts(spark):
    texts = {"360": 360, "360.0": 360, "360.": 360, " 7 ": 7, " -7.9 ": -7, "+5": 5, "1e3": None, "NA": None, "": None, "1.2.3": None,
             "12 3": None, ".5": None, "99999999999": None, None: None}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.v for r in df.select("t", guarded_cast("t", df.select(F.lit(1).alias("i")).schema["i"].dataType).alias("v")).collect()}
    assert got == texts


def test_skip_drops_null_and_unseen_in_any_column(spark):
    train = spark.createDataFrame([("a", "p"), ("b", "q")], "c string, d string")
    df = spark.createDataFrame([("a", "q"), ("z", "q"), ("b", None), (None, "p"), ("b", "p")], "c string, d string")
    got = T.apply_label_index(df, T.fit_label_index(train, ["c", "d"]), ["c", "d"], "skip")
    assert sorted((r.c, r.d, r.c_index, r.d_index) for r in got.collect()) == [("a", "q", 0.0, 1.0), ("b", "p", 1.0, 0.0)]
