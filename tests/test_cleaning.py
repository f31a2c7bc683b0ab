"""Trap fixtures for casting, labels, filters, modes and imputation."""

import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from credere.functions.casts import guarded_cast
from credere.functions.codes import age_bucket, dti_bucket
from credere.operators import clean as C
from credere.operators import columns as P
from credere.operators import quality as Q


def _one(spark, values, dtype="string", name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {dtype}")


def test_bad_cast(spark):
    vals = ["NA", "Exempt", "", "360", "360.0", "1e3", "5-24", " 42 ", None]
    out = _one(spark, vals).select(guarded_cast("x", T.IntegerType()).alias("y")).collect()
    assert [r.y for r in out] == [None, None, None, 360, 360, None, None, 42, None]


def test_float_cast_keeps_nan_text_apart(spark):
    out = _one(spark, ["1.5", "NA", None]).select(guarded_cast("x", T.FloatType()).alias("y")).collect()
    assert [r.y for r in out] == [1.5, None, None]


def test_null_label_default_and_strict(spark):
    df = _one(spark, [1, 3, None], "int", "code")
    assert [r.code for r in P.binarise_label(df, "code", 1).collect()] == [1, 0, 1]
    assert [r.code for r in P.binarise_label(df, "code", 1, strict=True).collect()] == [1, 0]


def test_sentinel_and_nonzero_filters(spark):
    assert [r.x for r in C.sentinel_filter(_one(spark, ["CA", "NA", None]), ["x"]).collect()] == ["CA"]
    assert [r.x for r in C.nonzero_filter(_one(spark, [100.0, 0.0, None], "double"), ["x"]).collect()] == [100.0]


def test_null_mode_and_tie_mode(spark):
    df = _one(spark, [None, None, None, 360, 360, 180], "int")
    assert Q.mode_value(df, "x", null_counts=True) is None
    assert Q.mode_value(df, "x", null_counts=False) == 360
    assert Q.mode_value(_one(spark, [360, 360, 180, 180], "int"), "x") == 180


def test_null_mode_leaves_column_unchanged(spark):
    df = _one(spark, [None, None, 5], "int")
    out, model = C.impute(df, mode=["x"])
    assert model.mode["x"] is None
    assert sorted([r.x for r in out.collect()], key=lambda v: (v is not None, v)) == [None, None, 5]


def test_median_and_mean_skip_null_and_nan(spark):
    df = _one(spark, [1.0, 2.0, 3.0, 10.0, None, float("nan")], "double")
    m = C.fit_impute(df, median=["x"], mean=["x"], relative_error=0.0)
    assert m.median["x"] == 2.0
    assert m.mean["x"] == 4.0
    out = C.ImputeModel(median={"x": 2.0}).transform(df).collect()
    assert [r.x for r in out] == [1.0, 2.0, 3.0, 10.0, 2.0, 2.0]


def test_census_after_imputation_is_zero(spark):
    df = spark.createDataFrame([(1.0, 3), (None, None), (float("nan"), 3)], "a double, b int")
    out, _ = C.impute(df, mean=["a"], mode=["b"], mode_null_counts=False)
    row = Q.missing_census(out).first()
    assert row.a == 0 and row.b == 0


def test_missing_census_type_aware(spark):
    df = spark.createDataFrame([("NA", 1.0, 1), (None, float("nan"), None), ("x", 2.0, 3)],
                               "s string, f double, i int")
    row = Q.missing_census(df).first()
    assert (row.s, row.f, row.i) == (2, 1, 1)
    row = Q.missing_census(df, nan=False, sentinel=None).first()
    assert (row.s, row.f, row.i) == (1, 0, 1)


def test_distinct_counts_null_is_a_value(spark):
    assert Q.distinct_counts(_one(spark, ["a", "b", None])).first().x == 3


def test_column_profile(spark):
    df = spark.createDataFrame([("a", 1.0), ("NA", None), (None, 2.0)], "s string, f double")
    rows = {r.column: r for r in P.column_profile(df).collect()}
    assert rows["s"].missing == 2 and rows["s"].distinct == 3 and rows["s"].rows == 3
    assert rows["f"].missing == 1 and rows["f"].type == "double"


def test_age_bucket(spark):
    texts = ["<25", "25-34", "35-44", "45-54", "55-64", "65-74", ">74", "8888", "9999", "NA", None]
    out = _one(spark, texts).select(guarded_cast(age_bucket("x"), T.IntegerType()).alias("y")).collect()
    assert [r.y for r in out] == [0, 1, 2, 3, 4, 5, 6, 9, 9, None, None]


def test_dti_bucket_first_match_wins(spark):
    out = _one(spark, ["43%", ">60%", "NA", None]).select(dti_bucket("x").alias("y")).collect()
    assert [r.y for r in out] == [10, 19, 20, 20]


def test_class_balance(spark):
    df = _one(spark, [1, 1, 0, 1], "int", "label")
    rows = {r.label: (r["count"], r.share) for r in Q.class_balance(df, "label").collect()}
    assert rows[1][0] == 3 and math.isclose(rows[1][1], 0.75)


def test_single_projection_cast(spark):
    from credere.profile import LOAN
    schema = T.StructType([T.StructField(c, T.StringType()) for c in LOAN.names])
    typed = P.typed_cast(spark.createDataFrame([tuple(["1"] * len(LOAN.names))], schema), LOAN)
    assert [f.dataType for f in typed.schema.fields] == [f.dataType for f in LOAN.typed_schema.fields]
    assert typed.select(F.col("loan_amount")).first()[0] == 1.0


def test_exact_quantile_matches_sorted_rank(spark):
    import random
    rnd = random.Random(3)
    vals = [float(rnd.randint(0, 40)) for _ in range(1001)] + [None, float("nan")]
    df = _one(spark, vals, "double")
    clean = sorted(v for v in vals if v is not None and v == v)
    assert C.exact_quantile(df, "x", 0.5) == clean[(len(clean) + 1) // 2 - 1]
    assert C.exact_quantile(df, "x", 0.9) == clean[math.ceil(0.9 * len(clean)) - 1]
    assert C.exact_quantile(_one(spark, [None], "double"), "x") is None


def test_exact_quantile_of_repeated_values(spark):
    vals = [float(v % 97) for v in range(2000)]
    assert C.exact_quantile(_one(spark, vals, "double"), "x", 0.5) == sorted(vals)[999]


def test_approximate_median_is_within_its_rank_error(spark):
    vals = [float(v * 7919 % 100_003) for v in range(20_000)]
    got = C.fit_impute(_one(spark, vals, "double"), median=["x"], relative_error=0.001).median["x"]
    assert abs(sorted(vals).index(got) + 1 - 10_000) <= 0.001 * 20_000 + 1
