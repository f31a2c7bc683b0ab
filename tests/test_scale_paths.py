"""Heavy-light lookup, sketches, samples to a size, several medians at once, given-weights scoring, run commits, quarantine."""

import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credere.operators import clean as C
from credere.operators import features as X
from credere.operators import quality as Q
from credere.operators import score as S
from credere.operators import split as L
from credere.operators.columns import column_profile
from credere.operators.tracking import FAILED, Tracker
from credere.plans.registry import QUERIES
from credere.sources import delimited as D
from credere.streaming.score_stream import score_stream

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().toString()


# ---------------------------------------------------------------- T1/T2/T10: lookup

def wide(spark, rows=4000):
    rng = random.Random(1)
    data = [(i, "hot" if i % 2 else f"v{rng.randrange(500)}", rng.choice("abc") if i % 7 else None, f"k{rng.randrange(90)}") for i in range(rows)]
    return spark.createDataFrame(data, "id int, city string, kind string, code string").repartition(4)


@pytest.mark.parametrize("broadcast", [X.BROADCAST_LABELS, 100])
@pytest.mark.parametrize("policy", ["skip", "keep"])
def test_lookup_equals_a_join(spark, monkeypatch, broadcast, policy):
    monkeypatch.setattr(X, "BROADCAST_LABELS", broadcast)
    train = wide(spark)
    index = X.fit_label_index(train.filter("id < 3000"), ["city", "kind", "code"])
    table = {(r["column"], r["value"]): r["index"] for r in index.labels.collect()}
    got = {r["id"]: r for r in X.apply_label_index(train, index, ["city", "kind", "code"], policy).collect()}
    for r in train.collect():
        want = [table.get((c, r[c])) for c in ("city", "kind", "code")]
        if policy == "skip":
            assert (r["id"] in got) == (None not in want)
        else:
            want = [float(index.arity[c]) if w is None else w for w, c in zip(want, ("city", "kind", "code"), strict=True)]
        if r["id"] in got:
            assert [got[r["id"]][c + "_index"] for c in ("city", "kind", "code")] == want


def test_lookup_moves_rows_for_large_columns_alone(spark, monkeypatch):
    df = wide(spark)
    index = X.fit_label_index(df, ["city", "kind", "code"])
    assert "hashpartitioning(_k_" not in plan_of(X.apply_label_index(df, index, ["city", "kind", "code"]))
    monkeypatch.setattr(X, "BROADCAST_LABELS", 100)   # city alone is above it
    plan = re.split(r"== Physical Plan ==", plan_of(X.apply_label_index(df, index, ["city", "kind", "code"])))[-1]
    assert len(re.findall(r"hashpartitioning\(_k_(\w+)", plan)) <= 2 and set(re.findall(r"hashpartitioning\(_k_(\w+?)#", plan)) == {"city"}


def test_a_value_on_half_the_rows_is_spread(spark, monkeypatch):
    monkeypatch.setattr(X, "BROADCAST_LABELS", 100)
    df = wide(spark, 40_000)
    index = X.fit_label_index(df, ["city"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = X.look_up(df, index, "city", "i")
        sizes = sorted(r["n"] for r in met.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) == 8 and sizes[-1] < 2 * sizes[len(sizes) // 2]
    assert met.filter("i is null").count() == 0 and met.columns == [*df.columns, "i"]


# ---------------------------------------------------------------- A7/P9: distinct counts

ODD = T.StructType([T.StructField("d", T.DoubleType()), T.StructField("s", T.StringType()), T.StructField("t", T.TimestampType()), T.StructField("b", T.BinaryType()), T.StructField("n", T.IntegerType())])


def odd_rows(spark):
    from datetime import datetime
    rows = [(0.0, "a", datetime(2024, 1, 1), b"\x00", None), (-0.0, "A", datetime(2024, 1, 1), b"\x00\x00", None), (float("nan"), None, None, None, None), (float("nan"), "", datetime(2024, 1, 1, 0, 0, 0, 1), b"", None), (None, " ", None, b"\xff", None)]
    return spark.createDataFrame(rows, ODD).repartition(3)


def test_distinct_counts_without_expand(spark):
    df = odd_rows(spark)
    found = Q.distinct_counts(df)
    assert "Expand" not in plan_of(found)
    for c in df.columns:
        want = df.select(c).distinct().count()
        assert found.first()[c] == want, c
        assert Q.distinct_counts(df, [c], null_as_value=False).first()[c] == df.select(c).dropna(how="all").distinct().count() + (1 if c == "d" else 0), c
    assert Q.distinct_counts(df.limit(0)).first().asDict() == dict.fromkeys(df.columns, 0)
    profile = {r["column"]: r["distinct"] for r in column_profile(df).collect()}
    assert profile == found.first().asDict()


def test_sketches_merge(spark):
    df = spark.range(30_000).select((F.col("id") % 9000).alias("a"), F.col("id").cast("string").alias("b"))
    parts = [Q.distinct_sketches(df.filter(F.col("id") % 3 == i)) for i in range(3)]
    one = {r["column"]: r["n"] for r in Q.sketch_counts(Q.merge_sketches(parts[0].unionByName(parts[1]).unionByName(parts[2]))).collect()}
    assert one == {r["column"]: r["n"] for r in Q.sketch_counts(Q.distinct_sketches(df)).collect()}
    assert one["a"] == pytest.approx(9000, rel=4 * Q.SKETCH_ERROR) and one["b"] == pytest.approx(30_000, rel=4 * Q.SKETCH_ERROR)
    assert Q.distinct_counts(df, approx=True).first()["a"] == one["a"]
    assert "Expand" not in plan_of(Q.distinct_counts(df, approx=True))


# ---------------------------------------------------------------- A8/I1: medians

def test_many_quantiles_from_one_scan(spark):
    rng = random.Random(3)
    cols = {"a": [rng.randrange(50) / 2 for _ in range(501)], "b": [rng.random() if i % 3 else None for i in range(501)], "c": [None] * 501, "d": [float("nan"), *[7.0] * 500]}
    df = spark.createDataFrame(list(zip(*cols.values(), strict=True)), ", ".join(f"{c} double" for c in cols)).repartition(5)
    qs = (0.0, 0.25, 0.5, 0.999, 1.0)
    got = C.exact_quantiles(df, list(cols), qs)
    for c, values in cols.items():
        own = sorted(v for v in values if v is not None and v == v)
        want = [own[max(1, -int(-q * len(own) // 1)) - 1] if own else None for q in qs]
        assert got[c] == want, c
    assert C.exact_quantiles(df, []) == {} and C.exact_quantiles(df.limit(0), ["a"]) == {"a": [None] * 1}
    assert plan_of(C.value_counts(df, list(cols))).split("== Physical Plan ==")[-1].count("Scan") == 1
    assert C.fit_impute(df, median=list(cols), relative_error=0).median == {c: C.exact_quantile(df, c) for c in cols}


def test_a_median_outside_its_error_is_not_certified(spark):
    df = spark.range(1, 10_001).select(F.col("id").cast("double").alias("v"))
    good = C.fit_impute(df, median=["v"], relative_error=0.001).median
    row = C.sketch_certificate(df, good).first()
    assert (row["rows"], row["low"], row["high"], row["certified"]) == (10_000, 4990.0, 5010.0, True)
    assert not C.sketch_certificate(df, {"v": 5011.0}).first()["certified"]


# ---------------------------------------------------------------- L5: samples to a size

@pytest.mark.parametrize("k", [0, 1, 37, 999, 1000, 5000])
def test_bottom_k_has_k_rows_under_any_partitioning(spark, k):
    df = spark.range(1000).select("id", (F.col("id") % 10).alias("x"))
    runs = [sorted(r["id"] for r in L.bottom_k(df.repartition(n), "id", k, edge=3, step=1).collect()) for n in (1, 7)]
    import hashlib
    order = sorted(range(1000), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    assert runs[0] == runs[1] == sorted(order[:k])
    assert L.sample_to_size(df, k, key="id").columns == df.columns and L.sample_to_size(df, k, key="id").count() == min(k, 1000)


def test_bottom_k_of_repeated_and_null_keys(spark):
    df = spark.createDataFrame([(None if i % 3 else "same", i) for i in range(300)], "k string, i int")
    assert L.bottom_k(df, "k", 150, edge=10).count() == 150
    assert L.bottom_k(df, ["k", "i"], 17).count() == 17
    assert L.bottom_k(df.limit(0), "k", 5).count() == 0


def test_sample_to_size_without_a_key_is_near_its_size(spark):
    df = spark.range(20_000)
    assert abs(L.sample_to_size(df, 2000).count() - 2000) < 250 and L.sample_to_size(df, 30_000).count() == 20_000


# ---------------------------------------------------------------- X1-X3: given weights

def test_stream_scores_new_files_once(spark, tmp_path):
    df = wide(spark, 600).withColumn("x", F.col("id") / 10)
    fm = X.FeatureBuilder(low_card=["kind"], high_card=["code"], numeric=["x"]).fit(df)
    model = S.given_linear_model({"x": 0.5, "code_index": -0.25}, 1.5)
    model.write().overwrite().save(str(tmp_path / "m"))
    from pyspark.ml import PipelineModel
    model = PipelineModel.load(str(tmp_path / "m"))
    src, sink, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))

    def go():
        score_stream(spark, src, df.schema, lambda s: s, fm, model, ["id"], sink, mark, max_files_per_trigger=1)
        return sorted(map(tuple, spark.read.parquet(sink).collect()), key=str)

    df.filter("id < 300").repartition(2).write.parquet(src)
    first = go()
    assert go() == first
    df.filter("id >= 300").coalesce(1).write.mode("append").parquet(src)
    assert go() == sorted((tuple(r) for r in S.flagged_predictions(df, fm, model, ["id"]).collect()), key=str)
    assert any(r[3] for r in first) and all((r[1] is None) == r[3] for r in first)


# ---------------------------------------------------------------- R4: runs are the commit record

class Broken:
    def write(self):
        raise OSError("disk full")


def test_only_finished_runs_are_loaded(spark, tmp_path):
    from pyspark.ml import PipelineModel
    tracker = Tracker(spark, str(tmp_path / "t"))
    assert tracker.runs().count() == 0
    model = S.given_linear_model({"x": 1.0})
    done, failed, half = (tracker.start_run("e", n) for n in ("done", "failed", "half"))
    for run in (done, failed, half):
        tracker.log_params(run, {"p": 1})
        tracker.log_metrics(run, {"m": 1.0})
        tracker.log_model(run, model)
    tracker.end_run(done)
    tracker.end_run(failed, FAILED)
    with pytest.raises(OSError):
        tracker.log_model(half, Broken(), "second")
    # a run that broke off after its metrics were written, before its row was
    tracker.log_metric_frame(spark.createDataFrame([(half, "m", 1.0, 0, 0)], "run_id string, key string, value double, ts long, step long"))
    assert isinstance(tracker.load_model(done, PipelineModel), PipelineModel)
    for run in (failed, half, "unknown"):
        with pytest.raises(LookupError):
            tracker.load_model(run, PipelineModel)
    assert {r["run_id"] for r in tracker.metrics().collect()} == {done, failed} == {r["run_id"] for r in tracker.params().collect()}


# ---------------------------------------------------------------- S1: quarantine

def test_bad_lines_are_quarantined(spark, tmp_path):
    (tmp_path / "a.txt").write_text("a|b|c\n1|2|3\n4|5\n6|7|8|9\n||\nx|y|z\n")
    got = D.read_checked(spark, str(tmp_path), ["a", "b", "c"])
    assert sorted((r["kind"], r["line"], r["a"]) for r in D.rejects(got).collect()) == [("long", "6|7|8|9", "6"), ("short", "4|5", "4")]
    assert sorted(r["kind"] for r in D.rejects(got).select("kind", "b").collect()) == ["long", "short"]   # whichever columns are read
    assert len(got.filter(F.col(D.BAD_LINE).isNull()).select("b").collect()) == 3
    good = got.filter(F.col(D.BAD_LINE).isNull()).select("a", "b", "c")
    assert sorted(map(str, (tuple(r) for r in good.collect()))) == sorted(map(str, [("1", "2", "3"), (None, None, None), ("x", "y", "z")]))


def test_a_misnamed_header_is_an_error(spark, tmp_path):
    (tmp_path / "a.txt").write_text("a|b\n1|2\n")
    (tmp_path / "b.txt").write_text("b|a\n2|1\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        D.read_checked(spark, str(tmp_path), ["a", "b"]).collect()


def test_new_queries_have_twins():
    from credere.plans import catalog
    twins = catalog.oracle_sql()
    assert {"median_sketch", "distinct_sketch", "sample_rows", "scan_rejects", "fit_nb", "bulk_score_given", "score_rows_given", "stream_score_given"} <= set(twins) <= set(QUERIES)
