"""Stream scoring gives the same rows and scores as batch scoring."""

from credere.operators import features as T
from credere.operators import train as M
from credere.streaming.score_stream import score_stream


def test_stream_equals_batch(spark, tmp_path):
    rows = [(f"c{i % 3}", float(i % 17), f"h{i % 5}", i % 2, i) for i in range(300)]
    df = spark.createDataFrame(rows, "c string, v double, h string, label int, id long")
    fm = T.FeatureBuilder(low_card=["c"], high_card=["h"], numeric=["v"]).fit(df)
    lr = M.estimator("Logistic Regression").fit(fm.transform(df))
    src = str(tmp_path / "in")
    df.repartition(4).write.parquet(src)
    score_stream(spark, src, df.schema, lambda s: s, fm, lr, ["id", "label"],
                 str(tmp_path / "out"), str(tmp_path / "ckpt"), max_files_per_trigger=1)
    streamed = {(r.id, r.prediction, round(r.score, 9)) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert not any(r.rejected for r in spark.read.parquet(str(tmp_path / "out")).collect())
    batch = {(r.id, r.prediction, round(r.score, 9)) for r in M.predict(lr, fm.transform(df), ["id", "label"]).collect()}
    assert streamed == batch and len(batch) == 300
    # a restart on the same checkpoint finds nothing new and writes nothing twice
    score_stream(spark, src, df.schema, lambda s: s, fm, lr, ["id", "label"],
                 str(tmp_path / "out"), str(tmp_path / "ckpt"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 300


def test_stream_of_one_file_without_an_outcome(spark, tmp_path):
    df = spark.createDataFrame([(f"c{i % 3}", float(i % 17), f"h{i % 5}", i % 2, i) for i in range(90)], "c string, v double, h string, label int, id long")
    fm = T.FeatureBuilder(low_card=["c"], high_card=["h"], numeric=["v"]).fit(df)
    lr = M.estimator("Logistic Regression").fit(fm.transform(df))
    more = df.drop("label").unionByName(spark.createDataFrame([("new", 1.0, "h1", 900)], "c string, v double, h string, id long"))
    more.coalesce(1).write.parquet(str(tmp_path / "in"))
    one = next((tmp_path / "in").glob("part-*.parquet"))
    score_stream(spark, str(one), more.schema, lambda s: s, fm, lr, ["id"], str(tmp_path / "out"), str(tmp_path / "ckpt"))
    got = {r.id: r.rejected for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert len(got) == 91 and [i for i, r in got.items() if r] == [900]
