"""Run tracking as plain Parquet tables.

Instead of a tracking server, a run's record is table data under one root
(a shared folder): ``runs`` (partitioned by experiment), ``run_params``,
``run_metrics`` and model artifacts under ``artifacts/<run_id>/<name>``.
Each run is buffered on the driver (a handful of values) and appended once
when it ends.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUNS = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("experiment", T.StringType()),
    T.StructField("name", T.StringType()), T.StructField("start_ts", T.LongType()),
    T.StructField("end_ts", T.LongType()), T.StructField("status", T.IntegerType()),
    T.StructField("artifact_path", T.StringType())])
PARAMS = T.StructType([T.StructField("run_id", T.StringType()), T.StructField("key", T.StringType()),
                       T.StructField("value", T.StringType())])
METRICS = T.StructType([T.StructField("run_id", T.StringType()), T.StructField("key", T.StringType()),
                        T.StructField("value", T.DoubleType()), T.StructField("ts", T.LongType()),
                        T.StructField("step", T.LongType())])

FINISHED, FAILED = 3, 4


def _now_ms() -> int:
    return int(time.time() * 1000)


class Tracker:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._open: dict[str, dict] = {}

    # R1
    def start_run(self, experiment: str, name: str) -> str:
        run_id = uuid.uuid4().hex
        self._open[run_id] = {"experiment": experiment, "name": name, "start": _now_ms(),
                              "params": [], "metrics": []}
        return run_id

    # R2
    def log_params(self, run_id: str, params: dict) -> None:
        self._open[run_id]["params"] += [(run_id, str(k), str(v)) for k, v in params.items()]

    # R3
    def log_metrics(self, run_id: str, metrics: dict, step: int = 0) -> None:
        ts = _now_ms()
        self._open[run_id]["metrics"] += [(run_id, str(k), float(v), ts, int(step)) for k, v in metrics.items()]

    # R4
    def artifact_path(self, run_id: str, name: str) -> str:
        return f"{self.root}/artifacts/{run_id}/{name}"

    def log_model(self, run_id: str, model, name: str = "model") -> str:
        path = self.artifact_path(run_id, name)
        if hasattr(model, "write"):
            model.write().overwrite().save(path)
        else:  # a FeatureModel: label tables and stages
            model.save(path)
        return path

    def load_model(self, run_id: str, model_cls, name: str = "model"):
        """A model of a finished run. ``runs`` is the commit record: its row is written last, so a run that failed or
        is half written is not there, or not as finished, and its artifacts are never loaded."""
        done = self.runs().filter((F.col("run_id") == run_id) & (F.col("status") == FINISHED))
        row = done.select("artifact_path").first()
        if row is None:
            raise LookupError(f"no finished run {run_id}")
        path = f"{row['artifact_path']}/{name}" if row["artifact_path"] else self.artifact_path(run_id, name)
        return model_cls.load(path) if hasattr(model_cls, "read") else model_cls.load(self.spark, path)

    def end_run(self, run_id: str, status: int = FINISHED) -> None:
        r = self._open.pop(run_id)
        s = self.spark
        if r["params"]:
            s.createDataFrame(r["params"], PARAMS).write.mode("append").parquet(f"{self.root}/run_params")
        if r["metrics"]:
            s.createDataFrame(r["metrics"], METRICS).write.mode("append").parquet(f"{self.root}/run_metrics")
        row = [(run_id, r["experiment"], r["name"], r["start"], _now_ms(), status,
                f"{self.root}/artifacts/{run_id}")]
        s.createDataFrame(row, RUNS).write.mode("append").partitionBy("experiment").parquet(f"{self.root}/runs")

    def log_metric_frame(self, frame: DataFrame) -> None:
        """R3 in bulk: append (run_id, key, value, ts, step) rows computed by Spark."""
        frame.select([F.col(f.name).cast(f.dataType) for f in METRICS.fields]) \
            .write.mode("append").parquet(f"{self.root}/run_metrics")

    def log_run_frame(self, frame: DataFrame) -> None:
        frame.select([F.col(f.name).cast(f.dataType) for f in RUNS.fields]) \
            .write.mode("append").partitionBy("experiment").parquet(f"{self.root}/runs")

    def runs(self) -> DataFrame:
        """The runs that ended, finished or failed. A root without any has none."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/runs")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], RUNS)
        return self.spark.read.schema(RUNS).parquet(f"{self.root}/runs")

    def _of_runs(self, name: str) -> DataFrame:
        """Rows of runs that ended: those that a run wrote before it broke off do not show."""
        return self.spark.read.parquet(f"{self.root}/{name}").join(self.runs().select("run_id"), "run_id", "left_semi")

    def metrics(self) -> DataFrame:
        return self._of_runs("run_metrics")

    def params(self) -> DataFrame:
        return self._of_runs("run_params")


def leaderboard(runs: DataFrame, metrics: DataFrame, metric: str = "accuracy", top: int = 1) -> DataFrame:
    """Best ``top`` runs per experiment by ``metric`` (ties by run name).

    The metric table is filtered to one key and joined to runs on run_id; the
    ranking window is partitioned by experiment.
    """
    m = metrics.filter(F.col("key") == F.lit(metric)).groupBy("run_id").agg(F.max("value").alias(metric))
    joined = runs.select("run_id", "experiment", "name").join(m, "run_id")
    w = Window.partitionBy("experiment").orderBy(F.desc(metric), F.asc("name"))
    return (joined.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
            .select("experiment", "name", metric, "rank"))
