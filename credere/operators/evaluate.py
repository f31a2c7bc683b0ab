"""Evaluation.

One confusion aggregation gives accuracy and the weighted precision, recall
and F1 of ``MulticlassClassificationEvaluator``; one aggregation by score
plus a distributed prefix sum gives the exact area under ROC (equal to
``BinaryClassificationEvaluator(numBins=0)``). The result is a DataFrame
(metric, value). The predictions are read once for each of the two aggregations.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import exclusive_prefix_sum

METRICS = ("accuracy", "weightedPrecision", "weightedRecall", "f1", "areaUnderROC")


def score_from_raw(df: DataFrame, raw_col: str = "rawPrediction", out: str = "score") -> DataFrame:
    """Positive-class score from an MLlib ``rawPrediction`` vector (slot 1)."""
    return df.withColumn(out, vector_to_array(F.col(raw_col))[1])


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, count)."""
    return (df.groupBy(F.col(label).cast("double").alias("label"),
                       F.col(prediction).cast("double").alias("prediction"))
            .agg(F.count(F.lit(1)).alias("count")))


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """E1-E4 from the confusion table (at most classes^2 rows)."""
    cm = confusion(df, label, prediction)
    by_label = cm.groupBy("label").agg(
        F.sum("count").alias("n_true"),
        F.sum(F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0)).alias("tp"))
    by_pred = cm.groupBy(F.col("prediction").alias("label")).agg(F.sum("count").alias("n_pred"))
    per = by_label.join(by_pred, "label", "left").fillna(0, subset=["n_pred"])
    total = F.sum("n_true")
    precision = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(0.0)
    recall = F.col("tp") / F.col("n_true")
    f1 = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    per = per.select("n_true", "tp", precision.alias("p"), recall.alias("r"), f1.alias("f"))
    return per.agg(
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(F.col("n_true") * F.col("p")) / total).alias("weightedPrecision"),
        (F.sum(F.col("n_true") * F.col("r")) / total).alias("weightedRecall"),
        (F.sum(F.col("n_true") * F.col("f")) / total).alias("f1"))


def auc_exact(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """E5: exact area under ROC by the mid-rank formula (ties count one half).

    Rows are first aggregated by distinct score, then each score group gets
    the count of rows strictly below it from a distributed prefix sum (no single
    task ever sees an unbounded number of scores). Rows of one class alone give
    1 (positives) or 0 (negatives), as the evaluator's curve does; no rows NULL.
    """
    groups = (df.groupBy(F.col(score).cast("double").alias("s"))
              .agg(F.sum(F.col(label).cast("long")).alias("pos"), F.count(F.lit(1)).alias("n")))
    ranked = exclusive_prefix_sum(groups, [F.col("s")], "n", "below")
    midrank = F.col("below") + (F.col("n") + 1) / 2.0
    agg = ranked.agg(F.sum(F.col("pos") * midrank).alias("rank_sum"),
                     F.sum("pos").cast("double").alias("P"),
                     (F.sum("n") - F.sum("pos")).cast("double").alias("N"))
    area = F.try_divide(F.col("rank_sum") - F.col("P") * (F.col("P") + 1) / 2, F.col("P") * F.col("N"))
    one_class = F.when(F.col("P") > 0, F.lit(1.0)).when(F.col("N") > 0, F.lit(0.0))
    return agg.select(F.coalesce(area, one_class).alias("areaUnderROC"))


def metric_bundle(df: DataFrame, label: str = "label", prediction: str = "prediction",
                  score: str = "score", digits: int | None = None) -> DataFrame:
    """(metric, value) for accuracy, weighted precision/recall/F1 and AUC.

    The two one-row aggregates are turned into rows and unioned - no join.
    """
    cls = classification_metrics(df, label, prediction)
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS[:4]])
    auc = auc_exact(df, label, score).select(F.lit("areaUnderROC").alias("metric"),
                                             F.col("areaUnderROC").alias("value"))
    out = cls.select(F.inline(rows)).unionByName(auc)
    if digits is not None:
        out = out.withColumn("value", F.round("value", digits))
    return out


def metrics_dict(df: DataFrame, **kw) -> dict[str, float]:
    return {r["metric"]: r["value"] for r in metric_bundle(df, **kw).collect()}
