"""Classification metrics: Spark ML evaluators and the same weighted metrics
as one distributed aggregate."""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_METRICS = {"f1": "f1", "precision": "weightedPrecision", "recall": "weightedRecall"}


def evaluate(predictions: DataFrame, label: str, prediction: str = "prediction") -> dict[str, float]:
    """Weighted F1, precision and recall (one evaluator per metric, no mutation)."""
    out = {}
    for key, name in _METRICS.items():
        ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction, metricName=name)
        out[key] = float(ev.evaluate(predictions))
    return out


def f1_evaluator(label: str, prediction: str = "prediction") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction, metricName="f1")


def weighted_metrics(predictions: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row ``(f1, weighted_precision, weighted_recall, accuracy, rows)``.

    One scan: confusion counts per (label, prediction) pair (partial + final
    aggregate), each pair then contributes to its label's class (support, true
    positives) and to its prediction's class (predicted count); per-class
    precision, recall and F1 are weighted by the class share of the labels, as
    in ``MulticlassMetrics``. The class set is bounded by the label's
    cardinality, so everything after the first aggregate is tiny.
    """
    pairs = predictions.groupBy(F.col(label).cast("double").alias("y"),
                                F.col(prediction).cast("double").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("y").alias("k"), F.col("n").alias("n_y"),
                 F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(zero).alias("tp"), zero.alias("n_p")),
        F.struct(F.col("p").alias("k"), zero.alias("n_y"), zero.alias("tp"), F.col("n").alias("n_p")),
    )
    per = (pairs.select(F.inline(sides))
           .groupBy("k").agg(F.sum("n_y").alias("n_y"), F.sum("tp").alias("tp"), F.sum("n_p").alias("n_p")))
    per = per.withColumns({
        "prec": F.when(F.col("n_p") > 0, F.col("tp") / F.col("n_p")).otherwise(0.0),
        "rec": F.when(F.col("n_y") > 0, F.col("tp") / F.col("n_y")).otherwise(0.0),
    })
    per = per.withColumn(
        "f1c", F.when(F.col("prec") + F.col("rec") > 0,
                      2 * F.col("prec") * F.col("rec") / (F.col("prec") + F.col("rec"))).otherwise(0.0))
    tot = F.sum("n_y")
    return per.agg(
        (F.sum(F.col("f1c") * F.col("n_y")) / tot).alias("f1"),
        (F.sum(F.col("prec") * F.col("n_y")) / tot).alias("weighted_precision"),
        (F.sum(F.col("rec") * F.col("n_y")) / tot).alias("weighted_recall"),
        (F.sum("tp") / tot).alias("accuracy"),
        tot.cast("bigint").alias("rows"),
    )
