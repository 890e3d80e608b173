"""Classification metrics as distributed aggregates.

The confusion matrix is a group-by on (label, prediction) with partial
aggregation; accuracy and the weighted precision / recall / F1 are computed
from it in the plan (one scan instead of one evaluator job per metric). AUC
uses Spark's exact curve (``numBins=0``): a distributed sort of the scores
with per-partition cumulative counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientlens.ml.models import auc_roc


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     name: str = "count") -> DataFrame:
    return (df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias(name))
            .orderBy(label, prediction))


def per_class(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class: rows with that label (``actual``), rows predicted as it
    (``predicted``) and true positives (``tp``)."""
    cm = df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("bigint")
    both = F.array(
        F.struct(F.col(label).cast("double").alias("cls"), F.col("n").alias("actual"),
                 zero.alias("predicted"),
                 F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(zero).alias("tp")),
        F.struct(F.col(prediction).cast("double").alias("cls"), zero.alias("actual"),
                 F.col("n").alias("predicted"), zero.alias("tp")))
    return (cm.select(F.inline(both)).groupBy("cls")
            .agg(F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"),
                 F.sum("tp").alias("tp")))


def class_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                  digits: int | None = 6) -> DataFrame:
    """Accuracy and label-frequency-weighted precision, recall and F1 (the
    multiclass evaluator's definitions: a class never predicted has
    precision 0, F1 is 0 when precision and recall are both 0)."""
    pc = per_class(df, label, prediction)
    precision = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    recall = F.when(F.col("actual") > 0, F.col("tp") / F.col("actual")).otherwise(0.0)
    f1 = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    n = F.sum("actual")

    def out(c, name):
        return (c if digits is None else F.round(c, digits)).alias(name)

    return pc.agg(
        out(F.sum("tp") / n, "accuracy"),
        out(F.sum(F.col("actual") * precision) / n, "weighted_precision"),
        out(F.sum(F.col("actual") * recall) / n, "weighted_recall"),
        out(F.sum(F.col("actual") * f1) / n, "weighted_f1"))


def binary_metrics(df: DataFrame, score: str = "rawPrediction", digits: int | None = 6) -> DataFrame:
    """One row: exact AUC-ROC, with the positive and negative counts."""
    auc = auc_roc(df, score)
    counts = df.agg(F.count_if(F.col("label") == 1.0).alias("positives"),
                    F.count_if(F.col("label") == 0.0).alias("negatives"))
    return counts.select(F.lit(round(auc, digits) if digits is not None else auc)
                         .cast("double").alias("auc_roc"), "positives", "negatives")
