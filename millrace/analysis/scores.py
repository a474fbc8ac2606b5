"""Scores of predictions: classes, several labels at once, and rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_groups
from ..operators.ordering import running_total


def confusion_matrix(df: DataFrame, labels: Sequence, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """Counts for every pair of the given labels, in their order, empty cells as 0."""
    spark = df.sparkSession
    kind = dict(df.dtypes)[label]
    grid = spark.createDataFrame([(a, b) for a in labels for b in labels], f"{label} {kind}, {predicted} {kind}")
    counted = df.groupBy(label, predicted).agg(F.count("*").alias("n"))
    return grid.join(counted, [label, predicted], "left").na.fill(0, ["n"])


def class_report(df: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """Precision, recall, F1 and support of each class that is true or predicted somewhere; 0/0 is 0."""
    counted = df.groupBy(label, predicted).agg(F.count("*").alias("n"))
    hit = (F.col(label) == F.col(predicted)).cast("bigint") * F.col("n")
    true = counted.select(F.col(label).alias("class"), "n", F.lit(0).cast("bigint").alias("m"), hit.alias("tp"))
    claimed = counted.select(
        F.col(predicted).alias("class"), F.lit(0).cast("bigint").alias("n"), F.col("n").alias("m"), F.lit(0).cast("bigint").alias("tp")
    )
    sums = true.unionByName(claimed).groupBy("class").agg(
        F.sum("n").alias("support"), F.sum("m").alias("claimed"), F.sum("tp").alias("tp")
    )
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide(F.col("tp"), F.col("claimed")), zero)
    recall = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), zero)
    f1 = F.coalesce(F.try_divide(2 * F.col("tp"), F.col("support") + F.col("claimed")), zero)
    return sums.select("class", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support", "tp")


def classifier_metrics(df: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """Accuracy and unweighted class means of precision, recall and F1."""
    return class_report(df, label, predicted).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"),
        F.avg("f1").alias("f1"),
    )


def multilabel_metrics(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Subset accuracy, and F1 and recall per label; columns ``<label>`` and ``<label>_predicted`` hold 0/1."""
    exact = F.lit(True)
    sums = []
    for name in labels:
        true, claimed = F.col(name), F.col(f"{name}_predicted")
        exact &= true == claimed
        sums += [
            F.sum(true * claimed).alias(f"tp_{name}"),
            F.sum(true).alias(f"true_{name}"),
            F.sum(claimed).alias(f"claimed_{name}"),
        ]
    wide = df.agg(F.avg(exact.cast("double")).alias("accuracy"), *sums)
    zero = F.lit(0.0)
    rows = [
        F.struct(
            F.lit(n).alias("label"),
            F.coalesce(F.try_divide(2 * F.col(f"tp_{n}"), F.col(f"true_{n}") + F.col(f"claimed_{n}")), zero).alias("f1"),
            F.coalesce(F.try_divide(F.col(f"tp_{n}"), F.col(f"true_{n}")), zero).alias("recall"),
        )
        for n in labels
    ]
    return wide.select("accuracy", F.explode(F.array(*rows)).alias("_r")).select("_r.*", F.col("accuracy").alias("subset_accuracy"))


def _threshold_counts(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    """Positives and negatives at or above each distinct score; equal scores are one step."""
    steps = df.groupBy(*by, score).agg(F.sum(label).alias("_p"), F.sum(1 - F.col(label)).alias("_n"))
    return running_total(steps, [score], {"tp": F.col("_p"), "fp": F.col("_n")}, by, descending=True)


def average_precision(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    """Sum over thresholds of recall gained times precision; ``label`` is 0/1."""
    steps = _threshold_counts(df, label, score, by)
    totals = steps.groupBy(*by).agg(F.max("tp").alias("_positives"))
    gained = F.col("_p") / F.col("_positives") * F.col("tp") / (F.col("tp") + F.col("fp"))
    return join_groups(steps, totals, by).groupBy(*by).agg(F.sum(gained).alias("average_precision"))


def roc_points(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    """True and false positive rate at each threshold."""
    steps = _threshold_counts(df, label, score, by)
    totals = steps.groupBy(*by).agg(F.max("tp").alias("positives"), F.max("fp").alias("negatives"))
    return join_groups(steps, totals, by).select(
        *by, score, (F.col("tp") / F.col("positives")).alias("tpr"), (F.col("fp") / F.col("negatives")).alias("fpr"),
        "_p", "_n", "positives", "negatives", "tp",
    )


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    """Area under the curve by trapezoids: each step's width times its mean height."""
    area = F.col("_n") / F.col("negatives") * (F.col("tp") - F.col("_p") / 2) / F.col("positives")
    return roc_points(df, label, score, by).groupBy(*by).agg(F.sum(area).alias("auc"))
