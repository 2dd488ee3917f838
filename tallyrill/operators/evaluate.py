"""Metrics of scored tables (label, prediction, probability), as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrill.operators.ordered import with_running


def threshold(p: str | Column, cut: float = 0.5) -> Column:
    """1 above the cut, 0 at it or below."""
    v = F.col(p) if isinstance(p, str) else p
    return F.when(v > cut, 1).otherwise(0)


def accuracy(label: str = "label", prediction: str = "prediction") -> Column:
    """Per cent of rows whose prediction equals the label."""
    return F.avg(F.when(F.col(label) == F.col(prediction), 1.0).otherwise(0.0)) * 100


def log_loss(label: str = "label", p: str = "p", eps: float = 1e-15) -> Column:
    clipped = F.greatest(F.least(F.col(p), F.lit(1 - eps)), F.lit(eps))
    return F.avg(F.when(F.col(label) == 1, -F.ln(clipped)).otherwise(-F.ln(1 - clipped)))


def confusion(df: DataFrame, labels: Sequence, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Counts per (label, prediction), with zero for pairs of ``labels`` that do not occur.

    Labels and predictions that aren't listed have rows of their own, nulls too.
    """
    spark = df.sparkSession
    kinds = df.select(label, prediction).schema
    cells = spark.createDataFrame([(a, b, 0) for a in labels for b in labels], f"`{label}` {kinds[label].dataType.simpleString()}, `{prediction}` {kinds[prediction].dataType.simpleString()}, n bigint")
    found = df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))
    return found.unionByName(cells).groupBy(label, prediction).agg(F.sum("n").alias("n"))


def weighted_f1(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """F1 per class weighted by class size, from one count per (label, prediction)."""
    cells = df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(0)
    per_label = cells.groupBy(F.col(label).cast("double").alias("c")).agg(F.sum(hit).alias("tp"), F.sum("n").alias("actual"))
    per_pred = cells.groupBy(F.col(prediction).cast("double").alias("c")).agg(F.sum("n").alias("called"))
    f1 = 2 * F.col("tp") / (F.col("actual") + F.coalesce("called", F.lit(0)))
    return per_label.join(per_pred, "c", "left").agg((F.sum(f1 * F.col("actual")) / F.sum("actual")).alias("f1"))


def area_under_roc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area: the share of (positive, negative) pairs in the right order, ties a half.

    Rows are first summed per score; ranks come from range slices over the scores.
    """
    per = df.groupBy(F.col(score).cast("double").alias("__s")).agg(
        F.count_if(F.col(label) == 1).alias("__pos"), F.count_if(F.col(label) == 0).alias("__neg")
    )
    ranked = with_running(per, [], ["__s"], F.col("__neg"), "__upto", "__all_neg")
    won = F.col("__pos") * (F.col("__upto") - F.col("__neg") / 2)
    return ranked.agg(F.try_divide(F.sum(won), F.sum("__pos") * F.max("__all_neg")).alias("auc"))


def compare_splits(df: DataFrame, split: str = "split", label: str = "label", prediction: str = "prediction", p: str = "p") -> DataFrame:
    """Accuracy and log loss of each split in one grouped pass."""
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("n"), accuracy(label, prediction).alias("accuracy"), log_loss(label, p).alias("log_loss")
    )
