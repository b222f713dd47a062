"""Classification metrics from (label, prediction) columns, each in one pass over the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.sources.generators import local_rows


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(n, n_correct, accuracy)."""
    counted = df.agg(
        F.count("*").alias("n"), F.count_if(F.col(label) == F.col(prediction)).alias("n_correct"))
    return counted.withColumn("accuracy", F.try_divide("n_correct", "n"))


def confusion_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(actual, predicted, n) for the pairs that occur."""
    return df.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("predicted")).agg(
        F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, label: str, prediction: str, labels: Sequence[int]) -> DataFrame:
    """One row per actual label, one column ``predicted_<label>`` per label, zeros filled in.

    Listing the labels keeps the pivot to one job; a listed label without rows has a row of zeros.
    """
    rows = local_rows(df.sparkSession, [[value] for value in labels], "actual INT")
    cells = df.groupBy(F.col(label).cast("int").alias("actual")).agg(*[
        F.count_if(F.col(prediction) == F.lit(value)).alias(f"predicted_{value}")
        for value in labels
    ])
    names = [f"predicted_{value}" for value in labels]
    return rows.join(cells, "actual", "left").na.fill(0, names)


def precision_recall(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(label, n_actual, n_predicted, precision, recall) for every label on either side.

    A label that is never predicted has precision 0; one that never occurs has no recall.
    """
    cells = confusion_counts(df, label, prediction)
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("bigint")
    sides = F.explode(F.array(
        F.struct(F.col("actual").cast("double").alias("label"), F.col("n").alias("n_actual"),
                 zero.alias("n_predicted"), hit.cast("bigint").alias("n_hit")),
        F.struct(F.col("predicted").cast("double").alias("label"), zero.alias("n_actual"),
                 F.col("n").alias("n_predicted"), zero.alias("n_hit")),
    ))
    sums = cells.select(sides.alias("side")).groupBy(F.col("side.label").alias("label")).agg(
        F.sum("side.n_actual").alias("n_actual"),
        F.sum("side.n_predicted").alias("n_predicted"),
        F.sum("side.n_hit").alias("n_hit"),
    )
    return sums.select(
        "label", "n_actual", "n_predicted",
        F.coalesce(F.try_divide("n_hit", "n_predicted"), F.lit(0.0)).alias("precision"),
        F.try_divide("n_hit", "n_actual").alias("recall"),
    )


def misclassified(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.filter(F.col(label) != F.col(prediction))


def misclassified_range(df: DataFrame, label: str, prediction: str, probability: str) -> DataFrame:
    """(n, highest, lowest) probability among wrong predictions."""
    return misclassified(df, label, prediction).agg(
        F.count("*").alias("n"),
        F.max(probability).alias("highest"),
        F.min(probability).alias("lowest"),
    )
