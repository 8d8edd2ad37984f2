"""Multiclass metrics on (label, prediction) pairs, as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def accuracy(pairs: DataFrame, label_col: str = "label",
             prediction_col: str = "prediction") -> DataFrame:
    """One row: ``accuracy`` (share of exact matches) and ``n`` pairs.

    A prediction of a class that never occurs as a truth still counts as
    wrong.
    """
    hit = F.when(F.col(label_col) == F.col(prediction_col), F.lit(1.0)).otherwise(F.lit(0.0))
    return pairs.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def confusion_counts(pairs: DataFrame, label_col: str = "label",
                     prediction_col: str = "prediction") -> DataFrame:
    """Sparse matrix: ``(label, prediction, n)`` for every pair that occurs."""
    return (pairs.groupBy(F.col(label_col).alias("label"), F.col(prediction_col).alias("prediction"))
            .agg(F.count(F.lit(1)).alias("n")))


def accuracy_of_counts(counts: DataFrame) -> DataFrame:
    """``accuracy`` and ``n`` from a sparse matrix."""
    hit = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0)))
    n = F.coalesce(F.sum("n"), F.lit(0))
    return counts.agg((hit / F.sum("n")).cast("double").alias("accuracy"), n.cast("bigint").alias("n"))


def matrix_of_counts(counts: DataFrame) -> DataFrame:
    """Dense matrix ``(label, prediction, n)`` from a sparse one.

    Rows and columns are the classes seen as truth, zero cells included; a
    predicted class that never occurs as truth has no column, and a pair
    without a truth has no row (both still lower the accuracy). The output has a
    cell for every two classes: that is what a dense matrix is. For very many
    classes use ``confusion_counts``, whose size is that of the pairs that
    occur.
    """
    seen = counts.where(F.col("label").isNotNull())
    cells = F.collect_list(F.when(F.col("prediction").isNotNull(), F.struct("prediction", "n")))
    rows = seen.groupBy("label").agg(F.map_from_entries(cells).alias("cells"))
    # The list of classes is a scalar of the plan; every task makes the cells of its own labels.
    classes = seen.select("label").distinct().agg(F.collect_list("label").alias("classes"))
    named = rows.withColumn("prediction", F.explode(classes.scalar()))
    return named.select("label", "prediction", F.coalesce(F.try_element_at("cells", F.col("prediction")), F.lit(0).cast("bigint")).alias("n"))


def confusion_matrix(pairs: DataFrame, label_col: str = "label",
                     prediction_col: str = "prediction") -> DataFrame:
    """Dense matrix in long form: see ``matrix_of_counts``."""
    return matrix_of_counts(confusion_counts(pairs, label_col, prediction_col))
