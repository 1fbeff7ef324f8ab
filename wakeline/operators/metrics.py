"""Scores of predicted labels, and blending of probability tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wakeline.functions import scalars as S

PROBABILITIES = tuple(f"p_{c}" for c in S.CLASSES)


def confusion(predictions: DataFrame, by=()) -> DataFrame:
    """Row counts per (label, predicted)."""
    return predictions.groupBy(*by, "label", "predicted").agg(F.count(F.lit(1)).alias("cnt"))


def class_report(predictions: DataFrame, by=()) -> DataFrame:
    """Recall, precision and F1 per class; a class never seen nor predicted is not listed."""
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("cnt").alias("actual"), F.lit(0).cast("bigint").alias("guessed"),
                 F.when(F.col("label") == F.col("predicted"), F.col("cnt")).otherwise(0).alias("hit")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("bigint").alias("actual"),
                 F.col("cnt").alias("guessed"), F.lit(0).cast("bigint").alias("hit")))
    sums = (confusion(predictions, by).select(*by, F.inline(sides)).groupBy(*by, "class")
            .agg(F.sum("actual").alias("actual"), F.sum("guessed").alias("guessed"), F.sum("hit").alias("hit")))
    return (sums.withColumn("recall", S.safe_ratio("hit", "actual"))
            .withColumn("precision", S.safe_ratio("hit", "guessed"))
            .withColumn("f1", S.safe_ratio(2 * F.col("hit"), F.col("actual") + F.col("guessed"))))


def macro_f1(predictions: DataFrame, by=()) -> DataFrame:
    """Unweighted mean of the class F1 values."""
    return class_report(predictions, by).groupBy(*by).agg(F.avg("f1").alias("macro_f1"))


def fold_summary(predictions: DataFrame) -> DataFrame:
    """Mean and population deviation of the macro F1 over the folds."""
    return macro_f1(predictions, ("fold",)).agg(
        F.avg("macro_f1").alias("mean_f1"), F.stddev_pop("macro_f1").alias("std_f1"))


def with_prediction(scores: DataFrame, columns=PROBABILITIES, out: str = "predicted") -> DataFrame:
    return scores.withColumn(out, S.name_at(S.argmax_index(columns)))


def blend(ids: DataFrame, tables, weights) -> DataFrame:
    """Weighted sum of probability tables, joined to `ids` and aligned by class name."""
    out = ids.select("id")
    for i, table in enumerate(tables):
        out = out.join(table.select("id", *[F.col(p).alias(f"_{i}_{p}") for p in PROBABILITIES]), "id", "left")
    for p in PROBABILITIES:
        total = None
        for i, w in enumerate(weights):
            term = F.lit(float(w)) * F.col(f"_{i}_{p}")
            total = term if total is None else total + term
        out = out.withColumn(p, total)
    return with_prediction(out.select("id", *PROBABILITIES), out="label")


def mean_importance(importance: DataFrame) -> DataFrame:
    """Importance of each feature, averaged over the folds."""
    return importance.groupBy("feature").agg(F.avg("importance").alias("importance"))


def top_features(importance: DataFrame, k: int = 5) -> DataFrame:
    return mean_importance(importance).orderBy(F.desc("importance"), "feature").limit(k)
