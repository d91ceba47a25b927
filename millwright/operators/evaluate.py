"""Quality of predictions against labels, as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of the compared metrics.
METRICS = ("accuracy", "precision", "recall", "f1_score")


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(label, prediction).agg(F.count("*").alias("rows"))


def _count(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def _share(part: Column, whole: Column) -> Column:
    """A ratio that is 0 when there is nothing to divide by."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.try_divide(part.cast("double"), whole))


def _f1(precision: Column, recall: Column) -> Column:
    return _share(F.lit(2.0) * precision * recall, precision + recall)


def binary_metrics(df: DataFrame, keys: Sequence[str], label: str, prediction: str) -> DataFrame:
    """Accuracy and precision, recall and F1 of class 1, per ``keys``."""
    y, p = F.col(label), F.col(prediction)
    counted = df.groupBy(*keys).agg(
        _count((y == 1) & (p == 1)).alias("tp"),
        _count((y == 0) & (p == 1)).alias("fp"),
        _count((y == 1) & (p == 0)).alias("fn"),
        F.count("*").alias("n"),
        _count(y == p).alias("hits"),
    )
    shares = counted.select(
        *keys,
        _share(F.col("hits"), F.col("n")).alias("accuracy"),
        _share(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _share(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
    )
    return shares.withColumn("f1_score", _f1(F.col("precision"), F.col("recall")))


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per class and averaged precision, recall, F1 and support.

    Everything after the first line works on one row per (label, prediction).
    """
    cells = confusion(df, label, prediction).select(
        F.col(label).alias("y"), F.col(prediction).alias("p"), F.col("rows").alias("n")
    )
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(F.col("y").alias("cls"), F.col("n").alias("support"), F.lit(0).cast("long").alias("said"),
                         F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
                F.struct(F.col("p").alias("cls"), F.lit(0).cast("long").alias("support"), F.col("n").alias("said"),
                         F.lit(0).cast("long").alias("hit")),
            )
        ).alias("s")
    ).select("s.*")
    per_class = (
        sides.groupBy("cls")
        .agg(F.sum("support").alias("support"), F.sum("said").alias("said"), F.sum("hit").alias("hit"))
        .select(
            F.col("cls").cast("string").alias("row"),
            _share(F.col("hit"), F.col("said")).alias("precision"),
            _share(F.col("hit"), F.col("support")).alias("recall"),
            "support",
            "hit",
        )
        .withColumn("f1_score", _f1(F.col("precision"), F.col("recall")))
    )
    figures = ("precision", "recall", "f1_score")
    total = F.sum("support")
    averages = per_class.agg(
        F.struct(
            F.lit("accuracy").alias("row"),
            *[(F.sum("hit") / total).alias(m) for m in figures],
            total.alias("support"),
        ).alias("a"),
        F.struct(
            F.lit("macro avg").alias("row"), *[F.avg(m).alias(m) for m in figures], total.alias("support")
        ).alias("b"),
        F.struct(
            F.lit("weighted avg").alias("row"),
            *[(F.sum(F.col(m) * F.col("support")) / total).alias(m) for m in figures],
            total.alias("support"),
        ).alias("c"),
    )
    summary = averages.select(F.explode(F.array("a", "b", "c")).alias("r")).select("r.*")
    return per_class.select("row", *figures, "support").unionByName(summary)


def metrics_long(metrics: DataFrame, key: str = "model") -> DataFrame:
    return metrics.unpivot([key], list(METRICS), "metric", "value")


def best_model(metrics: DataFrame, metric: str) -> DataFrame:
    """The model with the greatest metric; the first listed (lowest ``place``) wins a tie."""
    order = F.struct(F.col(metric), -F.col("place"))
    return metrics.agg(F.max_by("model", order).alias("model"), F.max(metric).alias(metric))
