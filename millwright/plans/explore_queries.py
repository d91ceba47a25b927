"""Exploration and model-quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate, explore, features, sampling
from ..schemas import FAMILIES, Family
from ..sources import shapes
from .sensor_queries import fixed_score, history_cut

ARM = FAMILIES["arm_robot"]
THRESHOLDS = {"at_30": 0.3, "at_50": 0.5, "at_70": 0.7}


def history(spark: SparkSession, sf_dir: str, family: Family = ARM) -> DataFrame:
    return features.with_label(shapes.labelled_history(shapes.table(spark, sf_dir, "events"), family))


def complete(spark: SparkSession, sf_dir: str, family: Family = ARM) -> DataFrame:
    """The rows that the trainers explore: with features and look back, and nothing missing."""
    rows = shapes.labelled_history(shapes.table(spark, sf_dir, "events"), family)
    return features.training_features(rows, family, history_cut(spark, sf_dir), "event_id", "status")


def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.value_counts(complete(spark, sf_dir), "status")


def failure_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = explore.rate_by(complete(spark, sf_dir), F.col("hour_of_day"), "hour_of_day")
    return rates.withColumn("failure_rate", F.round("failure_rate", 6))


def failure_by_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = explore.rate_by(complete(spark, sf_dir), F.col("day_of_week"), "day_of_week")
    return rates.withColumn("failure_rate", F.round("failure_rate", 6))


def dataset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.dataset_stats(history(spark, sf_dir), "machine_id")


def dataset_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.first_rows(history(spark, sf_dir), ["timestamp", "event_id"])


def correlation_matrix(spark: SparkSession, sf_dir: str, family: Family) -> DataFrame:
    pairs = explore.correlation_matrix(complete(spark, sf_dir, family), [*family.key_features, "failure"])
    return pairs.withColumn("correlation", F.round("correlation", 6))


def histogram(spark: SparkSession, sf_dir: str, family: Family) -> DataFrame:
    return explore.histograms(complete(spark, sf_dir, family), family.key_features)


def density(spark: SparkSession, sf_dir: str, family: Family) -> DataFrame:
    curves = explore.densities(complete(spark, sf_dir, family), family.key_features)
    return curves.select(
        "feature", "failure", "point", F.round("x", 6).alias("x"), F.round("density", 6).alias("density")
    )


def density_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    family = FAMILIES["injection_molding"]
    return explore.pair_densities(complete(spark, sf_dir, family), family.scatter_pairs)


def standardize(spark: SparkSession, sf_dir: str, family: Family) -> DataFrame:
    scaled = explore.standardize(history(spark, sf_dir, family), ["event_id"], family.key_features)
    return scaled.select("event_id", *[F.round(c, 6).alias(c) for c in family.key_features])


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label and probability of every event that can be scored."""
    rows = history(spark, sf_dir)
    return rows.select("event_id", "failure", fixed_score(ARM).alias("p")).where(F.col("p").isNotNull())


def predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark, sf_dir).select("failure", (F.col("p") > 0.5).cast("int").alias("prediction"))


def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion(predicted(spark, sf_dir), "failure", "prediction")


def binary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = evaluate.binary_metrics(predicted(spark, sf_dir).withColumn("model", F.lit("fixed")), ["model"], "failure", "prediction")
    return one.select("model", *[F.round(m, 6).alias(m) for m in evaluate.METRICS])


def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = evaluate.classification_report(predicted(spark, sf_dir), "failure", "prediction")
    return report.select("row", *[F.round(m, 6).alias(m) for m in evaluate.METRICS[1:]], "support")


def compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of several decision limits, all from one pass."""
    models = F.array(
        *[
            F.struct(
                F.lit(name).alias("model"),
                F.lit(place).alias("place"),
                (F.col("p") > limit).cast("int").alias("prediction"),
            )
            for place, (name, limit) in enumerate(THRESHOLDS.items())
        ]
    )
    rows = judged(spark, sf_dir).select("failure", F.explode(models).alias("m")).select("failure", "m.*")
    metrics = evaluate.binary_metrics(rows, ["model", "place"], "failure", "prediction")
    return metrics.select("model", "place", *[F.round(m, 6).alias(m) for m in evaluate.METRICS])


def metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.metrics_long(compared(spark, sf_dir).drop("place"))


def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.best_model(compared(spark, sf_dir), "f1_score")


def top_features(spark: SparkSession, sf_dir: str, family: Family) -> DataFrame:
    """All features ranked by the size of their correlation with failure."""
    pairs = explore.correlation_with(complete(spark, sf_dir, family), list(family.feature_order), "failure")
    ranked = pairs.select("feature", F.round(F.abs("correlation"), 6).alias("importance"))
    return explore.top_features(ranked, family.top_features)


def split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact stratified split and its folds; fold 5 holds the rows not trained on."""
    rows = sampling.stratified(history(spark, sf_dir).select("event_id", "failure"), ["event_id"], "failure")
    return rows.withColumns({"is_train": F.col("is_train").cast("int"), "fold": F.coalesce("fold", F.lit(sampling.FOLDS))})


def split_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sampling.stratified(history(spark, sf_dir).select("event_id", "failure"), ["event_id"], "failure")
    return sampling.stratum_shares(rows, "failure")
