"""Stored aggregate: daily risk counts per machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefn import text_date

RISK_KEYS = ("date", "machine_type", "machine_id", "risk_level")


def daily_risk_counts(predictions: DataFrame) -> DataFrame:
    dated = predictions.withColumn("date", text_date(F.col("prediction_timestamp")))
    return dated.groupBy(*RISK_KEYS).agg(F.count("*").alias("risk_count"))


def summed_counts(counts: DataFrame) -> DataFrame:
    """One row per key of counts that were taken of different rows."""
    return counts.groupBy(*RISK_KEYS).agg(F.sum("risk_count").alias("risk_count"))


def add_counts(stored: DataFrame, increment: DataFrame) -> DataFrame:
    """Fold newly counted rows into counts already stored."""
    return summed_counts(stored.select(*RISK_KEYS, "risk_count").unionByName(increment.select(*RISK_KEYS, "risk_count")))
