"""From features to risk rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.risk import risk_level, shown_probability
from ..functions.text import or_unknown
from ..schemas import PREDICTION_COLUMNS


def risk_rows(scored: DataFrame, probability: Column, at: Column, *keep: str) -> DataFrame:
    """Rows of the prediction table: class of the raw probability, rounded figure shown."""
    return scored.select(
        *keep,
        at.alias("prediction_timestamp"),
        or_unknown(F.col("machine_id")).alias("machine_id"),
        F.col("machine_type"),
        shown_probability(probability).alias("failure_probability"),
        risk_level(probability).alias("risk_level"),
    )


def accepted(rows: DataFrame) -> DataFrame:
    """Rows that could be scored."""
    return rows.where(F.col("risk_level").isNotNull())


def unscored(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("risk_level").isNull())


def union_families(frames: list[DataFrame], *keep: str) -> DataFrame:
    columns = [*keep, *PREDICTION_COLUMNS]
    return reduce(DataFrame.unionByName, [f.select(*columns) for f in frames])
