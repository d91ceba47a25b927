"""Classify database change events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefn import micros_text
from ..schemas import CHANGE_COLUMNS, CHANGE_EVENT
from .flatten import decode, is_malformed


def _judged(messages: DataFrame) -> DataFrame:
    before, after = F.col("message.before"), F.col("message.after")
    image = F.coalesce(after, before)
    reason = (
        F.when(is_malformed(), "malformed")
        .when(image.isNull(), "no_image")
        .when(image["created_at"].isNull(), "no_created_at")
    )
    return decode(messages, CHANGE_EVENT).select(
        *[c for c in messages.columns if c != "value"],
        "value",
        image["id"].alias("id"),
        micros_text(image["created_at"]).alias("created_at"),
        image["name"].alias("name"),
        image["stock"].alias("stock"),
        (before.isNull() & after.isNotNull()).cast("int").alias("is_created"),
        (before.isNotNull() & after.isNotNull()).cast("int").alias("is_updated"),
        (before.isNotNull() & after.isNull()).cast("int").alias("is_deleted"),
        reason.alias("reason"),
    )


def classify_changes(messages: DataFrame, *keep: str) -> DataFrame:
    """One row per usable change: values of the newest image and three flags."""
    return _judged(messages).where(F.col("reason").isNull()).select(*keep, *CHANGE_COLUMNS)


def rejected_changes(messages: DataFrame, *keep: str) -> DataFrame:
    return _judged(messages).where(F.col("reason").isNotNull()).select(*keep, "value", "reason")


def with_change_date(changes: DataFrame) -> DataFrame:
    """Partition date of every row from its own ``created_at``."""
    return changes.withColumn("date", F.substring("created_at", 1, 10))
