"""Rows that every operator must take: nulls, empty and long texts, repeated rows and ids, clashing extra columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, start string, shard string, score string"


def odd_documents(spark: SparkSession, texts: list[tuple[int | None, str | None]] = ()) -> DataFrame:
    long_text = "Long words of a very long text, again and again. " * 4000
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, long_text), (6, long_text), (7, "one"), (7, "one"), (7, "other é ß 😀"), (None, "no id"), *texts]
    return spark.createDataFrame([(i, t, None, "s", None, 1, "x", "y", None) for i, t in rows], SCHEMA)


def no_documents(spark: SparkSession) -> DataFrame:
    return odd_documents(spark).limit(0)


def no_labels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "doc_id long, quality int, toxic int, text string")
