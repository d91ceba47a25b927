"""Streaming message sources behind one function."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def message_stream(
    spark: SparkSession, kind: str, location: str, earliest: bool = False, **options: str
) -> DataFrame:
    """Unbounded messages with column ``value`` (text).

    ``kafka``: ``location`` is the topic; broker settings come as options, and the
    connector must be on the class path. ``text``: ``location`` is a folder of
    line-delimited messages.
    """
    if kind == "kafka":
        reader = spark.readStream.format("kafka").option("subscribe", location)
        reader = reader.option("startingOffsets", "earliest" if earliest else "latest")
        for name, value in options.items():
            reader = reader.option(name.replace("_", "."), value)
        return reader.load().select(F.col("value").cast("string").alias("value"), "partition", "offset")
    if kind == "text":
        reader = spark.readStream
        for name, value in options.items():
            reader = reader.option(name, value)
        return reader.text(location)
    raise ValueError(f"unknown message source {kind!r}")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table, one file or a folder of part files, as a stream.

    A plain path must be a folder for the file stream; as a pattern it may be either.
    """
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")
