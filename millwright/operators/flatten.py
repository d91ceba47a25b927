"""Decode JSON messages and hoist nested readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import Family

CORRUPT = "_corrupt_record"


def decode(messages: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Parse ``value`` into the struct ``message``; a malformed text fills its corrupt field.

    The parse sits in a generator of one element. A filter on the parsed fields
    cannot be pushed below it, which would parse every text a second time.
    """
    typed = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return messages.select("*", F.explode(F.array(F.from_json(value, typed, options))).alias("message"))


def is_malformed() -> Column:
    return F.col("message").isNull() | F.col(f"message.{CORRUPT}").isNotNull()


def flatten_readings(decoded: DataFrame, family: Family, *keep: str) -> DataFrame:
    """Envelope columns and readings side by side, in lake order; absent readings are null."""
    return decoded.select(
        *keep,
        *[F.col(f"message.{c}").alias(c) for c in ("timestamp", "machine_id", "machine_type")],
        *[F.col(f"message.readings.{c}").alias(c) for c in family.readings],
    )


def sensor_rows(messages: DataFrame, family: Family, *keep: str) -> DataFrame:
    """Well-formed messages of one family as flat rows."""
    return flatten_readings(decode(messages, family.event_schema).where(~is_malformed()), family, *keep)


def sensor_rejects(messages: DataFrame, family: Family, *keep: str) -> DataFrame:
    """Messages that do not parse, with their text."""
    return decode(messages, family.event_schema).where(is_malformed()).select(*keep, "value")


def nested_or_flat(df: DataFrame, family: Family) -> DataFrame:
    """Accept readings nested in a struct or already at the top level."""
    if "readings" not in df.columns:
        return df
    present = set(df.schema["readings"].dataType.fieldNames())
    rest = [c for c in df.columns if c != "readings" and c not in family.readings]
    # Everything sent along in the struct is kept, such as time since maintenance.
    return df.select(*rest, *[F.col(f"readings.{c}").alias(c) for c in present if c not in rest])
