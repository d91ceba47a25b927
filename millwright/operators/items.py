"""Whole records as key-value items."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import exact_text
from ..schemas import SERVICE_RECORD
from ..session import PACKED, shuffles_removed, written

NUMBER = "exact_number"  # the field that marks an exact number: its text


def decimals(value: Column, kind: T.DataType) -> Column:
    """The same value with every float inside it turned into a struct that holds its exact text."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(value.isNotNull(), F.struct(exact_text(value).alias(NUMBER)))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda e: decimals(e, kind.elementType))
    if isinstance(kind, T.StructType):
        fields = [decimals(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def floats_to_decimals(df: DataFrame) -> DataFrame:
    return df.select(*[decimals(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def with_numbers(value: Any) -> Any:
    """An item as plain Python values, exact texts as decimals; runs on the rows at hand in the writer."""
    if isinstance(value, dict):
        if set(value) == {NUMBER}:
            return Decimal(value[NUMBER])
        return {k: with_numbers(v) for k, v in value.items()}
    return [with_numbers(v) for v in value] if isinstance(value, list) else value


def item_rows(records: DataFrame, *keep: str) -> DataFrame:
    """Typed items of raw record texts; an unreadable text gives a null item."""
    item = F.from_json("raw", SERVICE_RECORD, {"mode": "PERMISSIVE"})
    return floats_to_decimals(records.select(*keep, item.alias("item")))


def last_record_per_key(records: DataFrame, key: str, *order: str) -> DataFrame:
    """A later put replaces an earlier one of the same key, so only the last text is kept.

    Runs on raw texts, before the costly parse; readable texts only. Texts are made once and neither sorted, compared
    nor, while few of them are replaced, shuffled: keys are counted, and only those that occur again are ranked. These are
    written, so that Spark knows how few they are before it plans the join; the other rows then stay where they are.
    """
    found = records.withColumn("_key", F.get_json_object("raw", f"$.{key}"))
    known = [F.col(c).isNotNull() for c in ("_key", *order)]
    with shuffles_removed(records.sparkSession):
        keyed = written(found.where(reduce(Column.__and__, known)).select("_key", *order, "raw"), "keyed", **PACKED)
        narrow = keyed.select("_key", *order)
        again = written(narrow.groupBy("_key").count().where(F.col("count") > 1).select("_key"), "again")
        repeats = narrow.join(again, "_key", "left_semi")
        last = repeats.groupBy("_key").agg(F.max(F.struct(*order)).alias("_last"))
        replaced = written(repeats.join(last, "_key").where(F.struct(*order) != F.col("_last")).select("_key", *order), "replaced")
    kept = keyed.join(replaced, ["_key", *order], "left_anti")
    return kept.select(F.col("_key").alias(key), "raw")
