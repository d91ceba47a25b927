"""Feature engineering for training and serving, driven by the family specification."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import timefn
from ..functions.numeric import ratio
from ..schemas import CONTEXT_FEATURES, Family
from .flatten import nested_or_flat
from .previous import Cut, with_previous


def derived_columns(family: Family, training: bool = False) -> list[Column]:
    out = []
    for d in family.derived:
        value = F.expr(d.numerator).cast("double")
        if d.denominator is not None:
            value = ratio(value, F.col(d.denominator).cast("double"), d.train_floor if training else d.floor)
        out.append(value.alias(d.name))
    return out


def with_derived(df: DataFrame, family: Family, training: bool = False) -> DataFrame:
    return df.select("*", *derived_columns(family, training))


def add_missing(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add each column only where the frame has none of that name."""
    return df.withColumns({name: value for name, value in columns.items() if name not in df.columns})


def with_label(df: DataFrame) -> DataFrame:
    return df.withColumn("failure", F.when(F.col("status") == "FAILURE", 1).otherwise(0))


def with_calendar(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Hour and weekday of ``at`` (the event time unless given), unless already there."""
    moment = timefn.parse_ts(F.col("timestamp")) if at is None else at
    return add_missing(
        df, {"hour_of_day": timefn.hour_of_day(moment), "day_of_week": timefn.day_of_week(moment)}
    )


def default_readings(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """A missing reading counts as zero: an absent column as well as a null."""
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(0)) if c in df.columns else F.lit(0) for c in names}
    )


def align(df: DataFrame, required: list[str], *keep: str) -> DataFrame:
    """Exactly the required features, in order.

    An absent ``x_prev`` takes ``x`` when there is one; any other absent feature is 0.
    """
    present = set(df.columns)

    def pick(name: str) -> Column:
        if name in present:
            return F.col(name)
        base = name.replace("_prev", "")
        if "_prev" in name and base in present:
            return F.col(base).alias(name)
        return F.lit(0).alias(name)

    return df.select(*keep, *[pick(name) for name in required])


def with_changes(df: DataFrame, family: Family, first_is_self: bool) -> DataFrame:
    """Spread ``previous`` into ``x_prev`` and ``x_change``.

    While serving, a machine's first reading is its own predecessor.
    """
    columns: dict[str, Column] = {}
    for c in family.lagged:
        before = F.col(f"previous.{c}")
        if first_is_self:
            before = F.when(F.col("previous").isNull(), F.col(c)).otherwise(before)
        columns[f"{c}_prev"] = before
        columns[f"{c}_change"] = F.col(c) - before
    return df.withColumns(columns).drop("previous")


def training_features(history: DataFrame, family: Family, width: Cut, *keep: str) -> DataFrame:
    """Labelled feature rows; a row with any null in any column is dropped."""
    frame = with_derived(with_calendar(with_label(history)), family, training=True)
    looked_back = with_previous(
        frame, "machine_id", timefn.parse_ts(F.col("timestamp")), keep or ("timestamp",), family.lagged, width
    )
    complete = with_changes(looked_back, family, first_is_self=False).dropna("any")
    return complete.select(*keep, "machine_id", *family.feature_order, "failure")


def serving_features(rows: DataFrame, family: Family, *keep: str, now: Column | None = None) -> DataFrame:
    """Features of single readings without a look back.

    Maintenance time is 0, previous values equal the current ones, changes are 0.
    ``now`` sets hour and weekday; by default the event time does.
    """
    frame = with_calendar(nested_or_flat(rows, family), now)
    frame = add_missing(frame, {CONTEXT_FEATURES[0]: F.lit(0)})
    return align(with_derived(frame, family), family.feature_order, *keep)


def serving_history(rows: DataFrame, family: Family, width: Cut, *keep: str, seeds: DataFrame | None = None) -> DataFrame:
    """Features of readings with the machine's previous reading looked up."""
    frame = default_readings(nested_or_flat(rows, family), [*family.model_inputs, CONTEXT_FEATURES[0]])
    frame = with_derived(with_calendar(frame), family)
    looked_back = with_previous(
        frame, "machine_id", timefn.parse_ts(F.col("timestamp")), keep or ("timestamp",), family.lagged, width, seeds
    )
    return align(with_changes(looked_back, family, first_is_self=True), family.feature_order, *keep, "machine_id")


def machine_seeds(rows: DataFrame, family: Family, *tie: str) -> DataFrame:
    """Latest reading of each machine in the form ``with_previous`` takes as seeds."""
    frame = default_readings(rows, family.model_inputs).withColumn(
        "_at", timefn.parse_ts(F.col("timestamp")).cast("timestamp")
    )
    carried = ["_at", *tie, *family.lagged]
    return (
        frame.where(F.col("machine_id").isNotNull())
        .groupBy("machine_id")
        .agg(F.max_by(F.struct(*carried), F.struct("_at", *tie)).alias("r"))
        .select("machine_id", "r.*")
    )
