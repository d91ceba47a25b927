"""Queries on sensor events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import timefn
from ..functions.numeric import logistic
from ..operators import changes, features, flatten, marts, previous, scoring, upsert
from ..schemas import FAMILIES, SENSOR_KEY, Family
from ..sources import shapes

# A fixed logistic model per family stands in for a trained one, so that SQL can check scores.
SCORERS = {
    "arm_robot": ({"joint_wear_percent": 0.05, "servo_motor_rpm": 0.001}, -2.5),
    "cnc_machine": ({"tool_wear_percent": 0.06, "cutting_force_n": 0.01}, -3.0),
    "injection_molding": ({"mold_wear_percent": 0.04, "cycle_time_s": 0.002}, -2.0),
    "battery_assembly": ({"electrode_wear_percent": 0.07, "vacuum_pressure_kpa": 0.01}, -4.0),
}

DAY = "2024-01-15"
CRM_DAY = "1998-06-15"

UPSERT_TARGET = ("view", "click", "purchase", "error")
UPSERT_SOURCE = ("error", "purchase", "signup")


def family_rows(spark: SparkSession, sf_dir: str, family: Family) -> DataFrame:
    """All events as flat sensor rows of one family, by way of JSON."""
    messages = shapes.sensor_messages(shapes.table(spark, sf_dir, "events"), family)
    return flatten.sensor_rows(messages, family, "event_id", "event_type")


def history_cut(spark: SparkSession, sf_dir: str) -> previous.Cut:
    """Slices of the busy machines' histories, measured on three columns of the raw table."""
    events = shapes.table(spark, sf_dir, "events").select("event_id", "ts", F.concat(F.lit("M-"), F.col("user_id")).alias("machine_id"))
    return previous.slices(events, "machine_id", F.col("ts"), ["event_id"])


def sensor_flatten(spark: SparkSession, sf_dir: str, family: Family) -> DataFrame:
    return family_rows(spark, sf_dir, family).drop("event_type")


def daily_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = shapes.table(spark, sf_dir, "events")
    start = F.lit(DAY).cast("timestamp_ntz")
    day = events.where((F.col("ts") >= start) & (F.col("ts") < start + F.expr("interval 1 day")))
    return day.select(
        "event_id",
        timefn.iso_text(F.col("ts")).alias("timestamp"),
        F.date_format("ts", timefn.DAY_COMPACT).alias("folder"),
        F.date_format(F.date_sub(F.to_date("ts"), 1), timefn.DAY_DASHED).alias("day_before"),
    )


def crm_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one day from CSV text with a day-first date column."""
    orders = shapes.table(spark, sf_dir, "orders")
    row = F.struct(
        F.date_format("o_orderdate", timefn.DAY_FIRST).alias("Tanggal"),
        F.concat(F.lit("CUST-"), F.col("o_custkey")).alias("customer"),
        F.col("o_orderpriority").alias("model"),
        F.col("o_orderkey").alias("quantity"),
    )
    lines = orders.select(F.to_csv(row).alias("line"))
    parsed = lines.select(
        F.from_csv("line", "Tanggal string, customer string, model string, quantity bigint").alias("r")
    ).select("r.*")
    return crm_rows(parsed, CRM_DAY)


def crm_rows(rows: DataFrame, day: str) -> DataFrame:
    return rows.where(F.col("Tanggal") == F.date_format(F.lit(day).cast("date"), timefn.DAY_FIRST))


def ratio_features(spark: SparkSession, sf_dir: str, family: Family) -> DataFrame:
    rows = family_rows(spark, sf_dir, family)
    return rows.select("event_id", *features.derived_columns(family))


def feature_align(spark: SparkSession, sf_dir: str, family: Family) -> DataFrame:
    return features.serving_features(family_rows(spark, sf_dir, family), family, "event_id")


def serving_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context features alone; the scan then needs neither readings nor machine."""
    rows = family_rows(spark, sf_dir, FAMILIES["arm_robot"])
    framed = features.add_missing(features.with_calendar(rows), {"time_since_maintenance": F.lit(0)})
    return framed.select("event_id", "time_since_maintenance", "hour_of_day", "day_of_week")


def train_features(spark: SparkSession, sf_dir: str, family: Family) -> DataFrame:
    history = shapes.labelled_history(shapes.table(spark, sf_dir, "events"), family)
    return features.training_features(history, family, history_cut(spark, sf_dir), "event_id")


def serving_prev(spark: SparkSession, sf_dir: str, family: Family) -> DataFrame:
    rows = family_rows(spark, sf_dir, family)
    return features.serving_history(rows, family, history_cut(spark, sf_dir), "event_id")


def fixed_score(family: Family) -> Column:
    weights, intercept = SCORERS[family.name]
    return logistic(weights, intercept)


def engineered_weights(family: Family) -> dict[str, float]:
    """Weights on readings, a ratio, the look back and the calendar: a stand-in for a trained model's features."""
    first = family.lagged[0]
    return SCORERS[family.name][0] | {family.derived[0].name: 0.02, f"{first}_prev": 0.0005, f"{first}_change": 0.1, "hour_of_day": 0.01}


def engineered_score(family: Family) -> Column:
    return logistic(engineered_weights(family), SCORERS[family.name][1])


def score_rows(rows: DataFrame, family: Family, *keep: str) -> DataFrame:
    return scoring.risk_rows(rows, fixed_score(family), F.col("timestamp"), *keep)


def risk_class(spark: SparkSession, sf_dir: str, family: Family) -> DataFrame:
    return score_rows(family_rows(spark, sf_dir, family), family, "event_id")


def union_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event scored by the family its topic belongs to."""
    events = shapes.table(spark, sf_dir, "events")
    frames = []
    for family in FAMILIES.values():
        messages = shapes.routed(shapes.sensor_messages(events, family), family)
        rows = flatten.sensor_rows(messages, family, "event_id")
        frames.append(scoring.accepted(score_rows(rows, family, "event_id")))
    return scoring.union_families(frames, "event_id")


def risk_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = marts.daily_risk_counts(union_predictions(spark, sf_dir))
    return counts.withColumn("date", F.col("date").cast("string"))


def cdc_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.classify_changes(shapes.change_messages(shapes.table(spark, sf_dir, "events")), "event_id")


def cdc_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = shapes.change_messages(shapes.table(spark, sf_dir, "events"))
    return changes.rejected_changes(messages, "event_id").select("event_id", "reason")


def upsert_sides(spark: SparkSession, sf_dir: str, family: Family) -> tuple[DataFrame, DataFrame]:
    """Lake rows and staged rows that overlap; staged readings are one higher."""
    rows = family_rows(spark, sf_dir, family)
    columns = [*family.lake_schema.fieldNames()]
    target = rows.where(F.col("event_type").isin(*UPSERT_TARGET)).select(*columns)
    source = rows.where(F.col("event_type").isin(*UPSERT_SOURCE)).select(
        "timestamp",
        "machine_id",
        F.concat("machine_type", F.lit("_STAGED")).alias("machine_type"),
        *[(F.col(c) + 1).alias(c) for c in family.readings],
    )
    return target, source


def upsert_rows(spark: SparkSession, sf_dir: str, family: Family) -> DataFrame:
    target, source = upsert_sides(spark, sf_dir, family)
    return upsert.upsert(target, source, SENSOR_KEY, family.readings)


def upsert_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.duplicate_keys(shapes.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = shapes.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity"
    )
    picked = upsert.resolve_duplicates(
        lines, ["l_orderkey", "l_linenumber"], "latest", ["l_shipdate", "l_partkey", "l_suppkey"]
    )
    return picked.drop("l_shipdate")
