from __future__ import annotations

import json
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millwright.functions.risk import risk_level, shown_probability
from millwright.operators import features, flatten, previous
from millwright.schemas import ARM_ROBOT, BATTERY_ASSEMBLY, CNC_MACHINE, FAMILIES, INJECTION_MOLDING


def message(family, readings, machine="M1", ts="2025-01-06T10:00:00", **extra):
    return json.dumps(
        {"timestamp": ts, "machine_id": machine, "machine_type": family.machine_type, "readings": readings, **extra}
    )


def one_row(spark, family, readings, training=False):
    text = message(family, readings)
    rows = flatten.sensor_rows(spark.createDataFrame([(text,)], "value string"), family)
    return features.with_derived(rows, family, training).first()


def test_feature_vector_sizes():
    assert [len(f.feature_order) for f in FAMILIES.values()] == [23, 30, 34, 39]


def test_arm_formulas(spark):
    r = one_row(
        spark,
        ARM_ROBOT,
        {
            "servo_motor_rpm": 1200.0,
            "hydraulic_pressure_psi": 2000.0,
            "temperature_celsius": 64.0,
            "vibration_mm_per_s": 0.05,
            "operation_time_hours": 0.0,
            "cycle_count": 7,
            "joint_wear_percent": -2.5,
        },
    )
    assert r["pressure_temp_ratio"] == 31.25
    assert r["wear_per_hour"] == -2.5 / 0.1
    assert r["rpm_vibration_ratio"] == 1200.0 / 0.1
    assert r["cycle_count"] == 7


def test_zero_and_missing_denominators(spark):
    r = one_row(spark, ARM_ROBOT, {"hydraulic_pressure_psi": 2000.0, "temperature_celsius": 0.0, "joint_wear_percent": 1.0})
    assert r["pressure_temp_ratio"] is None  # division by zero is unknown
    assert r["wear_per_hour"] is None  # null hours are unknown, not the floor
    assert r["servo_motor_rpm"] is None


def test_guards_differ_between_training_and_serving(spark):
    cnc = {"spindle_speed_rpm": 5000.0, "motor_temperature_celsius": 0.0}
    assert one_row(spark, CNC_MACHINE, cnc)["speed_temp_ratio"] == 50000.0
    assert one_row(spark, CNC_MACHINE, cnc, training=True)["speed_temp_ratio"] is None
    molding = {"barrel_temperature_celsius": 220.0, "mold_temperature_celsius": 0.0, "cycle_time_s": 36.0}
    assert one_row(spark, INJECTION_MOLDING, molding)["temp_ratio"] == 2200.0
    assert one_row(spark, INJECTION_MOLDING, molding, training=True)["temp_ratio"] is None
    assert one_row(spark, INJECTION_MOLDING, molding)["cycle_efficiency"] == 100.0


def test_battery_formulas(spark):
    r = one_row(
        spark,
        BATTERY_ASSEMBLY,
        {
            "electrode_temperature_celsius": 320.0,
            "cooling_system_temperature_celsius": 25.0,
            "cell_voltage_uniformity_ratio": 0.5,
            "insulation_resistance_mohm": 500.0,
            "leakage_current_ma": 0.0,
        },
    )
    assert r["temp_diff"] == 295.0
    assert r["electrical_stability"] == 250.0 / 0.001


def test_flatten_rejects_and_extra_fields(spark):
    texts = [
        message(ARM_ROBOT, {"cycle_count": 3, "surprise": 1}, extra="x"),
        "not json",
        '{"timestamp": "2025',
        message(ARM_ROBOT, {"cycle_count": "many"}),
    ]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    good = flatten.sensor_rows(df, ARM_ROBOT)
    assert good.columns == ARM_ROBOT.lake_schema.fieldNames()
    assert [r["cycle_count"] for r in good.collect()] == [3]
    assert flatten.sensor_rejects(df, ARM_ROBOT).count() == 3


def test_align_fills_absent_features(spark):
    df = spark.createDataFrame([(1, 2.0)], "id int, a double")
    row = features.align(df, ["a", "a_prev", "b_prev", "a_change", "c"], "id").first()
    assert tuple(row) == (1, 2.0, 2.0, 0, 0, 0)


def test_nested_and_flat_payloads_agree(spark):
    nested = spark.createDataFrame(
        [("2025-01-06T10:00:00", "M1", (1200.0, 60.0, 5.0))],
        "timestamp string, machine_id string, readings struct<servo_motor_rpm:double,temperature_celsius:double,time_since_maintenance:double>",
    )
    flat = nested.select("timestamp", "machine_id", "readings.*")
    needed = [c for c in ARM_ROBOT.readings]
    def out(df):
        framed = features.default_readings(features.nested_or_flat(df, ARM_ROBOT), needed)
        return features.serving_features(framed, ARM_ROBOT, "machine_id").first()
    assert out(nested) == out(flat)
    assert out(nested)["time_since_maintenance"] == 5.0
    assert out(nested)["day_of_week"] == 0


def test_training_drops_first_reading_and_incomplete_rows(spark):
    columns = ["event_id", "timestamp", "machine_id", "machine_type", *ARM_ROBOT.readings, "status", "time_since_maintenance"]
    def row(i, machine, hour, rpm, status="NORMAL"):
        return (i, f"2025-01-06T{hour:02d}:00:00", machine, "ROBOTIC_ARM", rpm, 2000.0, 64.0, 0.5, 10.0, i, 5.0, status, 1.0)
    rows = [row(1, "A", 1, 100.0), row(2, "A", 2, 110.0, "FAILURE"), row(3, "A", 3, None), row(4, "A", 4, 130.0), row(5, "B", 1, 90.0), row(6, None, 2, 1.0)]
    schema = "event_id int, timestamp string, machine_id string, machine_type string, " + ", ".join(
        f"{c} {'int' if c == 'cycle_count' else 'double'}" for c in ARM_ROBOT.readings
    ) + ", status string, time_since_maintenance double"
    df = spark.createDataFrame(rows, schema)
    assert df.columns == columns
    out = features.training_features(df, ARM_ROBOT, previous.HOUR, "event_id").collect()
    assert [(r["event_id"], r["servo_motor_rpm_prev"], r["servo_motor_rpm_change"], r["failure"]) for r in out] == [(2, 100.0, 10.0, 1)]


@pytest.mark.parametrize("width", [1, 1_000_000, previous.HOUR, previous.HOUR * 24])
def test_previous_is_a_plain_lag_for_any_slice_width(spark, width):
    rows = [(i, "hot" if i % 3 else f"m{i % 7}", f"2025-01-06T00:{i % 60:02d}:{(i * 7) % 60:02d}", float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, machine_id string, timestamp string, x double")
    ts = F.to_timestamp("timestamp")
    got = previous.with_previous(df, "machine_id", ts, ["id"], ["x"], width).select("id", F.col("previous.x").alias("p"))
    plain = df.select("id", F.lag("x").over(Window.partitionBy("machine_id").orderBy("timestamp", "id")).alias("p"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


@pytest.mark.parametrize(("target", "tie"), [(50, "id"), (7, "name"), (1, "id"), (5000, "id")])
def test_slices_per_machine_hold_the_target(spark, target, tie):
    """A busy machine, a burst at one instant, quiet machines, and rows without a time."""
    rows = [(i, "busy", f"2025-01-{1 + i % 9:02d}T{i % 24:02d}:{i % 60:02d}:{(i * 7) % 60:02d}") for i in range(1200)]
    rows += [(2000 + i, "burst", "2025-01-06T00:00:00") for i in range(300)] + [(2500 + i, "burst", "2025-01-06T00:00:01") for i in range(20)]
    rows += [(3000 + i, f"quiet{i % 100}", f"2025-03-{1 + i % 28:02d}T00:00:00") for i in range(400)] + [(4000 + i, "busy", None) for i in range(30)]
    rows = [(i, f"n{i:05d}", m, t, float(i)) for i, m, t in rows] + [(9, "n", None, "2025-01-01T00:00:00", 0.0)]
    df = spark.createDataFrame(rows, "id int, name string, machine_id string, timestamp string, x double").repartition(4).cache()
    ts = F.to_timestamp("timestamp")
    cut = previous.slices(df, "machine_id", ts, [tie], target)
    got = previous.with_previous(df, "machine_id", ts, [tie], ["x"], cut).select("id", F.col("previous.x").alias("p"))
    plain = df.select("id", F.when(F.col("machine_id").isNotNull(), F.lag("x").over(Window.partitionBy("machine_id").orderBy("timestamp", tie))).alias("p"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    if cut is None:
        assert target == 5000
        return
    sizes = previous._sliced(df.withColumn("_at", ts), "machine_id", cut, [tie]).where("machine_id is not null").groupBy("machine_id", "_slice").count().collect()
    assert max(r["count"] for r in sizes) <= target
    quiet = [r for r in sizes if r["machine_id"].startswith("quiet")]
    if target >= 4:
        assert len(quiet) == 100  # a quiet machine is never cut
    assert cut.count() <= 40 + 500 // target


def test_slices_shrink_for_a_busy_machine(spark):
    df = spark.range(10_000).select(F.lit("hot").alias("machine_id"), F.timestamp_seconds(F.col("id") / 10).alias("at"))
    assert previous.slice_micros(df, "machine_id", F.col("at"), target_rows=100) == previous.HOUR // 100
    assert previous.slice_micros(df, "machine_id", F.col("at")) == previous.HOUR * 24


def test_rows_without_machine_have_no_previous(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, None, 2.0)], "id int, machine_id string, x double")
    out = previous.with_previous(df, "machine_id", F.timestamp_seconds(F.col("id")), ["id"], ["x"], 10)
    assert [r["previous"] for r in out.collect()] == [None, None]


def test_first_reading_is_its_own_predecessor(spark):
    texts = [message(ARM_ROBOT, {"servo_motor_rpm": 10.0 * i}, ts=f"2025-01-06T0{i}:00:00") for i in (3, 1, 2)]
    rows = flatten.sensor_rows(spark.createDataFrame([(t,) for t in texts], "value string"), ARM_ROBOT, )
    out = features.serving_history(rows, ARM_ROBOT, previous.HOUR, "timestamp").orderBy("timestamp").collect()
    assert [(r["servo_motor_rpm"], r["servo_motor_rpm_prev"], r["servo_motor_rpm_change"]) for r in out] == [
        (10.0, 10.0, 0.0),
        (20.0, 10.0, 10.0),
        (30.0, 20.0, 10.0),
    ]
    assert out[0]["temperature_celsius"] == 0  # missing readings count as zero


@pytest.mark.parametrize(
    "p, level, shown",
    [
        (0.2996, "LOW", 0.3),
        (0.3, "MEDIUM", 0.3),
        (0.6999, "MEDIUM", 0.7),
        (0.7, "HIGH", 0.7),
        (0.0625, "LOW", 0.062),
        (0.1875, "LOW", 0.188),
        (math.nan, "HIGH", math.nan),
        (None, None, None),
    ],
)
def test_risk_boundaries(spark, p, level, shown):
    row = spark.createDataFrame([(p,)], "p double").select(risk_level(F.col("p")).alias("l"), shown_probability(F.col("p")).alias("s")).first()
    assert row["l"] == level
    assert row["s"] == shown or (isinstance(shown, float) and math.isnan(shown) and math.isnan(row["s"]))
