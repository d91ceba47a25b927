"""Declared record types and the four machine families."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Derived:
    """One engineered feature: ``numerator`` or ``numerator / denominator``.

    ``floor`` is the smallest denominator when serving, ``train_floor`` the one
    used on history; ``None`` means the division is not guarded.
    """

    name: str
    numerator: str
    denominator: str | None = None
    floor: float | None = None
    train_floor: float | None = None


@dataclass(frozen=True)
class Family:
    name: str
    machine_type: str
    topic: str
    lake_table: str
    readings: tuple[str, ...]
    counter: str
    model_inputs: tuple[str, ...]
    lagged: tuple[str, ...]
    derived: tuple[Derived, ...]
    key_features: tuple[str, ...]
    scatter_pairs: tuple[tuple[str, str], ...] = ()
    top_features: int = 15
    selection_metric: str = "f1_score"

    @property
    def readings_schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c, T.IntegerType() if c == self.counter else T.DoubleType()) for c in self.readings]
        )

    @property
    def event_schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField("timestamp", T.StringType()),
                T.StructField("machine_id", T.StringType()),
                T.StructField("machine_type", T.StringType()),
                T.StructField("readings", self.readings_schema),
            ]
        )

    @property
    def lake_schema(self) -> T.StructType:
        return T.StructType(self.event_schema.fields[:3] + self.readings_schema.fields)

    @property
    def history_schema(self) -> T.StructType:
        return T.StructType(
            self.lake_schema.fields
            + [T.StructField("status", T.StringType()), T.StructField("time_since_maintenance", T.DoubleType())]
        )

    @property
    def feature_order(self) -> list[str]:
        """Model input order: raw, context, derived, every previous value, every change."""
        return [
            *self.model_inputs,
            *CONTEXT_FEATURES,
            *(d.name for d in self.derived),
            *(f"{c}_prev" for c in self.lagged),
            *(f"{c}_change" for c in self.lagged),
        ]


# Names, orders, guards and column lists that results depend on.
CONTEXT_FEATURES = ("time_since_maintenance", "hour_of_day", "day_of_week")

ARM_ROBOT = Family(
    name="arm_robot",
    machine_type="ROBOTIC_ARM",
    topic="arm_robot_machine_sensor",
    lake_table="arm_robot_sensor",
    readings=(
        "servo_motor_rpm",
        "hydraulic_pressure_psi",
        "temperature_celsius",
        "vibration_mm_per_s",
        "operation_time_hours",
        "cycle_count",
        "joint_wear_percent",
    ),
    counter="cycle_count",
    model_inputs=(
        "servo_motor_rpm",
        "hydraulic_pressure_psi",
        "temperature_celsius",
        "vibration_mm_per_s",
        "operation_time_hours",
        "cycle_count",
        "joint_wear_percent",
    ),
    lagged=(
        "servo_motor_rpm",
        "hydraulic_pressure_psi",
        "temperature_celsius",
        "vibration_mm_per_s",
        "joint_wear_percent",
    ),
    derived=(
        Derived("pressure_temp_ratio", "hydraulic_pressure_psi", "temperature_celsius"),
        Derived("wear_per_hour", "joint_wear_percent", "operation_time_hours", 0.1, 0.1),
        Derived("rpm_vibration_ratio", "servo_motor_rpm", "vibration_mm_per_s", 0.1, 0.1),
    ),
    key_features=(
        "servo_motor_rpm",
        "hydraulic_pressure_psi",
        "temperature_celsius",
        "vibration_mm_per_s",
        "joint_wear_percent",
        "time_since_maintenance",
    ),
    selection_metric="accuracy",
)

CNC_MACHINE = Family(
    name="cnc_machine",
    machine_type="CNC_MACHINE",
    topic="cnc_machine_sensor",
    lake_table="cnc_machine_sensor",
    readings=(
        "spindle_speed_rpm",
        "cutting_force_n",
        "motor_temperature_celsius",
        "coolant_temperature_celsius",
        "coolant_flow_rate_l_min",
        "vibration_mm_per_s",
        "tool_wear_percent",
        "operation_time_hours",
        "parts_produced",
    ),
    counter="parts_produced",
    model_inputs=(
        "spindle_speed_rpm",
        "cutting_force_n",
        "motor_temperature_celsius",
        "coolant_temperature_celsius",
        "coolant_flow_rate_l_min",
        "vibration_mm_per_s",
        "tool_wear_percent",
        "operation_time_hours",
        "parts_produced",
    ),
    lagged=(
        "spindle_speed_rpm",
        "cutting_force_n",
        "motor_temperature_celsius",
        "coolant_temperature_celsius",
        "coolant_flow_rate_l_min",
        "vibration_mm_per_s",
        "tool_wear_percent",
    ),
    derived=(
        Derived("speed_temp_ratio", "spindle_speed_rpm", "motor_temperature_celsius", 0.1, None),
        Derived("wear_per_hour", "tool_wear_percent", "operation_time_hours", 0.1, 0.1),
        Derived("coolant_efficiency", "coolant_flow_rate_l_min", "coolant_temperature_celsius", 0.1, 0.1),
        Derived("vibration_per_speed", "vibration_mm_per_s * 1000", "spindle_speed_rpm", 0.1, 0.1),
    ),
    key_features=(
        "spindle_speed_rpm",
        "cutting_force_n",
        "motor_temperature_celsius",
        "coolant_temperature_celsius",
        "coolant_flow_rate_l_min",
        "vibration_mm_per_s",
        "tool_wear_percent",
        "time_since_maintenance",
    ),
    top_features=20,
)

INJECTION_MOLDING = Family(
    name="injection_molding",
    machine_type="INJECTION_MOLDING",
    topic="injection_molding_machine_sensor",
    lake_table="injection_molding_machine_sensor",
    readings=(
        "barrel_temperature_celsius",
        "mold_temperature_celsius",
        "injection_pressure_bar",
        "holding_pressure_bar",
        "injection_speed_mm_per_s",
        "cooling_time_s",
        "cycle_time_s",
        "material_viscosity_pa_s",
        "mold_clamping_force_tons",
        "operation_time_hours",
        "parts_produced",
        "mold_wear_percent",
    ),
    counter="parts_produced",
    model_inputs=(
        "barrel_temperature_celsius",
        "mold_temperature_celsius",
        "injection_pressure_bar",
        "holding_pressure_bar",
        "injection_speed_mm_per_s",
        "cooling_time_s",
        "cycle_time_s",
        "material_viscosity_pa_s",
        "mold_clamping_force_tons",
        "operation_time_hours",
        "parts_produced",
        "mold_wear_percent",
    ),
    lagged=(
        "barrel_temperature_celsius",
        "mold_temperature_celsius",
        "injection_pressure_bar",
        "holding_pressure_bar",
        "injection_speed_mm_per_s",
        "material_viscosity_pa_s",
        "mold_wear_percent",
    ),
    derived=(
        Derived("temp_ratio", "barrel_temperature_celsius", "mold_temperature_celsius", 0.1, None),
        Derived("pressure_ratio", "injection_pressure_bar", "holding_pressure_bar", 0.1, None),
        Derived("wear_per_hour", "mold_wear_percent", "operation_time_hours", 0.1, 0.1),
        Derived("parts_per_hour", "parts_produced", "operation_time_hours", 0.1, 0.1),
        Derived("cycle_efficiency", "3600", "cycle_time_s", 0.1, 0.1),
    ),
    key_features=(
        "barrel_temperature_celsius",
        "mold_temperature_celsius",
        "injection_pressure_bar",
        "holding_pressure_bar",
        "material_viscosity_pa_s",
        "mold_wear_percent",
        "time_since_maintenance",
    ),
    scatter_pairs=(
        ("operation_time_hours", "mold_wear_percent"),
        ("injection_pressure_bar", "material_viscosity_pa_s"),
        ("barrel_temperature_celsius", "injection_speed_mm_per_s"),
        ("time_since_maintenance", "cycle_time_s"),
    ),
)

BATTERY_ASSEMBLY = Family(
    name="battery_assembly",
    machine_type="BATTERY_ASSEMBLY",
    topic="battery_assembly_machine_sensor",
    lake_table="battery_assembly_machine_sensor",
    readings=(
        "welding_current_amps",
        "welding_voltage_volts",
        "electrode_temperature_celsius",
        "cooling_system_temperature_celsius",
        "alignment_accuracy_mm",
        "vacuum_pressure_kpa",
        "cell_voltage_uniformity_ratio",
        "insulation_resistance_mohm",
        "leakage_current_ma",
        "operation_time_hours",
        "batteries_produced",
        "electrode_wear_percent",
    ),
    counter="batteries_produced",
    model_inputs=(
        "welding_current_amps",
        "welding_voltage_volts",
        "electrode_temperature_celsius",
        "cooling_system_temperature_celsius",
        "alignment_accuracy_mm",
        "vacuum_pressure_kpa",
        "cell_voltage_uniformity_ratio",
        "insulation_resistance_mohm",
        "leakage_current_ma",
        "electrode_wear_percent",
        "operation_time_hours",
        "batteries_produced",
    ),
    lagged=(
        "welding_current_amps",
        "welding_voltage_volts",
        "electrode_temperature_celsius",
        "cooling_system_temperature_celsius",
        "alignment_accuracy_mm",
        "vacuum_pressure_kpa",
        "cell_voltage_uniformity_ratio",
        "insulation_resistance_mohm",
        "leakage_current_ma",
        "electrode_wear_percent",
    ),
    derived=(
        Derived("current_voltage_ratio", "welding_current_amps", "welding_voltage_volts", 0.1, 0.1),
        Derived("electrode_wear_per_hour", "electrode_wear_percent", "operation_time_hours", 0.1, 0.1),
        Derived("temp_diff", "electrode_temperature_celsius - cooling_system_temperature_celsius"),
        Derived(
            "electrical_stability",
            "cell_voltage_uniformity_ratio * insulation_resistance_mohm",
            "leakage_current_ma",
            0.001,
            0.001,
        ),
    ),
    key_features=(
        "welding_current_amps",
        "welding_voltage_volts",
        "electrode_temperature_celsius",
        "cooling_system_temperature_celsius",
        "alignment_accuracy_mm",
        "vacuum_pressure_kpa",
        "cell_voltage_uniformity_ratio",
        "insulation_resistance_mohm",
        "leakage_current_ma",
        "electrode_wear_percent",
        "time_since_maintenance",
    ),
    top_features=20,
)

FAMILIES: dict[str, Family] = {f.name: f for f in (ARM_ROBOT, CNC_MACHINE, INJECTION_MOLDING, BATTERY_ASSEMBLY)}

STAR_TABLES = (
    "fact_service_records",
    "dim_dealer",
    "dim_vehicle",
    "dim_customer",
    "dim_services_performed",
    "dim_parts_used",
)

CHANGE_TOPIC = "source.public.logistics"
CHANGE_COLUMNS = ("id", "created_at", "name", "stock", "is_created", "is_updated", "is_deleted")

PREDICTION_COLUMNS = ("prediction_timestamp", "machine_id", "machine_type", "failure_probability", "risk_level")
# End of fixed values.

SENSOR_KEY = ("timestamp", "machine_id")

LOGISTICS_ROW = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("stock", T.IntegerType()),
        T.StructField("created_at", T.LongType()),
    ]
)

CHANGE_EVENT = T.StructType([T.StructField("before", LOGISTICS_ROW), T.StructField("after", LOGISTICS_ROW)])

PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("prediction_timestamp", T.StringType()),
        T.StructField("machine_id", T.StringType()),
        T.StructField("machine_type", T.StringType()),
        T.StructField("failure_probability", T.FloatType()),
        T.StructField("risk_level", T.StringType()),
    ]
)

# A service record as it arrives.
SERVICE_RECORD = (
    "service_record_id string, "
    "dealer struct<dealer_id:string,dealer_name:string,dealer_location:string>, "
    "vehicle struct<vin:string,model:string,year:int,odometer_reading:int>, "
    "service_details struct<service_date:string,service_advisor_name:string,total_cost:double,"
    "services_performed:array<struct<service_code:string,service_name:string,service_cost:double,technician_notes:string>>,"
    "parts_used:array<struct<part_code:string,part_name:string,quantity:int,unit_cost:double>>>, "
    "customer struct<customer_id:string,customer_name:string>"
)
