"""Family parameters and catalogs.

The catalogs are ordinary data: every operator takes them as an argument, so a
site can pass its own. The defaults below are the production values.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Family:
    """Labelling horizon, alert thresholds and tree size of one fault family."""

    name: str
    lead_hours: float
    alert_h: float
    retrain_alert_h: float
    floor_h: int
    leaves: int = 63
    min_child: int = 20


# --- Fixed values: production parameters -------------------------------------
FAMILIES = (
    Family("yaw_cable", 83, 36, 48, 24, 63, 20),
    Family("generator", 127, 72, 72, 72, 63, 20),
    Family("brake_hydro", 130, 72, 72, 24, 31, 30),
    Family("pitch_bat", 295, 168, 168, 120, 63, 20),
)

WINDOWS = {"1h": 6, "6h": 36, "24h": 144, "7d": 1008}
BASELINE_DAYS = 180
BASELINE_MONTHS = 3
SPLIT_CUTS = (0.60, 0.80)
POST_FAULT_EXCLUSION_H = 24
NO_HISTORY_HOURS = 8760.0
COLD_START_HOURS = 9999.0
MATCH_WINDOW_H = 120
CLUSTER_GAP_H = 24
SWEEP_CEILING_H = 250
SWEEP_STEP_H = 2
MIN_TRAIN_EVENTS = 3
MIN_VAL_EVENTS = 1
CONTEXT_ROWS = 1008

FAULT_STATUSES = ("Stop", "Warning")

EXCLUDED_CODES = (
    # planned maintenance and functional tests
    710, 707, 5760, 5700,
    # grid and weather
    3500, 3585, 3590, 6540, 6682, 6690, 64, 68, 61, 815, 3570, 3870,
    # manual operation and clock
    20, 25, 21, 8000, 210, 7325, 7324,
    # external anemometer and vane
    6525, 6515, 6530, 6635, 6620, 6622,
    # structural or not assignable
    4510, 4520, 4530, 4540, 4500, 59, 100, 5000, 440, 2950, 7057,
)

FAMILY_CODES = {
    "yaw_cable": (6052, 6200, 6054, 6120, 6300, 6005, 6130),
    "brake_hydro": (2125, 5720, 5510, 2000, 1860, 1070, 1065, 1050, 1800, 1620),
    "generator": (3000, 2550, 2650, 2655, 2674, 3125, 8400, 3110, 3210, 2810),
    "pitch_bat": (716, 717, 718, 681, 682, 683, 785, 850, 692, 720, 725, 675),
}

SILVER_COLUMNS = (
    "timestamp",
    "wind_speed_ms", "wind_speed_standard_deviation_ms",
    "wind_speed_sensor_1_ms", "wind_speed_sensor_2_ms",
    "wind_direction", "wind_direction_standard_deviation",
    "nacelle_position", "nacelle_position_standard_deviation",
    "vane_position_12",
    "power_kw", "power_standard_deviation_kw",
    "power_factor_cosphi", "reactive_power_kvar",
    "grid_voltage_v", "grid_frequency_hz",
    "generator_rpm_rpm", "generator_rpm_standard_deviation_rpm",
    "rotor_speed_rpm",
    "drive_train_acceleration_mmss",
    "generator_bearing_front_temperature_c", "generator_bearing_rear_temperature_c",
    "generator_bearing_front_temperature_max_c", "generator_bearing_rear_temperature_max_c",
    "nacelle_temperature_c", "nacelle_temperature_max_c",
    "nacelle_ambient_temperature_c",
    "ambient_temperature_converter_c",
    "front_bearing_temperature_c", "rear_bearing_temperature_c",
    "gear_oil_temperature_c",
    "gear_oil_inlet_temperature_c",
    "stator_temperature_1_c",
    "temp_top_box_c",
    "gear_oil_inlet_pressure_bar", "gear_oil_pump_pressure_bar",
    "cable_windings_from_calibration_point",
    "blade_angle_pitch_position_a", "blade_angle_pitch_position_b", "blade_angle_pitch_position_c",
    "motor_current_axis_1_a", "motor_current_axis_2_a", "motor_current_axis_3_a",
    "temperature_motor_axis_1_c", "temperature_motor_axis_2_c", "temperature_motor_axis_3_c",
    "metal_particle_count",
)

FAMILY_SENSORS = {
    "yaw_cable": (
        "nacelle_position", "nacelle_position_standard_deviation",
        "wind_direction", "wind_direction_standard_deviation",
        "vane_position_12", "cable_windings_from_calibration_point",
        "wind_speed_ms", "power_kw",
        "yaw_error", "yaw_error_wind", "cable_rate", "nacelle_std_ratio",
    ),
    "brake_hydro": (
        "gear_oil_inlet_pressure_bar", "gear_oil_pump_pressure_bar",
        "gear_oil_inlet_temperature_c", "gear_oil_temperature_c",
        "generator_rpm_rpm", "generator_rpm_standard_deviation_rpm",
        "rotor_speed_rpm", "power_kw",
        "front_bearing_temperature_c", "rear_bearing_temperature_c",
        "metal_particle_count",
        "t_gear_oil_delta", "pressure_vs_temp", "metal_particle_rate",
    ),
    "generator": (
        "generator_bearing_front_temperature_c", "generator_bearing_rear_temperature_c",
        "generator_bearing_front_temperature_max_c", "generator_bearing_rear_temperature_max_c",
        "nacelle_temperature_c", "nacelle_ambient_temperature_c",
        "ambient_temperature_converter_c", "power_kw", "reactive_power_kvar",
        "power_factor_cosphi", "stator_temperature_1_c", "wind_speed_ms",
        "t_bearing_delta", "t_rear_bearing_delta", "t_stator_delta",
        "t_bearing_diff", "t_stator_bearing_diff",
        "apparent_power_kva", "reactive_power_ratio",
        "t_bearing_delta_roc", "t_stator_roc",
    ),
    "pitch_bat": (
        "motor_current_axis_1_a", "motor_current_axis_2_a", "motor_current_axis_3_a",
        "blade_angle_pitch_position_a", "blade_angle_pitch_position_b", "blade_angle_pitch_position_c",
        "t_motor1_vs_ambient", "t_motor2_vs_ambient", "t_motor3_vs_ambient",
        "power_kw", "wind_speed_ms",
        "pitch_asymmetry", "blade_angle_mean", "motor_current_imbalance",
    ),
}
# --- end of fixed values ------------------------------------------------------


def family_table(spark: SparkSession, families=FAMILIES) -> DataFrame:
    """Family parameters, one row per family (a dimension of a handful of rows)."""
    return spark.createDataFrame(pa.table({
        "family": [f.name for f in families],
        "lead_hours": [float(f.lead_hours) for f in families],
        "alert_h": [float(f.alert_h) for f in families],
        "retrain_alert_h": [float(f.retrain_alert_h) for f in families],
        "floor_h": pa.array([int(f.floor_h) for f in families], pa.int32()),
    }))


def code_table(spark: SparkSession, family_codes=None) -> DataFrame:
    """Fault code to family; a code listed twice belongs to the first family."""
    seen: dict[int, str] = {}
    for family, codes in (family_codes or FAMILY_CODES).items():
        for code in codes:
            seen.setdefault(int(code), family)
    return spark.createDataFrame(pa.table({
        "code": pa.array(seen.keys(), pa.int32()), "family": list(seen.values())}))


def excluded_table(spark: SparkSession, codes=EXCLUDED_CODES) -> DataFrame:
    return spark.createDataFrame(pa.table({"code": pa.array([int(c) for c in codes], pa.int32())}))
