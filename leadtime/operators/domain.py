"""Physical features of a reading and of its neighbours in time."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadtime.functions import scalars as S
from leadtime.plans.series import CHUNK_ROWS, number_rows, with_halo


@dataclass(frozen=True)
class Step:
    """Change over ``rows`` rows; ``fill`` replaces a missing change, ``floor`` bounds it below."""

    name: str
    column: str
    rows: int
    fill: float | None = None
    floor: float | None = None


# --- Fixed values: names and inputs of the domain features --------------------
DIFFERENCES = (
    ("t_bearing_delta", "generator_bearing_front_temperature_c", "nacelle_ambient_temperature_c"),
    ("t_rear_bearing_delta", "generator_bearing_rear_temperature_c", "nacelle_ambient_temperature_c"),
    ("t_stator_delta", "stator_temperature_1_c", "nacelle_ambient_temperature_c"),
    ("t_gear_oil_delta", "gear_oil_temperature_c", "nacelle_ambient_temperature_c"),
    ("t_bearing_diff", "generator_bearing_front_temperature_c", "generator_bearing_rear_temperature_c"),
    ("t_stator_bearing_diff", "stator_temperature_1_c", "generator_bearing_front_temperature_c"),
    ("t_motor1_vs_ambient", "temperature_motor_axis_1_c", "nacelle_ambient_temperature_c"),
    ("t_motor2_vs_ambient", "temperature_motor_axis_2_c", "nacelle_ambient_temperature_c"),
    ("t_motor3_vs_ambient", "temperature_motor_axis_3_c", "nacelle_ambient_temperature_c"),
)
BLADE_ANGLES = ("blade_angle_pitch_position_a", "blade_angle_pitch_position_b",
                "blade_angle_pitch_position_c")
MOTOR_CURRENTS = ("motor_current_axis_1_a", "motor_current_axis_2_a", "motor_current_axis_3_a")
STEPS = (
    Step("cable_rate", "cable_windings_from_calibration_point", 1, fill=0.0),
    Step("metal_particle_rate", "metal_particle_count", 1, fill=0.0, floor=0.0),
    Step("t_bearing_delta_roc", "t_bearing_delta", 6),
    Step("t_stator_roc", "stator_temperature_1_c", 6),
)
# --- end of fixed values ------------------------------------------------------


def reading_features() -> dict[str, Column]:
    """Features of a single reading; later entries may use earlier ones."""
    out: dict[str, Column] = {
        "yaw_error": S.angle_error("nacelle_position", "wind_direction"),
        "yaw_error_wind": F.col("yaw_error") * F.col("wind_speed_ms"),
        "nacelle_std_ratio": S.safe_ratio("nacelle_position_standard_deviation", "wind_speed_ms", 1e-6),
        "apparent_power_kva": F.hypot("power_kw", "reactive_power_kvar"),
        "reactive_power_ratio": S.safe_ratio("reactive_power_kvar", "apparent_power_kva", 1e-6),
        "pressure_vs_temp": S.safe_ratio("gear_oil_inlet_pressure_bar", "gear_oil_inlet_temperature_c",
                                         273.15),
        "pitch_asymmetry": S.row_spread(BLADE_ANGLES),
        "blade_angle_mean": S.row_mean(BLADE_ANGLES),
        "motor_current_imbalance": S.row_std(MOTOR_CURRENTS),
    }
    out.update({name: F.col(a) - F.col(b) for name, a, b in DIFFERENCES})
    return out


def add_steps(df: DataFrame, steps: Sequence[Step], by: Sequence[str] = ("entity_id",),
              time: str = "ts", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Differences to the row ``k`` rows earlier, over chunks with a halo of ``max(k)`` rows."""
    numbered = "row_no" in df.columns
    rows = df if numbered else number_rows(df, by, time)
    pieces = with_halo(rows, before=max(s.rows for s in steps), chunk_rows=chunk_rows)
    order = Window.partitionBy(*by, "chunk").orderBy("row_no")
    added = {}
    for s in steps:
        change = F.col(s.column) - F.lag(s.column, s.rows).over(order)
        if s.fill is not None:
            change = F.coalesce(change, F.lit(s.fill))
        if s.floor is not None:
            change = F.when(change.isNotNull(), F.greatest(change, F.lit(s.floor)))
        added[s.name] = change
    out = pieces.withColumns(added).where("own").drop("chunk", "own")
    return out if numbered else out.drop("row_no")


def add_domain_features(df: DataFrame, by: Sequence[str] = ("entity_id",), time: str = "ts",
                        chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """All domain features. NaN must have been turned into NULL before."""
    for name, expr in reading_features().items():
        df = df.withColumn(name, expr)
    return add_steps(df, STEPS, by, time, chunk_rows)


def confirm_consecutive(df: DataFrame, condition: Column, k: int, by: Sequence[str] = ("entity_id",),
                        time: str = "ts", out: str = "confirmed", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """True where the condition holds for ``k`` consecutive rows ending here."""
    rows = df if "row_no" in df.columns else number_rows(df, by, time)
    pieces = with_halo(rows.withColumn("_hit", F.coalesce(condition, F.lit(False)).cast("int")),
                       before=max(k - 1, 0), chunk_rows=chunk_rows)
    frame = Window.partitionBy(*by, "chunk").orderBy("row_no").rowsBetween(-(k - 1), 0)
    held = (F.min("_hit").over(frame) == 1) & (F.col("row_no") >= k)
    out_df = pieces.withColumn(out, held).where("own").drop("chunk", "own", "_hit")
    return out_df if "row_no" in df.columns else out_df.drop("row_no")
