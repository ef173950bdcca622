"""The given tables seen as telemetry, status log, faults and predictions.

Every view exists twice: as a DataFrame and as a SQL common table expression with the same name.
The event density of the tables calls for shorter hours than production uses; the trees are those of production.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadtime import config
from leadtime.functions.scalars import clip, floor_ts
from leadtime.operators import asof, faults as flt
from leadtime.plans.lineage import materialize

_TREES = {f.name: (f.leaves, f.min_child) for f in config.FAMILIES}
FAMILIES = (
    config.Family("yaw_cable", 4, 2, 2, 1, *_TREES["yaw_cable"]),
    config.Family("generator", 6, 3, 3, 3, *_TREES["generator"]),
    config.Family("brake_hydro", 6, 3, 3, 1, *_TREES["brake_hydro"]),
    config.Family("pitch_bat", 12, 6, 6, 5, *_TREES["pitch_bat"]),
)
FAMILY_CODES = {"yaw_cable": (1, 2), "generator": (11, 12), "brake_hydro": (21, 22), "pitch_bat": (31, 32)}
EXCLUDED = tuple(range(90, 100))
EXCLUSION_H, GAP_H, MATCH_H, CEILING = 1, 2, 6, 12
SENSORS = ("s_click", "s_error", "s_purchase", "s_signup", "s_view")
BASELINE_DAYS = 10
BLOCK_DAYS = 3
CHUNK = 2000

# raw readings with the names the domain features expect: (name, sensor, factor, shift)
READINGS = (
    ("nacelle_position", "s_click", 2.0, 0.0),
    ("wind_direction", "s_view", 3.0, 0.0),
    ("wind_speed_ms", "s_signup", 0.1, 0.0),
    ("cable_windings_from_calibration_point", "s_error", 0.5, 0.0),
    ("nacelle_position_standard_deviation", "s_error", 0.25, 0.0),
    ("generator_bearing_front_temperature_c", "s_click", 0.5, 20.0),
    ("generator_bearing_rear_temperature_c", "s_purchase", 0.5, 20.0),
    ("nacelle_ambient_temperature_c", "s_view", 0.25, 0.0),
    ("stator_temperature_1_c", "s_signup", 0.5, 30.0),
    ("gear_oil_temperature_c", "s_error", 0.25, 10.0),
    ("power_kw", "s_purchase", 8.0, 0.0),
    ("reactive_power_kvar", "s_view", 2.0, 0.0),
    ("gear_oil_inlet_pressure_bar", "s_click", 0.125, 0.0),
    ("gear_oil_inlet_temperature_c", "s_error", 0.25, 0.0),
    ("metal_particle_count", "s_purchase", 1.0, 0.0),
    ("temperature_motor_axis_1_c", "s_click", 0.25, 0.0),
    ("temperature_motor_axis_2_c", "s_error", 0.25, 0.0),
    ("temperature_motor_axis_3_c", "s_signup", 0.25, 0.0),
    ("blade_angle_pitch_position_a", "s_click", 0.5, 0.0),
    ("blade_angle_pitch_position_b", "s_purchase", 0.5, 0.0),
    ("blade_angle_pitch_position_c", "s_view", 0.5, 0.0),
    ("motor_current_axis_1_a", "s_error", 0.5, 0.0),
    ("motor_current_axis_2_a", "s_signup", 0.5, 0.0),
    ("motor_current_axis_3_a", "s_view", 0.25, 0.0),
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    return df.select(*[F.col(c).cast("timestamp").alias(c) if t == "timestamp_ntz" else F.col(c)
                       for c, t in df.dtypes])


def with_entity(df: DataFrame) -> DataFrame:
    return df.withColumn("entity_id", (
        F.col("user_id") % 2 + 2 * F.floor(F.col("user_id") / 150) + 1).cast("int"))


def telemetry(spark: SparkSession, sf: str) -> DataFrame:
    ev = with_entity(table(spark, sf, "events"))
    return ev.groupBy("entity_id", floor_ts("ts").alias("ts")).agg(
        *[F.avg(F.when(F.col("event_type") == s[2:], F.col("value"))).alias(s) for s in SENSORS],
        F.count(F.lit(1)).alias("n_events"))


def scada(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry(spark, sf).select(
        "entity_id", "ts", *[(F.col(s) * f + d).alias(n) for n, s, f, d in READINGS])


def status(spark: SparkSession, sf: str) -> DataFrame:
    ev = with_entity(table(spark, sf, "events"))
    kind = F.col("event_type")
    code = F.get_json_object("props", "$.k").cast("int")
    return ev.select(
        "entity_id", F.col("ts").alias("event_ts"), "event_id", code.alias("code"),
        F.when(kind == "error", "Stop").when(kind == "signup", "Warning")
        .when(kind == "view", "Informational").otherwise("Communication").alias("status"),
        F.concat(F.lit("code "), code.cast("string")).alias("message"))


def families(spark: SparkSession) -> DataFrame:
    return config.code_table(spark, FAMILY_CODES)


def excluded(spark: SparkSession) -> DataFrame:
    return config.excluded_table(spark, EXCLUDED)


def floors(spark: SparkSession) -> DataFrame:
    return config.family_table(spark, FAMILIES).select("family", "floor_h")


def faults(spark: SparkSession, sf: str) -> DataFrame:
    return flt.extract_faults(status(spark, sf), families(spark), excluded(spark))


def by_family(values: dict[str, float]):
    out = F.lit(None).cast("double")
    for name, v in values.items():
        out = F.when(F.col("family") == name, F.lit(float(v))).otherwise(out)
    return out


def lead():
    return by_family({f.name: f.lead_hours for f in FAMILIES})


def alert_h():
    return by_family({f.name: f.alert_h for f in FAMILIES})


def labelled(spark, sf, mode="last", exclude=EXCLUSION_H) -> DataFrame:
    return asof.label_hours_to_fault(telemetry(spark, sf), faults(spark, sf), FAMILIES, mode=mode,
                                     exclude_after_hours=exclude, days=BLOCK_DAYS)


def labels(spark, sf, mode="last", exclude=EXCLUSION_H, keep=("entity_id", "ts")) -> DataFrame:
    return asof.long_labels(labelled(spark, sf, mode, exclude), FAMILIES, keep)


def predictions(spark, sf) -> DataFrame:
    rows = telemetry(spark, sf).select("entity_id", "ts", "s_click", F.explode(F.array(
        *[F.lit(f.name) for f in FAMILIES])).alias("family"))
    return rows.select("entity_id", "family", "ts", F.round(
        F.least(lead(), F.coalesce("s_click", F.lit(100.0)) / 10), 6).alias("pred_h"))


def scored(spark, sf) -> DataFrame:
    rows = labels(spark, sf, keep=("entity_id", "ts", *SENSORS)).where(~F.col("excluded"))
    return rows.select(
        "entity_id", "family", "ts", "hours_to", "is_pre", *SENSORS,
        F.round(clip(F.coalesce("s_view", F.lit(100.0)) / 10, 0, lead()), 6).alias("raw_h"),
        F.round(clip(F.coalesce("s_click", F.lit(100.0)) / 10, 0, lead()), 6).alias("pred_h"),
        F.round(clip(F.coalesce("s_error", F.lit(0.0)) / 200, 0, 1), 6).alias("score"))


def scored_table(spark, sf) -> DataFrame:
    """Scored rows as the stored table they are in production, for reports that read them repeatedly."""
    return materialize(scored(spark, sf), "scored")


_SENSOR_SQL = ", ".join(f"avg(value) FILTER (WHERE event_type = '{s[2:]}') AS {s}" for s in SENSORS)
_ENTITY_SQL = "CAST(user_id % 2 + 2 * (user_id // 150) + 1 AS INTEGER)"
_MAP = " ".join(f"WHEN code IN ({a}, {b}) THEN '{n}'" for n, (a, b) in FAMILY_CODES.items())
_CONFIG = ", ".join(f"('{f.name}', {float(f.lead_hours)}::DOUBLE, {float(f.alert_h)}::DOUBLE, {f.floor_h})"
                    for f in FAMILIES)
_READ_SQL = ", ".join(f"{s} * {f}::DOUBLE + {d}::DOUBLE AS {n}" for n, s, f, d in READINGS)

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "fx_config": ((), f"SELECT * FROM (VALUES {_CONFIG}) v(family, lead_hours, alert_h, floor_h)"),
    "fx_telemetry": ((), f"""SELECT {_ENTITY_SQL} AS entity_id, time_bucket(INTERVAL '10 minutes', ts) AS ts,
        {_SENSOR_SQL}, count(*) AS n_events FROM events GROUP BY 1, 2"""),
    "fx_scada": (("fx_telemetry",), f"SELECT entity_id, ts, {_READ_SQL} FROM fx_telemetry"),
    "fx_status": ((), f"""SELECT {_ENTITY_SQL} AS entity_id, ts AS event_ts, event_id,
        CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS code,
        CASE event_type WHEN 'error' THEN 'Stop' WHEN 'signup' THEN 'Warning'
             WHEN 'view' THEN 'Informational' ELSE 'Communication' END AS status,
        'code ' || regexp_extract(props, '[0-9]+') AS message FROM events"""),
    "fx_critical": (("fx_status",), f"""SELECT *, CASE {_MAP} END AS family,
        time_bucket(INTERVAL '10 minutes', event_ts) AS ts FROM fx_status
        WHERE status IN ('Stop', 'Warning') AND code NOT BETWEEN 90 AND 99"""),
    "fx_faults": (("fx_critical",), """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY entity_id, code, ts ORDER BY event_ts, event_id) AS rn
        FROM fx_critical WHERE family IS NOT NULL) WHERE rn = 1"""),
    "fx_instants": (("fx_faults",), "SELECT DISTINCT entity_id, family, ts FROM fx_faults"),
    "fx_own": (("fx_instants",), """SELECT entity_id, family, ts FROM fx_instants
        WHERE entity_id % 2 = 0 AND family IN ('yaw_cable', 'generator')"""),
    "fx_rows": (("fx_telemetry", "fx_config"), "SELECT * FROM fx_telemetry CROSS JOIN fx_config"),
    "fx_prev": (("fx_rows", "fx_instants"), """SELECT r.entity_id, r.family, r.ts, f.ts AS prev_ts
        FROM fx_rows r ASOF LEFT JOIN fx_instants f
        ON r.entity_id = f.entity_id AND r.family = f.family AND r.ts >= f.ts"""),
    "fx_next": (("fx_rows", "fx_instants"), """SELECT r.entity_id, r.family, r.ts, f.ts AS next_ts
        FROM fx_rows r ASOF LEFT JOIN fx_instants f
        ON r.entity_id = f.entity_id AND r.family = f.family AND r.ts < f.ts"""),
    "fx_cover": (("fx_rows", "fx_instants"), """SELECT r.entity_id, r.family, r.ts, max(f.ts) AS cover_ts
        FROM fx_rows r LEFT JOIN fx_instants f
        ON r.entity_id = f.entity_id AND r.family = f.family AND f.ts > r.ts
        AND f.ts <= r.ts + to_seconds(r.lead_hours * 3600) GROUP BY ALL"""),
    "fx_nearest": (("fx_rows", "fx_next", "fx_prev"), f"""SELECT r.*,
        CASE WHEN (epoch_us(n.next_ts) - epoch_us(r.ts)) / 3.6e9 <= r.lead_hours
             THEN (epoch_us(n.next_ts) - epoch_us(r.ts)) / 3.6e9 END AS hours_to,
        hours_to IS NOT NULL AS is_pre,
        coalesce((epoch_us(r.ts) - epoch_us(p.prev_ts)) / 3.6e9 < {EXCLUSION_H}, false) AS excluded
        FROM fx_rows r JOIN fx_next n USING (entity_id, family, ts) JOIN fx_prev p USING (entity_id, family, ts)"""),
    "fx_last": (("fx_rows", "fx_cover", "fx_prev"), f"""SELECT r.*,
        coalesce((epoch_us(c.cover_ts) - epoch_us(r.ts)) / 3.6e9, r.lead_hours) AS hours_to,
        c.cover_ts IS NOT NULL AS is_pre,
        coalesce((epoch_us(r.ts) - epoch_us(p.prev_ts)) / 3.6e9 < {EXCLUSION_H}, false) AS excluded
        FROM fx_rows r JOIN fx_cover c USING (entity_id, family, ts) JOIN fx_prev p USING (entity_id, family, ts)"""),
    "fx_predictions": (("fx_rows",), """SELECT entity_id, family, ts,
        round(least(lead_hours, coalesce(s_click, 100.0::DOUBLE) / 10), 6) AS pred_h FROM fx_rows"""),
    "fx_scored": (("fx_last",), """SELECT *,
        round(least(lead_hours, coalesce(s_view, 100.0::DOUBLE) / 10), 6) AS raw_h,
        round(least(lead_hours, coalesce(s_click, 100.0::DOUBLE) / 10), 6) AS pred_h,
        round(least(1.0::DOUBLE, coalesce(s_error, 0.0::DOUBLE) / 200), 6) AS score
        FROM fx_last WHERE NOT excluded"""),
    "fx_clusters": (("fx_instants",), f"""SELECT entity_id, family, ts FROM (SELECT *,
        lag(ts) OVER (PARTITION BY entity_id, family ORDER BY ts) AS p FROM fx_instants)
        WHERE p IS NULL OR epoch_us(ts) - epoch_us(p) > {GAP_H} * 3600000000"""),
    "fx_late_predictions": (("fx_predictions",), "SELECT * FROM fx_predictions WHERE entity_id % 2 = 0 OR ts >= TIMESTAMP '2024-01-15'"),
    "fx_late_config": (("fx_config",), """SELECT * REPLACE (CASE WHEN family = 'yaw_cable' THEN 0 ELSE floor_h END AS floor_h),
        family = 'yaw_cable' AS floor_missing FROM fx_config"""),
    "fx_late_clusters": (("fx_clusters", "fx_late_predictions"), """SELECT c.* FROM fx_clusters c JOIN (SELECT entity_id, family,
        date_trunc('day', min(ts)) AS since FROM fx_late_predictions GROUP BY 1, 2) USING (entity_id, family) WHERE c.ts >= since"""),
    "fx_ranked": (("fx_scored",), """SELECT entity_id, family, is_pre, score,
        row_number() OVER (PARTITION BY entity_id, family ORDER BY ts) AS k,
        count(*) OVER (PARTITION BY entity_id, family) AS n FROM fx_scored"""),
    "fx_starts": (("fx_scored",), """SELECT entity_id, family, ts AS event_start, lead_hours, alert_h FROM (
        SELECT *, lag(is_pre, 1, false) OVER (PARTITION BY entity_id, family ORDER BY ts) AS p FROM fx_scored)
        WHERE is_pre AND NOT p"""),
    "fx_windows": (("fx_starts",), """SELECT s.entity_id, s.family, s.event_start, s.alert_h,
        min(x.pred_h) AS best_score, max(x.score) AS max_score FROM fx_starts s JOIN fx_scored x
        ON x.entity_id = s.entity_id AND x.family = s.family AND x.ts >= s.event_start
        AND x.ts < s.event_start + to_seconds(s.lead_hours * 3600) GROUP BY ALL"""),
    "fx_filled": (("fx_telemetry",), "SELECT entity_id, ts, row_number() OVER w AS row_no, " + ", ".join(
        f"coalesce(last_value({s} IGNORE NULLS) OVER w, 0) AS {s}" for s in SENSORS) +
        " FROM fx_telemetry WINDOW w AS (PARTITION BY entity_id ORDER BY ts ROWS UNBOUNDED PRECEDING)"),
    "fx_baseline": (("fx_telemetry",), f"""SELECT entity_id, sensor, round(avg(value), 6) AS mean,
        round(quantile_cont(value, 0.9), 6) AS p90, count(*) AS n_rows FROM (
        SELECT * FROM ((SELECT entity_id, ts, {", ".join(SENSORS)} FROM fx_telemetry)
        UNPIVOT INCLUDE NULLS (value FOR sensor IN ({", ".join(SENSORS)}))) u
        JOIN (SELECT entity_id, min(ts) + INTERVAL {BASELINE_DAYS} DAY AS til FROM fx_telemetry GROUP BY 1)
        USING (entity_id) WHERE ts < til) GROUP BY 1, 2"""),
    "fx_curve": (("fx_scored",), """SELECT family, threshold, tp, fp,
        tp / (tp + fp) AS precision, tp / max(tp) OVER (PARTITION BY family) AS recall FROM (
        SELECT family, score AS threshold,
        sum(count(*) FILTER (WHERE is_pre)) OVER w AS tp, sum(count(*) FILTER (WHERE NOT is_pre)) OVER w AS fp
        FROM fx_scored GROUP BY family, score WINDOW w AS (PARTITION BY family ORDER BY score DESC))"""),
}


def sql(body: str, *names: str) -> str:
    """The statement with the views it needs in front of it."""
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for dep in CTES[name][0]:
                add(dep)
            order.append(name)

    for n in names:
        add(n)
    if not order:
        return body
    ctes = ", ".join(f"{n} AS ({CTES[n][1]})" for n in order)
    return f"WITH {ctes} {body}"
