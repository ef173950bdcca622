"""Projections, predicates, scalar expressions and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadtime.checks import fixtures as fx
from leadtime.checks.fixtures import sql
from leadtime.checks.registry import query, r
from leadtime.functions import scalars as S
from leadtime.operators import clean, domain, faults as flt
from leadtime.operators.asof import family_rows


@query("prj_1_select_present", "SELECT o_orderkey, o_totalprice FROM orders")
def _(spark, sf):
    return clean.select_present(fx.table(spark, sf, "orders"), ["o_orderkey", "o_weight", "o_totalprice"])[0]


@query("prj_2_feature_columns", sql("""SELECT count(s_click) AS s_click, count(s_error) AS s_error,
    count(s_purchase) AS s_purchase, count(s_signup) AS s_signup, count(s_view) AS s_view, count(*) AS n_events
    FROM fx_telemetry""", "fx_telemetry"))
def _(spark, sf):
    lab = fx.labelled(spark, sf)
    return lab.agg(*[F.count(c).alias(c) for c in clean.feature_columns(lab)])


@query("prj_3_common_columns", """SELECT l_orderkey AS orderkey, l_extendedprice AS price, 'lineitem' AS source FROM lineitem
    UNION ALL SELECT o_orderkey, o_totalprice, 'orders' FROM orders""")
def _(spark, sf):
    a = fx.table(spark, sf, "lineitem").withColumnsRenamed({"l_orderkey": "orderkey", "l_extendedprice": "price"})
    b = fx.table(spark, sf, "orders").withColumnsRenamed({"o_orderkey": "orderkey", "o_totalprice": "price"})
    left, right = clean.align(a, b)
    return left.withColumn("source", F.lit("lineitem")).unionByName(right.withColumn("source", F.lit("orders")))


@query("prj_4_model_inputs", sql("""SELECT entity_id, ts, round(coalesce(s_click, 0), 6) AS s_click, 0.0::DOUBLE AS s_other
    FROM fx_telemetry""", "fx_telemetry"))
def _(spark, sf):
    tel = fx.telemetry(spark, sf).select("entity_id", "ts", "s_click")
    return clean.with_model_inputs(tel, ["s_click", "s_other"]).withColumn("s_click", r("s_click"))


@query("flt_1_stop_or_warning", sql("SELECT event_id, status FROM fx_status WHERE status IN ('Stop', 'Warning')", "fx_status"))
def _(spark, sf):
    return flt.critical_events(fx.status(spark, sf)).select("event_id", "status")


@query("flt_2_excluded_codes", sql("SELECT event_id, code FROM fx_status WHERE code NOT BETWEEN 90 AND 99", "fx_status"))
def _(spark, sf):
    return flt.drop_codes(fx.status(spark, sf), fx.excluded(spark)).select("event_id", "code")


@query("flt_3_as_of", sql("""SELECT entity_id, ts, family, code FROM fx_faults
    WHERE event_ts <= TIMESTAMP '2024-01-20 12:00:00'""", "fx_faults"))
def _(spark, sf):
    as_of = F.lit("2024-01-20 12:00:00").cast("timestamp")
    return flt.extract_faults(fx.status(spark, sf), fx.families(spark), fx.excluded(spark), as_of).select(
        "entity_id", "ts", "family", "code")


@query("flt_4_targets_only", sql("""SELECT event_id, time_bucket(INTERVAL '10 minutes', event_ts) AS ts, code FROM fx_status
    WHERE code IN (1, 2, 11, 12, 21, 22, 31, 32)""", "fx_status"))
def _(spark, sf):
    flagged = flt.flag_targets(fx.status(spark, sf), fx.families(spark))
    return flagged.where("is_failure_target").select("event_id", "ts", "code")


@query("flt_5_after_fault", sql("""SELECT entity_id, family, ts, round(hours_to, 6) AS hours_to, is_pre FROM fx_last
    WHERE NOT excluded""", "fx_last"))
def _(spark, sf):
    rows = [family_rows(fx.labelled(spark, sf), f.name) for f in fx.FAMILIES]
    return reduce(DataFrame.unionByName, [x.select("entity_id", "family", "ts", r("hours_to").alias("hours_to"), "is_pre") for x in rows])


@query("flt_6_with_target", sql("SELECT entity_id, family, ts, round(hours_to, 6) AS hours_to FROM fx_nearest WHERE hours_to IS NOT NULL",
                                "fx_nearest"))
def _(spark, sf):
    return fx.labels(spark, sf, "nearest").dropna(subset=["hours_to"]).select(
        "entity_id", "family", "ts", r("hours_to").alias("hours_to"))


@query("sc_1_target_flag", sql("""SELECT event_id, coalesce(code IN (1, 2, 11, 12, 21, 22, 31, 32), false) AS is_failure_target
    FROM fx_status""", "fx_status"))
def _(spark, sf):
    return flt.flag_targets(fx.status(spark, sf), fx.families(spark)).select("event_id", "is_failure_target")


@query("sc_2_floor_ten_minutes", "SELECT event_id, time_bucket(INTERVAL '10 minutes', ts) AS ts FROM events")
def _(spark, sf):
    return fx.table(spark, sf, "events").select("event_id", S.floor_ts("ts").alias("ts"))


@query("sc_3_shift_years", "SELECT o_orderkey, o_orderdate + INTERVAL 8 YEAR AS shifted FROM orders")
def _(spark, sf):
    return fx.table(spark, sf, "orders").select("o_orderkey", S.shift_years("o_orderdate", 8).alias("shifted"))


@query("sc_4_shift_year_text", """SELECT event_id, CASE WHEN event_type = 'view' THEN '-' ELSE
    (year(ts) + 8)::VARCHAR || strftime(ts, '-%m-%d %H:%M:%S') END AS text FROM events""")
def _(spark, sf):
    text = F.when(F.col("event_type") == "view", "-").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return fx.table(spark, sf, "events").select("event_id", S.shift_year_text(text, 8).alias("text"))


@query("sc_5_tolerant_parse", """SELECT event_id, CASE WHEN event_type <> 'view' THEN date_trunc('second', ts)::TIMESTAMP END AS at
    FROM events""")
def _(spark, sf):
    text = F.when(F.col("event_type") == "view", "-").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return fx.table(spark, sf, "events").select("event_id", S.parse_ts(text).alias("at"))


@query("sc_6_calendar", """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M') AS label, month(ts)::INT AS month,
    date_trunc('day', ts)::TIMESTAMP AS day FROM events""")
def _(spark, sf):
    return fx.table(spark, sf, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm").alias("label"), F.month("ts").alias("month"),
        F.date_trunc("day", "ts").alias("day"))


_SC = {
    "sc_7_angle_error": [("yaw_error", "least(abs(nacelle_position - wind_direction) % 360, 360 - abs(nacelle_position - wind_direction) % 360)")],
    "sc_8_products_and_ratios": [
        ("yaw_error_wind", "least(abs(nacelle_position - wind_direction) % 360, 360 - abs(nacelle_position - wind_direction) % 360) * wind_speed_ms"),
        ("nacelle_std_ratio", "nacelle_position_standard_deviation / (wind_speed_ms + 1e-6)"),
        ("reactive_power_ratio", "reactive_power_kvar / (sqrt(power_kw ** 2 + reactive_power_kvar ** 2) + 1e-6)"),
        ("pressure_vs_temp", "gear_oil_inlet_pressure_bar / (gear_oil_inlet_temperature_c + 273.15::DOUBLE)")],
    "sc_9_differences": [(n, f"{a} - {b}") for n, a, b in domain.DIFFERENCES],
    "sc_10_apparent_power": [("apparent_power_kva", "sqrt(power_kw ** 2 + reactive_power_kvar ** 2)")],
    "sc_11_row_spread": [("pitch_asymmetry", "list_max({b}) - list_min({b})")],
    "sc_12_row_mean": [("blade_angle_mean", "list_avg({b})")],
    "sc_13_row_std": [("motor_current_imbalance", "list_stddev_samp({m})")],
}
_LISTS = {"b": "[" + ", ".join(domain.BLADE_ANGLES) + "]", "m": "[" + ", ".join(domain.MOTOR_CURRENTS) + "]"}


def _scalar(name, columns):
    body = ", ".join(f"round({expr.format(**_LISTS)}, 6) + 0.0 AS {c}" for c, expr in columns)

    @query(name, sql(f"SELECT entity_id, ts, {body} FROM fx_scada", "fx_scada"))
    def _(spark, sf):
        df = fx.scada(spark, sf)
        for c, expr in domain.reading_features().items():
            df = df.withColumn(c, expr)
        return df.select("entity_id", "ts", *[r(c).alias(c) for c, _ in columns])


for _name, _columns in _SC.items():
    _scalar(_name, _columns)


@query("sc_14_log_hours", sql("""SELECT entity_id, family, ts, round(ln(1 + hours_to), 6) AS log_hours FROM fx_last""", "fx_last"))
def _(spark, sf):
    return fx.labels(spark, sf).select("entity_id", "family", "ts", r(F.log1p("hours_to")).alias("log_hours"))


@query("sc_15_clip_round_alert", sql("""SELECT entity_id, family, ts, round(greatest(0, least(pred_h * 2, lead_hours)), 1) AS pred_h,
    greatest(0, least(pred_h * 2, lead_hours)) <= alert_h AS alert FROM fx_scored""", "fx_scored"))
def _(spark, sf):
    raw = S.clip(F.col("pred_h") * 2, 0, fx.lead())
    return fx.scored(spark, sf).select("entity_id", "family", "ts", F.round(raw, 1).alias("pred_h"),
                                       (raw <= fx.alert_h()).alias("alert"))


@query("sc_16_alert_score", sql("""SELECT entity_id, family, ts, round(1 - (pred_h + 3e-7) / lead_hours, 3) + 0.0 AS alert_score
    FROM fx_scored""", "fx_scored"))
def _(spark, sf):
    """Predictions are moved off the exact half steps, where two engines may round apart."""
    return fx.scored(spark, sf).select("entity_id", "family", "ts", (
        S.alert_score(F.col("pred_h") + 3e-7, fx.lead()) + F.lit(0.0)).alias("alert_score"))


@query("sc_17_missing", sql("""SELECT count(*) FILTER (WHERE s_click IS NULL OR s_click > 100) AS n_missing,
    count(*) FILTER (WHERE s_click <= 100) AS n_known FROM fx_telemetry""", "fx_telemetry"))
def _(spark, sf):
    """Readings above 100 are set to NaN, absent ones are NULL; both are missing."""
    c = F.when(F.col("s_click") > 100, float("nan")).otherwise(F.col("s_click"))
    return fx.telemetry(spark, sf).select(c.alias("c")).agg(
        F.count_if(S.missing("c")).alias("n_missing"), F.count(S.nan_to_null("c")).alias("n_known"))


@query("map_1_code_to_family", sql("""SELECT event_id, coalesce(CASE WHEN code IN (1, 2) THEN 'yaw_cable' WHEN code IN (11, 12)
    THEN 'generator' WHEN code IN (21, 22) THEN 'brake_hydro' WHEN code IN (31, 32) THEN 'pitch_bat' END, 'other') AS family
    FROM fx_status""", "fx_status"))
def _(spark, sf):
    return flt.map_family(fx.status(spark, sf), fx.families(spark), other="other").select("event_id", "family")


@query("set_1_union_drift", """SELECT o_orderkey AS k, o_totalprice AS price, NULL::DOUBLE AS tax FROM orders
    UNION ALL SELECT l_orderkey, l_extendedprice, l_tax FROM lineitem UNION ALL SELECT c_custkey, c_acctbal, NULL FROM customer""")
def _(spark, sf):
    frames = [
        fx.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price")),
        fx.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_extendedprice").alias("price"),
                                               F.col("l_tax").alias("tax")),
        fx.table(spark, sf, "customer").select(F.col("c_acctbal").alias("price"), F.col("c_custkey").alias("k"))]
    return clean.union_drift(frames)


@query("set_2_concat_sources", sql("""SELECT CASE entity_id % 2 WHEN 1 THEN 'donor' ELSE 'target' END AS source, count(*) AS n
    FROM fx_telemetry GROUP BY 1""", "fx_telemetry"))
def _(spark, sf):
    from leadtime.operators.models import stack_sources
    tel = fx.telemetry(spark, sf)
    both = stack_sources(tel.where("entity_id % 2 = 1"), tel.where("entity_id % 2 = 0"))
    return both.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query("set_3_intersect_times", sql("""SELECT entity_id, ts FROM fx_instants INTERSECT
    SELECT entity_id, ts FROM fx_telemetry WHERE s_click IS NOT NULL""", "fx_instants", "fx_telemetry"))
def _(spark, sf):
    tel = fx.telemetry(spark, sf).where("s_click IS NOT NULL").select("entity_id", "ts")
    return fx.faults(spark, sf).select("entity_id", "ts").intersect(tel)


@query("set_4_distinct_on", """SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order,
    arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order FROM orders GROUP BY 1""")
def _(spark, sf):
    from leadtime.sources.sinks import distinct_on
    orders = fx.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    first = distinct_on(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    last = distinct_on(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "last")
    return first.select("o_custkey", F.col("o_orderkey").alias("first_order")).join(
        last.select("o_custkey", F.col("o_orderkey").alias("last_order")), "o_custkey")
