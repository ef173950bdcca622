"""As-of, interval, semi and anti joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadtime import config
from leadtime.checks import fixtures as fx
from leadtime.checks.fixtures import sql
from leadtime.checks.registry import query, r
from leadtime.operators import asof, evaluate, faults as flt, nightly, report, review
from leadtime.operators.rolling import rolling_features

NAMES = [f.name for f in fx.FAMILIES]


@query("jn_1_grouped_with_counts", sql("""
    SELECT a.entity_id, a.ts, a.family, a.first_code, b.n_events FROM
    (SELECT entity_id, ts, family, min(code) AS first_code FROM fx_critical WHERE family IS NOT NULL GROUP BY ALL) a
    JOIN (SELECT entity_id, ts, family, count(*) AS n_events FROM fx_critical WHERE family IS NOT NULL GROUP BY ALL) b
    USING (entity_id, ts, family)""", "fx_critical"))
def _(spark, sf):
    ev = _critical(spark, sf)
    keys = ["entity_id", "ts", "family"]
    return ev.groupBy(*keys).agg(F.min("code").alias("first_code")).join(
        ev.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_events")), keys)


def _critical(spark, sf):
    ev = flt.drop_codes(flt.critical_events(fx.status(spark, sf)), fx.excluded(spark))
    return (flt.map_family(ev, fx.families(spark)).where("family IS NOT NULL")
            .withColumn("ts", fx.floor_ts("event_ts")))


_SINCE = ", ".join(f"max(h) FILTER (WHERE family = '{n}') AS h_{n}, max(l) FILTER (WHERE family = '{n}') AS l_{n}"
                   for n in NAMES)


@query("jn_2_hours_since_last", sql(f"""
    SELECT entity_id, ts, {_SINCE} FROM (
      SELECT p.entity_id, p.ts, p.family,
        round(CASE WHEN prev_ts IS NOT NULL THEN (epoch_us(p.ts) - epoch_us(prev_ts)) / 3.6e9
              WHEN k.entity_id IS NOT NULL THEN 8760.0 ELSE 9999.0 END::DOUBLE, 6) AS h,
        round(ln(1 + CASE WHEN prev_ts IS NOT NULL THEN (epoch_us(p.ts) - epoch_us(prev_ts)) / 3.6e9
              WHEN k.entity_id IS NOT NULL THEN 8760.0 ELSE 9999.0 END::DOUBLE), 6) AS l
      FROM fx_prev p LEFT JOIN (SELECT DISTINCT entity_id, family FROM fx_instants) k USING (entity_id, family))
    GROUP BY entity_id, ts""", "fx_prev", "fx_instants"))
def _(spark, sf):
    out = asof.hours_since_last(fx.telemetry(spark, sf), fx.faults(spark, sf), fx.FAMILIES, days=fx.BLOCK_DAYS)
    return out.select("entity_id", "ts", *[r(f"hours_since_last_{n}").alias(f"h_{n}") for n in NAMES],
                      *[r(f"hours_since_last_{n}_log").alias(f"l_{n}") for n in NAMES])


@query("jn_3_label_nearest", sql("""
    SELECT entity_id, ts, family, round(hours_to, 6) AS hours_to, is_pre, excluded FROM fx_nearest""", "fx_nearest"))
def _(spark, sf):
    return fx.labels(spark, sf, "nearest").withColumn("hours_to", r("hours_to"))


@query("jn_4_label_last_window", sql("""
    SELECT entity_id, ts, family, round(hours_to, 6) AS hours_to, is_pre, excluded FROM fx_last""", "fx_last"))
def _(spark, sf):
    return fx.labels(spark, sf, "last").withColumn("hours_to", r("hours_to"))


@query("jn_5_alerts_to_events", sql(f"""
    SELECT p.entity_id, p.family, p.ts, p.pred_h, EXISTS (SELECT 1 FROM fx_clusters e WHERE e.entity_id = p.entity_id
      AND e.family = p.family AND e.ts >= p.ts AND e.ts <= p.ts + INTERVAL {fx.MATCH_H} HOUR) AS hit
    FROM fx_predictions p""", "fx_predictions", "fx_clusters"))
def _(spark, sf):
    events = flt.cluster_events(fx.faults(spark, sf), fx.GAP_H)
    return review.alert_hits(fx.predictions(spark, sf), events, fx.MATCH_H).select(
        "entity_id", "family", "ts", "pred_h", "hit")


@query("jn_5_events_to_alerts", sql(f"""
    SELECT e.entity_id, e.family, e.ts AS event_ts, min(p.pred_h) AS lowest, count(*) AS n_readings,
      round(max((epoch_us(e.ts) - epoch_us(p.ts)) / 3.6e9), 6) AS longest_lead
    FROM fx_clusters e JOIN fx_predictions p ON e.entity_id = p.entity_id AND e.family = p.family
      AND p.ts < e.ts AND p.ts >= e.ts - INTERVAL {fx.MATCH_H} HOUR GROUP BY ALL""",
    "fx_predictions", "fx_clusters"))
def _(spark, sf):
    events = flt.cluster_events(fx.faults(spark, sf), fx.GAP_H)
    return review.event_hits(fx.predictions(spark, sf), events, fx.MATCH_H).groupBy(
        "entity_id", "family", "event_ts").agg(
        F.min("pred_h").alias("lowest"), F.count(F.lit(1)).alias("n_readings"),
        r(F.max("lead_h")).alias("longest_lead"))


@query("jn_6_window_minimum", sql("""
    SELECT entity_id, family, event_start, best_score FROM fx_windows""", "fx_windows"))
def _(spark, sf):
    return evaluate.event_windows(fx.scored_table(spark, sf), fx.lead(), 12)


@query("jn_6_window_maximum", sql("""
    SELECT entity_id, family, event_start, max_score AS best_score FROM fx_windows""", "fx_windows"))
def _(spark, sf):
    return evaluate.event_windows(fx.scored_table(spark, sf), fx.lead(), 12, score="score", best="max")


@query("jn_7_coverage", sql("""
    SELECT count(t.ts) AS n_covered, count(*) AS n_faults, round(100.0 * count(t.ts) / count(*), 6) AS pct FROM
    (SELECT DISTINCT entity_id, ts FROM fx_instants) f LEFT JOIN
    (SELECT entity_id, ts FROM fx_telemetry WHERE s_click IS NOT NULL) t USING (entity_id, ts)""",
    "fx_instants", "fx_telemetry"))
def _(spark, sf):
    tel = fx.telemetry(spark, sf).where("s_click IS NOT NULL")
    return flt.coverage(fx.faults(spark, sf), tel).withColumn("pct", r("pct"))


@query("jn_8_new_rows", sql("""
    SELECT t.entity_id, t.ts, t.n_events FROM fx_telemetry t JOIN
    (SELECT entity_id, max(ts) AS mark FROM fx_instants GROUP BY 1) m USING (entity_id) WHERE t.ts > m.mark""",
    "fx_telemetry", "fx_instants"))
def _(spark, sf):
    mark = fx.faults(spark, sf).groupBy("entity_id").agg(F.max("ts").alias("stored_until"))
    return nightly.new_rows(fx.telemetry(spark, sf).select("entity_id", "ts", "n_events"), mark)


@query("jn_8_history_new_rows", sql("""
    SELECT t.entity_id, t.ts, t.n_events FROM fx_telemetry t JOIN
    (SELECT entity_id, max(ts) AS mark FROM fx_instants GROUP BY 1) m USING (entity_id) WHERE t.ts > m.mark""",
    "fx_telemetry", "fx_instants"))
def _(spark, sf):
    """The same from the stored history, without reading its keys."""
    from leadtime.checks.windows import stored_history
    mark = fx.faults(spark, sf).groupBy("entity_id").agg(F.max("ts").alias("stored_until"))
    return stored_history(spark, sf, "n_events").after(mark)


_MEANS = [f"{s}__mean_{w}" for s in fx.SENSORS for w in config.WINDOWS]


def _features_with_context_sql():
    from leadtime.checks.windows import rolling_sql
    hours = "CASE WHEN prev_ts IS NULL THEN 8760.0::DOUBLE ELSE (epoch_us(ts) - epoch_us(prev_ts)) / 3.6e9 END"
    wide = ", ".join(f"round(max({hours}) FILTER (WHERE family = '{n}'), 6) AS hours_{n}" for n in NAMES)
    return sql(f"""SELECT f.*, p.* EXCLUDE (entity_id, ts) FROM ({rolling_sql(fx.SENSORS, config.WINDOWS, ("mean",))}) f
        JOIN (SELECT entity_id, ts, {wide} FROM fx_prev GROUP BY 1, 2) p ON p.entity_id = f.entity_id AND p.ts = f.ts""", "fx_prev")


def _features_with_context(spark, sf):
    """Rolling means of all sensors and frames beside the hours since the last fault of all families."""
    from leadtime.checks.windows import off_half
    tel = fx.telemetry(spark, sf)
    feats = rolling_features(tel, fx.SENSORS, fx_baseline(spark, sf), windows=config.WINDOWS, chunk_rows=fx.CHUNK, stats=("mean",))
    ctx = asof.hours_since_last(tel.select("entity_id", "ts"), fx.faults(spark, sf), fx.FAMILIES, cold_start_hours=8760.0, days=fx.BLOCK_DAYS)
    return feats.join(ctx, ["entity_id", "ts"]).select(
        "entity_id", "ts", *[r(F.col(c) + off_half(c)).alias(c) for c in _MEANS], *[r(f"hours_since_last_{n}").alias(f"hours_{n}") for n in NAMES])


def fx_baseline(spark, sf, sensors=fx.SENSORS):
    from leadtime.operators.baseline import baseline
    return baseline(fx.telemetry(spark, sf), sensors, days=fx.BASELINE_DAYS)


@query("jn_10_donor_fallback", sql("""
    SELECT entity_id, family, origin, count(*) AS n, min(ts) AS first_ts FROM (
      SELECT entity_id, family, ts, 'own' AS origin FROM fx_own
      UNION ALL SELECT i.entity_id + 1, i.family, i.ts, 'donor' FROM fx_instants i
      WHERE i.entity_id % 2 = 1 AND NOT EXISTS (
        SELECT 1 FROM fx_own o WHERE o.entity_id = i.entity_id + 1 AND o.family = i.family)) GROUP BY ALL""",
    "fx_own"))
def _(spark, sf):
    """Even entities know two families themselves and borrow the others from the odd one."""
    inst = fx.faults(spark, sf).select("entity_id", "family", "ts").distinct()
    own = inst.where("entity_id % 2 = 0 AND family IN ('yaw_cable', 'generator')")
    donor = inst.where("entity_id % 2 = 1")
    targets = donor.select((F.col("entity_id") + 1).alias("entity_id"), F.col("entity_id").alias("donor_id")).distinct()
    return flt.with_donor_faults(own, donor, targets).groupBy("entity_id", "family", "origin").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"))


@query("jn_11_event_slice", sql("""
    SELECT l.entity_id, l.ts, f.ts AS fault_ts, round((epoch_us(f.ts) - epoch_us(l.ts)) / 3.6e9, 6) AS hours_before,
      round(l.s_error, 6) AS s_error, l.is_pre
    FROM fx_nearest l JOIN (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY ts) AS k FROM fx_instants
      WHERE family = 'brake_hydro') f ON f.entity_id = l.entity_id AND f.k = 3
    WHERE l.family = 'brake_hydro' AND l.ts >= f.ts - INTERVAL 2 DAY AND l.ts <= f.ts + INTERVAL 2 HOUR""",
    "fx_nearest", "fx_instants"))
def _(spark, sf):
    rows = fx.labelled(spark, sf, "nearest").withColumn("is_pre", F.col("is_pre_brake_hydro"))
    return report.event_slice(rows, fx.faults(spark, sf), "brake_hydro", 3, ["s_error", "is_pre"],
                              days_before=2).withColumns({"s_error": r("s_error"), "hours_before": r("hours_before")})
