"""Sorts, limits, top-k, samples and choices."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadtime.checks import fixtures as fx
from leadtime.checks.aggregates import SWEEP_SQL, _alert_summary, _curve, _sweep
from leadtime.checks.fixtures import sql
from leadtime.checks.registry import query, r
from leadtime.functions.scalars import parse_ts
from leadtime.operators import clean, diagnostics as dg, evaluate as ev, report, review


@query("ord_1_sorted_log", sql("""SELECT event_id, CASE WHEN status = 'Informational' THEN NULL
    ELSE date_trunc('second', event_ts)::TIMESTAMP END AS started FROM fx_status ORDER BY started NULLS FIRST, event_id""", "fx_status"))
def _(spark, sf):
    text = F.when(F.col("status") == "Informational", "-").otherwise(F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss"))
    return fx.status(spark, sf).select("event_id", parse_ts(text).alias("started")).orderBy("started", "event_id")


_M = " UNION ALL ".join(f"""SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_missing,
    round(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 6) AS pct FROM fx_telemetry""" for c in (*fx.SENSORS, "n_events"))


@query("ord_2_top_missing", sql(f"SELECT * FROM ({_M}) ORDER BY pct DESC, column_name LIMIT 3", "fx_telemetry"))
def _(spark, sf):
    profile = clean.null_profile(fx.telemetry(spark, sf), [*fx.SENSORS, "n_events"])
    return clean.top_missing(profile, 3).select("column_name", "n_missing", r("pct").alias("pct"))


@query("ord_3_latest_rows", sql("""SELECT entity_id, max(ts) AS ts, arg_max(n_events, ts) AS n_events,
    round(arg_max_null(s_click, ts), 6) AS s_click FROM fx_telemetry GROUP BY 1""", "fx_telemetry"))
def _(spark, sf):
    return report.latest(fx.telemetry(spark, sf).select("entity_id", "ts", "n_events", "s_click")).withColumn(
        "s_click", r("s_click"))


@query("ord_4_preview", sql("SELECT entity_id, ts, n_events FROM fx_telemetry ORDER BY ts, entity_id LIMIT 5", "fx_telemetry"))
def _(spark, sf):
    return fx.telemetry(spark, sf).select("entity_id", "ts", "n_events").orderBy("ts", "entity_id").limit(5)


@query("ord_5_sample_size", sql("""SELECT family, least(800, count(*)) AS n, true AS all_positive FROM fx_scored WHERE is_pre
    GROUP BY 1""", "fx_scored"))
def _(spark, sf):
    """Size of a sample of at most 800 positives per family, and that it holds distinct positives only."""
    rows = fx.scored(spark, sf).where("is_pre")
    picked = report.sample_rows(rows, 800, ["entity_id", "ts"])
    return picked.groupBy("family").agg(
        F.count(F.lit(1)).alias("n"),
        (F.bool_and("is_pre") & (F.count_distinct("entity_id", "ts") == F.count(F.lit(1)))).alias("all_positive"))


@query("ord_5_sample", sql("""SELECT entity_id, family, ts, round(hours_to, 6) AS hours_to, pred_h FROM fx_scored WHERE is_pre
    QUALIFY row_number() OVER (PARTITION BY family ORDER BY md5(entity_id || '|' || ts || '|42'), entity_id, ts) <= 40""", "fx_scored"))
def _(spark, sf):
    """The chosen rows themselves, of a sample that is smaller than each family."""
    rows = fx.scored(spark, sf).where("is_pre").select("entity_id", "family", "ts", r("hours_to").alias("hours_to"), "pred_h")
    return report.sample_rows(rows, 40, ["entity_id", "ts"])


@query("ord_6_recommendation", sql(f"""
    SELECT family, floor_h, data_driven, CASE WHEN data_driven IS NOT NULL THEN greatest(data_driven, floor_h) END AS recommended,
      CASE WHEN data_driven IS NULL THEN 'no threshold reaches full recall' WHEN data_driven < floor_h THEN 'operational floor'
      ELSE 'data' END AS reason FROM (SELECT family, min(threshold) FILTER (WHERE recall >= 0.999) AS data_driven
      FROM ({SWEEP_SQL}) GROUP BY 1) JOIN fx_config USING (family)""", "fx_config", "fx_clusters", "fx_predictions"))
def _(spark, sf):
    return review.recommend_threshold(_sweep(spark, sf), fx.floors(spark))


def _candidates(spark, sf):
    """Two candidates per family: the prediction, and one that alerts at the raw value."""
    table = fx.scored_table(spark, sf)
    one = _alert_summary(spark, sf, table).withColumn("source", F.lit("target"))
    scored = table.withColumn("pred_h", F.col("raw_h"))
    rows = ev.confusion(scored, F.col("pred_h") <= fx.alert_h(), F.col("is_pre")).drop("f1", "tn")
    events = ev.event_recall(ev.event_windows(scored, fx.lead(), 12), F.col("best_score") <= fx.alert_h())
    return one.unionByName(ev.alert_summary(rows, events).withColumn("source", F.lit("donor+target")))


def _cand_sql(score, source):
    return f"""SELECT family, '{source}' AS source, precision, recall, event_recall, round(CASE WHEN event_recall + precision = 0
      THEN 0 ELSE 2 * event_recall * precision / (event_recall + precision) END, 4) AS f1_ep FROM (
      SELECT family, round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 4)::DOUBLE AS precision,
        round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 4)::DOUBLE AS recall FROM (SELECT family,
        count(*) FILTER (WHERE {score} <= alert_h AND NOT is_pre) AS fp, count(*) FILTER (WHERE {score} > alert_h AND is_pre) AS fn,
        count(*) FILTER (WHERE {score} <= alert_h AND is_pre) AS tp FROM fx_scored GROUP BY 1))
      JOIN (SELECT family, round(count(*) FILTER (WHERE best <= alert_h) / count(*), 4) AS event_recall FROM (
        SELECT s.entity_id, s.family, s.event_start, s.alert_h, min(x.{score}) AS best FROM fx_starts s JOIN fx_scored x
        ON x.entity_id = s.entity_id AND x.family = s.family AND x.ts >= s.event_start
        AND x.ts < s.event_start + to_seconds(s.lead_hours * 3600) GROUP BY ALL) GROUP BY 1) USING (family)"""


_BOTH = f"{_cand_sql('pred_h', 'target')} UNION ALL {_cand_sql('raw_h', 'donor+target')}"


@query("ord_7_winner", sql(f"""SELECT family, source, precision, recall, event_recall, f1_ep FROM (SELECT *, row_number() OVER (
    PARTITION BY family ORDER BY f1_ep DESC, source) AS k FROM ({_BOTH})) WHERE k = 1""", "fx_starts", "fx_scored"))
def _(spark, sf):
    return ev.pick_winner(_candidates(spark, sf)).select(
        "family", "source", "precision", "recall", "event_recall", "f1_ep")


@query("ord_7_retrain_log", sql(f"""
    SELECT family, max(source) FILTER (WHERE k = 1) AS winner, max(f1_ep) FILTER (WHERE k = 1) AS f1_ep,
      max(f1_ep) FILTER (WHERE source = 'target') AS f1_ep_target, max(precision) FILTER (WHERE source = 'target') AS precision_target,
      max(f1_ep) FILTER (WHERE source = 'donor+target') AS f1_ep_donor_target,
      max(precision) FILTER (WHERE source = 'donor+target') AS precision_donor_target
    FROM (SELECT *, row_number() OVER (PARTITION BY family ORDER BY f1_ep DESC, source) AS k FROM ({_BOTH})) GROUP BY 1""",
    "fx_starts", "fx_scored"))
def _(spark, sf):
    cand = _candidates(spark, sf)
    win = ev.pick_winner(cand).select("family", "source", "f1_ep")
    return ev.retrain_log_rows(cand, win, ["target", "donor+target"], ["f1_ep", "precision"])


@query("ord_8_nearest_point", sql("""SELECT family, arg_min(threshold, (abs(threshold - 0.25::DOUBLE), threshold)) AS threshold,
    round(arg_min(precision, (abs(threshold - 0.25::DOUBLE), threshold)), 6) AS precision,
    round(arg_min(recall, (abs(threshold - 0.25::DOUBLE), threshold)), 6) AS recall FROM fx_curve GROUP BY 1""", "fx_curve"))
def _(spark, sf):
    return dg.nearest_curve_point(_curve(spark, sf), 0.25).withColumns({"precision": r("precision"), "recall": r("recall")})
