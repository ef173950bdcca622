"""Catalogs, profiles, baselines, metrics, curves and the threshold sweep."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadtime.checks import fixtures as fx
from leadtime.checks.fixtures import sql
from leadtime.checks.joins import _critical, fx_baseline
from leadtime.checks.registry import query, r
from leadtime.operators import clean, diagnostics as dg, evaluate as ev, faults as flt, report, review, splits
from leadtime.operators.baseline import baseline, series_p90
from leadtime.operators.rolling import rolling_features
from leadtime.plans.series import number_rows

S = fx.SENSORS
_FIRST = "arg_min(status, (event_ts, event_id)) AS status"


@query("agg_1_catalog", sql(f"""SELECT code, message, {_FIRST}, count(*) AS n_events FROM fx_status GROUP BY 1, 2""",
                            "fx_status"))
def _(spark, sf):
    return flt.fault_catalog(fx.status(spark, sf))


@query("agg_2_fault_catalog_by_code", sql("""
    SELECT code, arg_min(message, (event_ts, event_id)) AS message, arg_min(status, (event_ts, event_id)) AS status,
      count(*) AS n_events FROM fx_critical GROUP BY 1""", "fx_critical"))
def _(spark, sf):
    rows = flt.drop_codes(flt.critical_events(fx.status(spark, sf)), fx.excluded(spark))
    return flt.fault_catalog(rows, ("code",), ("message", "status"))


@query("agg_3_reconcile", sql("""SELECT count(*) AS n_log, count(*) AS n_catalog, true AS agrees FROM fx_status""",
                              "fx_status"))
def _(spark, sf):
    status = fx.status(spark, sf)
    return flt.reconcile(status, flt.fault_catalog(status))


@query("agg_4_distinct_status", sql("SELECT DISTINCT status FROM fx_status", "fx_status"))
def _(spark, sf):
    return fx.status(spark, sf).select("status").distinct()


@query("agg_5_group_faults", sql("""
    SELECT entity_id, ts, family, string_agg(DISTINCT code::VARCHAR, ',' ORDER BY code::VARCHAR) AS codes,
      arg_min(status, (event_ts, event_id)) AS status, count(*) AS n_events,
      (SELECT string_agg(message, ' | ' ORDER BY f, i) FROM (SELECT message, min(event_ts) AS f, min(event_id) AS i
        FROM fx_critical x WHERE x.entity_id = c.entity_id AND x.ts = c.ts AND x.family = c.family GROUP BY message))
      AS messages
    FROM fx_critical c WHERE family IS NOT NULL GROUP BY entity_id, ts, family""", "fx_critical"))
def _(spark, sf):
    return flt.group_faults(_critical(spark, sf))


@query("agg_6_repeated_instants", sql("""
    SELECT entity_id, ts, string_agg(code || 'x' || n, ',' ORDER BY code) AS codes, sum(n)::BIGINT AS n_events
    FROM (SELECT entity_id, ts, code, count(*) AS n FROM fx_critical GROUP BY 1, 2, 3) GROUP BY 1, 2
    HAVING sum(n) > 1""", "fx_critical"))
def _(spark, sf):
    rows = flt.drop_codes(flt.critical_events(fx.status(spark, sf)), fx.excluded(spark))
    return flt.repeated_instants(rows.withColumn("ts", fx.floor_ts("event_ts")))


@query("agg_7_cascades", sql("""
    SELECT entity_id, ts, string_agg(DISTINCT family, ',' ORDER BY family) AS families,
      count(DISTINCT family) AS n_families FROM fx_critical WHERE family IS NOT NULL GROUP BY 1, 2
    HAVING count(DISTINCT family) > 1""", "fx_critical"))
def _(spark, sf):
    return flt.cascades(flt.group_faults(_critical(spark, sf)))


@query("agg_7_cascade_summary", sql("""
    SELECT count(*) AS n_instants, coalesce(sum(n - 1), 0)::BIGINT AS extra_rows FROM (
    SELECT count(DISTINCT family) AS n FROM fx_critical WHERE family IS NOT NULL GROUP BY entity_id, ts
    HAVING count(DISTINCT family) > 1)""", "fx_critical"))
def _(spark, sf):
    return flt.cascade_summary(flt.group_faults(_critical(spark, sf)))


@query("agg_8_family_counts", sql("SELECT family, count(*) AS n FROM fx_faults GROUP BY 1", "fx_faults"))
def _(spark, sf):
    return flt.value_counts(fx.faults(spark, sf), "family")


@query("agg_8_top_codes", sql("""SELECT code, count(*) AS n FROM fx_critical GROUP BY 1 ORDER BY n DESC, code LIMIT 10""",
                              "fx_critical"))
def _(spark, sf):
    rows = flt.drop_codes(flt.critical_events(fx.status(spark, sf)), fx.excluded(spark))
    return flt.value_counts(rows, "code", 10)


_PROFILE = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_missing, count(*) AS n FROM fx_telemetry"
    for c in (*S, "n_events"))


@query("agg_9_null_profile", sql(f"""
    SELECT column_name, n_missing, round(100.0 * n_missing / n, 6) AS pct,
      CASE WHEN n_missing = 0 THEN 'none' WHEN n_missing = n THEN 'empty' WHEN 100.0 * n_missing / n >= 99 THEN 'nearly empty'
        WHEN 100.0 * n_missing / n > 40 THEN 'over 40' WHEN 100.0 * n_missing / n >= 10 THEN '10 to 40'
        ELSE 'under 10' END AS null_class FROM ({_PROFILE})""", "fx_telemetry"))
def _(spark, sf):
    return clean.null_profile(fx.telemetry(spark, sf), [*S, "n_events"]).withColumn("pct", r("pct"))


@query("agg_10_baseline_days", sql("SELECT * FROM fx_baseline", "fx_baseline"))
def _(spark, sf):
    return fx_baseline(spark, sf)


@query("agg_10_baseline_months", sql("""
    SELECT entity_id, sensor, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.9), 6) AS p90, count(*) AS n_rows
    FROM ((SELECT entity_id, ts, """ + ", ".join(S) + """ FROM fx_telemetry)
      UNPIVOT INCLUDE NULLS (value FOR sensor IN (""" + ", ".join(S) + """))) u JOIN (SELECT entity_id, min(ts) + INTERVAL 1 MONTH AS til FROM fx_telemetry GROUP BY 1)
    USING (entity_id) WHERE ts < til GROUP BY 1, 2""", "fx_telemetry"))
def _(spark, sf):
    return baseline(fx.telemetry(spark, sf), S, days=None, months=1)


@query("agg_10_series_p90", sql("SELECT entity_id, sensor, round(quantile_cont(value, 0.9), 6) AS p90 FROM ((SELECT entity_id, ts, "
       + ", ".join(S) + " FROM fx_filled) UNPIVOT (value FOR sensor IN (" + ", ".join(S) + "))) GROUP BY 1, 2", "fx_filled"))
def _(spark, sf):
    """The fallback threshold of sensors without a baseline, over the filled series."""
    return series_p90(fx.telemetry(spark, sf), S).select("entity_id", "sensor", r("p90").alias("p90"))


@query("agg_14_overall_quality", sql("SELECT (5 * count(*))::BIGINT AS n_cells, round(100.0 * ("
       + " + ".join(f"count(*) FILTER (WHERE {s} IS NULL)" for s in S) + ") / (5 * count(*)), 6) AS pct_missing, round(100.0 * ("
       + " + ".join(f"count(*) FILTER (WHERE {s} = 0)" for s in S) + ") / (5 * count(*)), 6) AS pct_zero FROM fx_telemetry", "fx_telemetry"))
def _(spark, sf):
    return dg.overall_quality(fx.telemetry(spark, sf), S).select("n_cells", r("pct_missing").alias("pct_missing"), r("pct_zero").alias("pct_zero"))


@query("agg_11_time_range", sql("""SELECT entity_id, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n_rows
    FROM fx_telemetry GROUP BY 1""", "fx_telemetry"))
def _(spark, sf):
    return report.time_range(fx.telemetry(spark, sf), ["entity_id"])


@query("agg_12_class_balance", sql("""
    SELECT *, CASE WHEN pct_pos > 30 THEN 'too dense' WHEN pct_pos > 25 THEN 'dense' WHEN pct_pos >= 2 THEN 'ok'
      ELSE 'sparse' END AS verdict FROM (SELECT family, count(*) FILTER (WHERE is_pre) AS n_pos, count(*) AS n_rows,
      round(max(hours_to), 6) AS max_hours, round(100.0 * count(*) FILTER (WHERE is_pre) / count(*), 6) AS pct_pos
      FROM fx_nearest GROUP BY 1)""", "fx_nearest"))
def _(spark, sf):
    return dg.class_balance(fx.labels(spark, sf, "nearest", None)).withColumns(
        {"max_hours": r("max_hours"), "pct_pos": r("pct_pos")})


_CUT = "SELECT entity_id, quantile_cont(epoch_us(ts)::DOUBLE, 0.8) AS cut FROM fx_telemetry GROUP BY 1"


@query("agg_13_events_around_cut", sql(f"""
    SELECT family, count(*) FILTER (WHERE epoch_us(ts) < cut) AS n_train, count(*) FILTER (WHERE epoch_us(ts) >= cut)
      AS n_test, count(*) AS n_total FROM fx_instants JOIN ({_CUT}) USING (entity_id) GROUP BY 1""",
    "fx_instants", "fx_telemetry"))
def _(spark, sf):
    cuts = splits.time_cuts(fx.telemetry(spark, sf), {"c": 0.8}, ["entity_id"])
    cuts = cuts.select("entity_id", F.timestamp_micros(F.ceil("c")).alias("cut"))
    inst = fx.faults(spark, sf).select("entity_id", "family", "ts").distinct()
    return dg.split_events(inst, cuts)


@query("agg_13_positives_around_cut", sql(f"""
    SELECT *, CASE WHEN train_pos = 0 THEN 'no train' WHEN test_pos = 0 THEN 'no test' WHEN train_pos < 100 THEN 'few'
      ELSE 'ok' END AS verdict FROM (SELECT family, count(*) FILTER (WHERE is_pre AND epoch_us(ts) < cut) AS train_pos,
      count(*) FILTER (WHERE is_pre AND epoch_us(ts) >= cut) AS test_pos
      FROM fx_nearest JOIN ({_CUT}) USING (entity_id) GROUP BY 1)""", "fx_nearest"))
def _(spark, sf):
    rows = fx.labels(spark, sf, "nearest", None)
    one = splits.temporal_split(fx.telemetry(spark, sf).select("entity_id", "ts"), (0.8,), ["entity_id"])
    return dg.split_positives(rows.join(one, ["entity_id", "ts"]))


_Q = " UNION ALL ".join(f"""SELECT '{c}' AS feature, round(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 6)
    AS pct_missing, round(100.0 * count(*) FILTER (WHERE {c} = 0) / count(*), 6) AS pct_zero FROM fx_telemetry"""
                        for c in (*S, "n_events"))


@query("agg_14_feature_quality", sql(f"""SELECT * FROM ({_Q}) ORDER BY pct_missing DESC, feature LIMIT 5""",
                                     "fx_telemetry"))
def _(spark, sf):
    quality = dg.feature_quality(fx.telemetry(spark, sf), [*S, "n_events"])
    return quality.select("feature", r("pct_missing").alias("pct_missing"), r("pct_zero").alias("pct_zero")).orderBy(
        F.desc("pct_missing"), "feature").limit(5)


def _auc_sql(table, group, score, label):
    return f"""SELECT {group}, n_pos, n_neg, CASE WHEN n_pos > 0 AND n_neg > 0 THEN
        (rank_sum - n_pos * (n_pos + 1) / 2.0) / (n_pos::DOUBLE * n_neg) END AS auc FROM (
      SELECT {group}, count(*) FILTER (WHERE {label}) AS n_pos, count(*) FILTER (WHERE NOT {label}) AS n_neg,
        sum(rk) FILTER (WHERE {label}) AS rank_sum FROM (SELECT *, rank() OVER w + (count(*) OVER (
          PARTITION BY {group}, {score}) - 1) / 2.0::DOUBLE AS rk FROM {table}
          WINDOW w AS (PARTITION BY {group} ORDER BY {score})) GROUP BY {group})"""


_INPUTS = {**{s: s for s in S}, **{f"{s}_of_{t}": f"{s} - {t}" for s in S for t in S if s < t}}
_LONG = "(SELECT family, is_pre, sensor AS feature, value FROM (UNPIVOT (SELECT family, is_pre, " + ", ".join(
    f"coalesce({e}, 0) AS {n}" for n, e in _INPUTS.items()) + " FROM fx_scored) ON " + ", ".join(_INPUTS) + \
    " INTO NAME sensor VALUE value))"


@query("agg_15_symmetric_auc", sql(f"""
    SELECT family, feature, round(a, 6) AS auc, round(median_auc, 6) AS median_auc FROM (
      SELECT *, median(a) OVER (PARTITION BY family) AS median_auc, row_number() OVER (PARTITION BY family ORDER BY round(a, 9) DESC, feature) AS best,
        row_number() OVER (PARTITION BY family ORDER BY round(a, 9), feature) AS worst
      FROM (SELECT family, feature, greatest(auc, 1 - auc) AS a FROM ({_auc_sql(_LONG, "family, feature", "value", "is_pre")})))
    WHERE best <= 5 OR worst <= 5""", "fx_scored"))
def _(spark, sf):
    """All families, fifteen features each, of which the five best and five worst are reported."""
    rows = fx.scored_table(spark, sf).select("family", "is_pre", *[F.expr(e).alias(n) for n, e in _INPUTS.items()])
    aucs = dg.symmetric_auc(rows, list(_INPUTS), F.col("is_pre"), ["family"]).withColumn("auc", r("auc", 9))
    out = dg.auc_report(aucs, 5, ["family"])
    return out.select("family", "feature", r("auc").alias("auc"), r("median_auc").alias("median_auc"))


@query("agg_16_class_means", sql("""
    SELECT family, round(avg(h) FILTER (WHERE is_pre), 6) AS pos_mean, round(avg(h) FILTER (WHERE NOT is_pre), 6) AS neg_mean
    FROM (SELECT l.family, l.is_pre, CASE WHEN prev_ts IS NULL THEN 8760.0::DOUBLE
      ELSE (epoch_us(l.ts) - epoch_us(prev_ts)) / 3.6e9 END AS h
      FROM fx_nearest l JOIN fx_prev USING (entity_id, family, ts)) GROUP BY 1""", "fx_nearest", "fx_prev"))
def _(spark, sf):
    from leadtime.operators import asof
    lab = fx.labelled(spark, sf, "nearest", None)
    both = asof.hours_since_last(lab, fx.faults(spark, sf), fx.FAMILIES, cold_start_hours=8760.0, days=fx.BLOCK_DAYS)
    rows = both.select(F.inline(F.array(*[F.struct(
        F.lit(f.name).alias("family"), F.col(f"is_pre_{f.name}").alias("is_pre"),
        F.col(f"hours_since_last_{f.name}").alias("h")) for f in fx.FAMILIES])))
    return dg.class_means(rows, "h").select("family", r("pos_mean").alias("pos_mean"), r("neg_mean").alias("neg_mean"))


@query("agg_17_separation", sql("""
    SELECT family, round(avg(score) FILTER (WHERE NOT is_pre), 6) AS neg_mean, round(max(n95), 6) AS neg_p95,
      round(avg(score) FILTER (WHERE is_pre), 6) AS pos_mean, round(max(p05), 6) AS pos_p05,
      round(100.0 * avg(CASE WHEN score > p05 THEN 1 ELSE 0 END) FILTER (WHERE NOT is_pre), 6) AS overlap_pct
    FROM fx_scored JOIN (SELECT family, quantile_cont(score, 0.95) FILTER (WHERE NOT is_pre) AS n95,
      quantile_cont(score, 0.05) FILTER (WHERE is_pre) AS p05 FROM fx_scored GROUP BY 1) USING (family) GROUP BY 1""",
    "fx_scored"))
def _(spark, sf):
    out = dg.separation(fx.scored(spark, sf), "score", F.col("is_pre"))
    return out.select("family", *[r(c).alias(c) for c in out.columns if c != "family"])


_SPINE = """SELECT family, unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH)) AS month FROM (
    SELECT family, date_trunc('month', ts)::TIMESTAMP AS m FROM fx_scored) GROUP BY 1"""


@query("agg_18_monthly_false_positives", sql(f"""
    SELECT s.family, s.month, coalesce(n_fp, 0) AS n_fp, coalesce(n_neg, 0) AS n_neg,
      CASE WHEN coalesce(n_neg, 0) = 0 THEN 0.0 ELSE round(100.0 * n_fp / n_neg, 6) END::DOUBLE AS fp_pct
    FROM ({_SPINE}) s LEFT JOIN (SELECT family, date_trunc('month', ts)::TIMESTAMP AS month,
      count(*) FILTER (WHERE NOT is_pre AND score >= 0.2::DOUBLE) AS n_fp, count(*) FILTER (WHERE NOT is_pre) AS n_neg
      FROM fx_scored GROUP BY 1, 2) USING (family, month)""", "fx_scored"))
def _(spark, sf):
    out = dg.monthly_false_positives(fx.scored(spark, sf), F.col("score") >= 0.2, F.col("is_pre"))
    return out.withColumn("fp_pct", r("fp_pct"))


@query("agg_18_monthly_returns", """
    WITH c AS (SELECT l_linestatus AS family, date_trunc('month', l_shipdate)::TIMESTAMP AS month,
      count(*) FILTER (WHERE l_discount >= 0.05::DOUBLE AND l_returnflag <> 'R') AS n_fp,
      count(*) FILTER (WHERE l_returnflag <> 'R') AS n_neg FROM lineitem GROUP BY 1, 2),
    s AS (SELECT family, unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS month FROM c GROUP BY 1)
    SELECT family, month, coalesce(n_fp, 0) AS n_fp, coalesce(n_neg, 0) AS n_neg,
      CASE WHEN coalesce(n_neg, 0) = 0 THEN 0.0::DOUBLE ELSE round(100.0 * n_fp / n_neg, 6) END AS fp_pct
    FROM s LEFT JOIN c USING (family, month)""")
def _(spark, sf):
    rows = fx.table(spark, sf, "lineitem").select(
        F.col("l_linestatus").alias("family"), F.col("l_shipdate").alias("ts"), "l_discount", "l_returnflag")
    out = dg.monthly_false_positives(rows, F.col("l_discount") >= 0.05, F.col("l_returnflag") == "R")
    return out.withColumn("fp_pct", r("fp_pct"))


@query("agg_19_month_correlation", """
    SELECT 'l_quantity' AS feature, round(corr(l_quantity, month(l_shipdate)), 6) AS corr_month FROM lineitem UNION ALL
    SELECT 'l_extendedprice', round(corr(l_extendedprice, month(l_shipdate)), 6) FROM lineitem UNION ALL
    SELECT 'l_discount', round(corr(l_discount, month(l_shipdate)), 6) FROM lineitem""")
def _(spark, sf):
    out = dg.month_correlation(fx.table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"], "l_shipdate")
    return out.withColumn("corr_month", r("corr_month"))


def _curve(spark, sf):
    return dg.pr_curve(fx.scored(spark, sf), "score", F.col("is_pre"))


@query("agg_20_pr_curve", sql("""SELECT family, threshold, tp::BIGINT AS tp, fp::BIGINT AS fp,
    round(precision, 6) AS precision, round(recall, 6) AS recall FROM fx_curve""", "fx_curve"))
def _(spark, sf):
    return _curve(spark, sf).withColumns({"precision": r("precision"), "recall": r("recall")})


@query("agg_20_max_precision", sql("""
    SELECT family, round(coalesce(max(precision) FILTER (WHERE recall >= 0.8), 0), 6) AS max_precision,
      coalesce(arg_max(threshold, (precision, -threshold)) FILTER (WHERE recall >= 0.8), 0)::DOUBLE AS best_threshold
    FROM fx_curve GROUP BY 1""", "fx_curve"))
def _(spark, sf):
    return dg.best_precision(_curve(spark, sf)).withColumn("max_precision", r("max_precision"))


@query("agg_21_threshold_choice", sql("""
    SELECT family, coalesce(arg_max(threshold, (recall, -threshold)) FILTER (WHERE precision >= 0.3), 0.2)::DOUBLE AS threshold
    FROM fx_curve GROUP BY 1""", "fx_curve"))
def _(spark, sf):
    return dg.choose_threshold(_curve(spark, sf), 0.30)


_BINS = """SELECT family, least(greatest(ceil(score * 10), 1), 10)::BIGINT AS bin, avg(is_pre::INT) AS frac_pos,
    sum(score::DECIMAL(18, 6))::DOUBLE / count(score) AS mean_pred, count(*) AS n FROM fx_scored GROUP BY 1, 2"""


@query("agg_22_reliability", sql(f"""SELECT family, bin, round(frac_pos, 6) AS frac_pos, round(mean_pred, 6) AS mean_pred, n
    FROM ({_BINS})""", "fx_scored"))
def _(spark, sf):
    return dg.reliability(fx.scored(spark, sf), "score", F.col("is_pre")).withColumns(
        {"frac_pos": r("frac_pos"), "mean_pred": r("mean_pred")})


@query("agg_22_calibration_error", sql(f"""SELECT family, round(avg(abs(frac_pos - mean_pred)), 6) AS calibration_error
    FROM ({_BINS}) GROUP BY 1""", "fx_scored"))
def _(spark, sf):
    out = dg.calibration_error(dg.reliability(fx.scored(spark, sf), "score", F.col("is_pre")))
    return out.withColumn("calibration_error", r("calibration_error"))


_CM = """SELECT family, tn, fp, fn, tp, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END::DOUBLE AS p,
    CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END::DOUBLE AS rc FROM (SELECT family,
    count(*) FILTER (WHERE pred_h > alert_h AND NOT is_pre) AS tn, count(*) FILTER (WHERE pred_h <= alert_h AND NOT is_pre) AS fp,
    count(*) FILTER (WHERE pred_h > alert_h AND is_pre) AS fn, count(*) FILTER (WHERE pred_h <= alert_h AND is_pre) AS tp
    FROM fx_scored GROUP BY 1)"""


def _confusion(spark, sf, scored=None):
    return ev.confusion(scored or fx.scored(spark, sf), F.col("pred_h") <= fx.alert_h(), F.col("is_pre"))


@query("agg_23_confusion", sql(f"""SELECT family, tn, fp, fn, tp, round(p, 6) AS precision, round(rc, 6) AS recall,
    round(CASE WHEN p + rc = 0 THEN 0 ELSE 2 * p * rc / (p + rc) END, 6) AS f1 FROM ({_CM})""", "fx_scored"))
def _(spark, sf):
    return _confusion(spark, sf).withColumns({c: r(c) for c in ("precision", "recall", "f1")})


_REG = """SELECT family, count(*) AS n, avg(abs(hours_to - raw_h)) AS mae_raw, avg(abs(hours_to - pred_h)) AS mae_cal,
    sqrt(avg((hours_to - pred_h) ** 2)) AS rmse, 1 - avg((hours_to - pred_h) ** 2) / var_pop(hours_to) AS r2
    FROM fx_scored WHERE is_pre GROUP BY 1"""


@query("agg_24_regression_metrics", sql(f"""SELECT family, n, round(mae_raw, 6) AS mae_raw, round(mae_cal, 6) AS mae_cal,
    round(rmse, 6) AS rmse, round(r2, 6) AS r2 FROM ({_REG})""", "fx_scored"))
def _(spark, sf):
    return ev.regression_metrics(fx.scored(spark, sf)).withColumns(
        {c: r(c) for c in ("mae_raw", "mae_cal", "rmse", "r2")})


_ER = """SELECT family, count(*) FILTER (WHERE best_score <= alert_h) AS events_detected, count(*) AS events_total,
    round(count(*) FILTER (WHERE best_score <= alert_h) / count(*), 4) AS event_recall FROM fx_windows GROUP BY 1"""


def _events(spark, sf, scored=None):
    windows = ev.event_windows(scored or fx.scored_table(spark, sf), fx.lead(), 12)
    return ev.event_recall(windows, F.col("best_score") <= fx.alert_h())


@query("agg_25_event_recall", sql(_ER, "fx_windows"))
def _(spark, sf):
    return _events(spark, sf)


@query("agg_26_label_events", sql("""
    SELECT entity_id, family, coalesce(n, 0) AS n_events FROM (SELECT DISTINCT entity_id, family FROM fx_scored)
    LEFT JOIN (SELECT entity_id, family, 1 + count(*) FILTER (WHERE hours_to > p) AS n FROM (SELECT *,
      lag(hours_to) OVER (PARTITION BY entity_id, family ORDER BY ts) AS p FROM fx_scored WHERE is_pre) GROUP BY 1, 2)
    USING (entity_id, family)""", "fx_scored"))
def _(spark, sf):
    return ev.count_label_events(fx.scored(spark, sf))


_SUMMARY = f"""SELECT family, fp, fn, tp, round(p, 4) AS precision, round(rc, 4) AS recall, events_detected, events_total,
    coalesce(event_recall, 0) AS event_recall FROM ({_CM}) LEFT JOIN ({_ER}) USING (family)"""
_F1 = """round(CASE WHEN event_recall + precision = 0 THEN 0
    ELSE 2 * event_recall * precision / (event_recall + precision) END, 4) AS f1_ep"""


def _alert_summary(spark, sf, scored=None):
    scored = scored or fx.scored_table(spark, sf)
    return ev.alert_summary(_confusion(spark, sf, scored).drop("f1", "tn"), _events(spark, sf, scored))


@query("agg_27_f1_event_precision", sql(f"SELECT *, {_F1} FROM ({_SUMMARY})", "fx_scored", "fx_windows"))
def _(spark, sf):
    return _alert_summary(spark, sf)


_BIN6 = "time_bucket(INTERVAL '6 hours', ts)"


@query("agg_28_timeline_6h", sql(f"""
    SELECT s.entity_id, s.family, s.bin, first_ts, alert_score, pred_h, is_pre
    FROM (SELECT entity_id, family, unnest(generate_series(min({_BIN6}), max({_BIN6}), INTERVAL 6 HOUR)) AS bin
      FROM fx_scored GROUP BY 1, 2) s
    LEFT JOIN (SELECT entity_id, family, {_BIN6} AS bin, min(ts) AS first_ts, ((2 * sum(round(round(1 - pred_h / lead_hours, 6) * 1000000)::BIGINT) + count(*)) // (2 * count(*))) / 1000000 AS alert_score,
      ((2 * sum(round(pred_h * 1000000)::BIGINT) + count(*)) // (2 * count(*))) / 1000000 AS pred_h, max(is_pre::INT) AS is_pre FROM fx_scored GROUP BY 1, 2, 3) USING (entity_id, family, bin)""",
    "fx_scored"))
def _(spark, sf):
    """The shipped timeline, with more digits: the two engines round ties of few digits differently."""
    return report.alert_timeline(fx.scored(spark, sf), fx.lead(), score_digits=6, hour_digits=6)


@query("agg_29_weekly_share", sql("""
    SELECT s.family, s.m + INTERVAL 6 DAY AS week, round(share_pos, 6) AS share_pos FROM (
      SELECT family, unnest(generate_series(min(date_trunc('week', ts)::TIMESTAMP), max(date_trunc('week', ts)::TIMESTAMP),
        INTERVAL 7 DAY)) AS m FROM fx_nearest GROUP BY 1) s
    LEFT JOIN (SELECT family, date_trunc('week', ts)::TIMESTAMP AS m, avg(is_pre::INT) AS share_pos FROM fx_nearest
      GROUP BY 1, 2) USING (family, m)""", "fx_nearest"))
def _(spark, sf):
    return report.weekly_share(fx.labels(spark, sf, "nearest", None)).withColumn("share_pos", r("share_pos"))


SWEEP_SQL = f"""
    SELECT g.family, g.threshold::INT AS threshold, coalesce(a.n, 0) AS n_alerts, coalesce(e.tp, 0) AS tp_events,
      coalesce(t.n, 0) AS n_events, CASE WHEN t.n > 0 THEN round(coalesce(e.tp, 0) / t.n, 6) END AS recall,
      CASE WHEN a.n > 0 THEN round(a.hit / a.n, 6) END AS precision, round(e.lead, 6) AS avg_lead_h
    FROM (SELECT family, unnest(generate_series(floor_h, {fx.CEILING}, 1)) AS threshold FROM fx_config) g
    LEFT JOIN (SELECT family, threshold, count(*) AS n, count(*) FILTER (WHERE hit) AS hit FROM (
        SELECT p.family, p.pred_h, EXISTS (SELECT 1 FROM fx_clusters e WHERE e.entity_id = p.entity_id
          AND e.family = p.family AND e.ts >= p.ts AND e.ts <= p.ts + INTERVAL {fx.MATCH_H} HOUR) AS hit
        FROM fx_predictions p) x JOIN (SELECT unnest(generate_series(1, {fx.CEILING}, 1)) AS threshold) ON pred_h < threshold
      GROUP BY 1, 2) a USING (family, threshold)
    LEFT JOIN (SELECT family, threshold, count(*) AS tp, avg(lead) AS lead FROM (
        SELECT e.entity_id, e.family, e.ts, threshold, max((epoch_us(e.ts) - epoch_us(p.ts)) / 3.6e9) AS lead
        FROM fx_clusters e JOIN fx_predictions p ON e.entity_id = p.entity_id AND e.family = p.family AND p.ts < e.ts
          AND p.ts >= e.ts - INTERVAL {fx.MATCH_H} HOUR
        JOIN (SELECT unnest(generate_series(1, {fx.CEILING}, 1)) AS threshold) ON pred_h < threshold GROUP BY ALL)
      GROUP BY 1, 2) e USING (family, threshold)
    LEFT JOIN (SELECT family, count(*) AS n FROM fx_clusters GROUP BY 1) t USING (family)"""


def _sweep(spark, sf):
    events = flt.cluster_events(fx.faults(spark, sf), fx.GAP_H)
    return review.threshold_sweep(fx.predictions(spark, sf), events, fx.floors(spark), ceiling=fx.CEILING, step=1,
                                  match_hours=fx.MATCH_H)


@query("agg_30_threshold_sweep", sql(SWEEP_SQL, "fx_config", "fx_clusters", "fx_predictions"))
def _(spark, sf):
    return _sweep(spark, sf).withColumns({c: r(c) for c in ("recall", "precision", "avg_lead_h")})


@query("agg_31_high_water_mark", sql("SELECT family, max(ts) AS stored_until FROM fx_instants GROUP BY 1", "fx_instants"))
def _(spark, sf):
    return report.high_water_mark(fx.faults(spark, sf))


@query("agg_31_common_mark", sql("""SELECT min(m) AS stored_until FROM (SELECT max(ts) AS m FROM fx_instants GROUP BY family)""",
                                 "fx_instants"))
def _(spark, sf):
    return report.common_mark(report.high_water_mark(fx.faults(spark, sf)))


@query("agg_32_first_valid_row", sql("""
    SELECT entity_id, s || '__' || stat || '_' || w AS feature, min(row_no) AS first_row FROM fx_filled,
    (VALUES ('1h', 2), ('6h', 12), ('24h', 48), ('7d', 336)) v(w, mp), (VALUES ('mean'), ('p95'), ('exceed')) t(stat),
    (VALUES """ + ", ".join(f"('{s}')" for s in S) + """) u(s) WHERE row_no >= mp GROUP BY 1, 2""", "fx_filled"))
def _(spark, sf):
    """All sensors and frames; a standard deviation has a value from the first row on."""
    kinds = ("mean", "p95", "exceed")
    feats = rolling_features(fx.telemetry(spark, sf), S, fx_baseline(spark, sf, S), chunk_rows=fx.CHUNK, stats=kinds)
    names = [f"{s}__{k}_{w}" for s in S for k in kinds for w in ("1h", "6h", "24h", "7d")]
    return dg.first_valid_rows(number_rows(feats, ["entity_id"], "ts"), names).withColumn(
        "first_row", F.col("first_row"))


def _hist_sql(col, bins, rows, group, scope):
    """Bin edges from the extremes; the top edge falls into the last bin."""
    return f"""SELECT {group}, least(floor(({col} - lo) / ((hi - lo) / {bins})), {bins - 1})::BIGINT + 1 AS bin,
      count(*) AS n, max((hi - lo) / {bins}) AS w FROM (SELECT *, min({col}) OVER (PARTITION BY {scope}) AS lo,
      max({col}) OVER (PARTITION BY {scope}) AS hi FROM {rows}) GROUP BY ALL"""


@query("agg_33_hours_histogram", sql(f"""SELECT family, bin, n FROM ({_hist_sql('hours_to', 48,
    '(SELECT * FROM fx_nearest WHERE is_pre)', 'family', 'family')})""", "fx_nearest"))
def _(spark, sf):
    return dg.histogram(fx.labels(spark, sf, "nearest", None), "hours_to", 48)


@query("agg_33_score_density", sql(f"""SELECT family, is_pre, bin, n::BIGINT AS n,
    round(n / (sum(n) OVER (PARTITION BY family, is_pre) * w), 6) AS density
    FROM ({_hist_sql('score', 60, 'fx_scored', 'family, is_pre', 'family, is_pre')})""", "fx_scored"))
def _(spark, sf):
    return dg.histogram(fx.scored(spark, sf), "score", 60, ("family", "is_pre"), density=True).withColumn(
        "density", r("density"))


@query("agg_34_auc_roc", sql(f"SELECT family, n_pos, n_neg, round(auc, 6) AS auc FROM ({_auc_sql('fx_scored', 'family', 'score', 'is_pre')})",
                             "fx_scored"))
def _(spark, sf):
    return dg.auc(fx.scored(spark, sf), "score", F.col("is_pre"), ["family"]).withColumn("auc", r("auc"))


@query("agg_34_auc_toxic_by_length", f"""
    WITH d AS (SELECT lang AS g, n_chars::DOUBLE AS s, toxic = 1 AS y FROM documents JOIN labels USING (doc_id))
    SELECT g, n_pos, n_neg, round(auc, 6) AS auc FROM ({_auc_sql('d', 'g', 's', 'y')})""")
def _(spark, sf):
    rows = fx.table(spark, sf, "documents").join(fx.table(spark, sf, "labels"), "doc_id").select(
        F.col("lang").alias("g"), F.col("n_chars").cast("double").alias("s"), (F.col("toxic") == 1).alias("y"))
    return dg.auc(rows, "s", F.col("y"), ["g"]).withColumn("auc", r("auc"))


@query("agg_35_calibration_gain", sql(f"""
    SELECT family, round(mae_raw, 6) AS mae_raw, round(mae_cal, 6) AS mae_cal, round(mae_raw - mae_cal, 6) + 0.0 AS gain,
      event_recall, event_recall >= 0.8 AS passed FROM ({_REG}) JOIN ({_ER}) USING (family)""", "fx_scored", "fx_windows"))
def _(spark, sf):
    scored = fx.scored_table(spark, sf)
    both = ev.regression_metrics(scored).join(_events(spark, sf, scored), "family")
    return ev.calibration_gain(both).select("family", *[r(c).alias(c) for c in ("mae_raw", "mae_cal", "gain")],
                                            "event_recall", "passed")


