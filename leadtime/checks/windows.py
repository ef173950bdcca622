"""Window functions over long series."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadtime import config
from leadtime.checks import fixtures as fx, joins, scalars
from leadtime.checks.fixtures import sql
from leadtime.checks.joins import fx_baseline
from leadtime.checks.registry import query, r
from leadtime.functions.scalars import rounded
from leadtime.operators import domain, evaluate as ev, faults as flt, nightly
from leadtime.operators.baseline import baseline
from leadtime.operators.history import History
from leadtime.operators.rolling import STATS, feature_names, rolling_features, smooth_centered
from leadtime.plans.lineage import fresh_path, materialize
from leadtime.plans.series import fill_forward

KEY = ["entity_id"]
ALL = {"1h": 6, "6h": 36, "24h": 144, "7d": 1008}
SHORT = {"1h": 6, "6h": 36}


@query("win_1_forward_fill", sql("SELECT entity_id, ts, row_no, " + ", ".join(
    f"round({s}, 6) AS {s}" for s in fx.SENSORS) + " FROM fx_filled", "fx_filled"))
def _(spark, sf):
    out = fill_forward(fx.telemetry(spark, sf).select("entity_id", "ts", *fx.SENSORS), KEY, "ts", fx.SENSORS,
                       days=fx.BLOCK_DAYS, number="row_no")
    return out.select("entity_id", "ts", "row_no", *[r(s).alias(s) for s in fx.SENSORS])


def off_half(name):
    """Means of two-decimal readings may end exactly between two sixth decimals, where two engines
    round apart. Both sides add the same hair to means."""
    return 1e-8 if "mean" in name else 0.0


def rolling_sql(sensors, windows, stats, ratio=False):
    """The features by window functions over the filled series."""
    cols, frames = [], []
    for win, w in windows.items():
        frames.append(f"w_{win} AS (PARTITION BY f.entity_id ORDER BY ts ROWS {w - 1} PRECEDING)")
    longest = max(windows, key=windows.get)
    for s in sensors:
        for win, w in windows.items():
            gate = f"row_no >= {max(1, w // 3)}"
            body = {"mean": f"CASE WHEN {gate} THEN avg({s}) OVER w_{win} END",
                    "std": f"CASE WHEN {gate} THEN coalesce(stddev_samp({s}) OVER w_{win}, 0) ELSE 0 END",
                    "p95": f"CASE WHEN {gate} THEN quantile_cont({s}, 0.95) OVER w_{win} END",
                    "exceed": f"CASE WHEN {gate} THEN avg(({s} > b_{s}.p90)::INT) OVER w_{win} END"}
            cols += [f"round({body[k]} + {off_half(k)}, 6) AS {s}__{k}_{win}" for k in stats]
        if ratio:
            cols.append(f"round(CASE WHEN row_no >= {windows[longest] // 3} AND abs(b_{s}.mean) > 1e-6 "
                        f"THEN avg({s}) OVER w_{longest} / abs(b_{s}.mean) END, 6) AS {s}__baseline_ratio")
    joins = " ".join(f"LEFT JOIN fx_baseline b_{s} ON b_{s}.entity_id = f.entity_id AND b_{s}.sensor = '{s}'"
                     for s in sensors)
    return sql(f"SELECT f.entity_id, ts, {', '.join(cols)} FROM fx_filled f {joins} WINDOW {', '.join(frames)}",
               "fx_filled", "fx_baseline")


query("jn_9_features_with_context", joins._features_with_context_sql())(joins._features_with_context)


def _rolling(spark, sf, sensors, windows, engine, names, stats=STATS):
    feats = rolling_features(fx.telemetry(spark, sf), sensors, fx_baseline(spark, sf, sensors), windows=windows,
                             engine=engine, chunk_rows=fx.CHUNK, stats=stats)
    return feats.select("entity_id", "ts", *[r(F.col(n) + off_half(n)).alias(n) for n in names])


for _id, _stat in (("win_2_rolling_mean", "mean"), ("win_3_rolling_std", "std"), ("win_4_rolling_p95", "p95"),
                   ("win_5_rolling_exceedance", "exceed")):
    def _make(name, stat):
        @query(name, rolling_sql(fx.SENSORS, ALL, (stat,)))
        def _(spark, sf):
            return _rolling(spark, sf, fx.SENSORS, ALL, "halo", [f"{s}__{stat}_{w}" for s in fx.SENSORS for w in ALL], (stat,))

        frames = SHORT if stat == "p95" else ALL  # the built-in percentile is refused for long frames

        @query(f"{name}_native", rolling_sql(fx.SENSORS, frames, (stat,)))
        def _(spark, sf):
            return _rolling(spark, sf, fx.SENSORS, frames, "native", [f"{s}__{stat}_{w}" for s in fx.SENSORS for w in frames], (stat,))
    _make(_id, _stat)


@query("win_6_baseline_ratio", rolling_sql(fx.SENSORS, {"7d": 1008}, (), ratio=True))
def _(spark, sf):
    return _rolling(spark, sf, fx.SENSORS, {"7d": 1008}, "halo", [f"{s}__baseline_ratio" for s in fx.SENSORS], ())


_W = "OVER (PARTITION BY entity_id ORDER BY ts)"


@query("win_7_lag_differences", sql(f"""
    SELECT entity_id, ts, round(coalesce(c - lag(c) {_W}, 0), 6) + 0.0 AS cable_rate,
      round(greatest(coalesce(m - lag(m) {_W}, 0), 0), 6) + 0.0 AS metal_particle_rate,
      round(d - lag(d, 6) {_W}, 6) + 0.0 AS t_bearing_delta_roc, round(s - lag(s, 6) {_W}, 6) + 0.0 AS t_stator_roc
    FROM (SELECT entity_id, ts, cable_windings_from_calibration_point AS c, metal_particle_count AS m,
      generator_bearing_front_temperature_c - nacelle_ambient_temperature_c AS d, stator_temperature_1_c AS s FROM fx_scada)""",
    "fx_scada"))
def _(spark, sf):
    out = domain.add_domain_features(fx.scada(spark, sf), chunk_rows=fx.CHUNK)
    return out.select("entity_id", "ts", *[r(s.name).alias(s.name) for s in domain.STEPS])


@query("win_8_rising_edges", sql("SELECT entity_id, family, event_start FROM fx_starts", "fx_starts"))
def _(spark, sf):
    return ev.event_starts(fx.scored(spark, sf))


@query("win_9_clusters", sql("SELECT * FROM fx_clusters", "fx_clusters"))
def _(spark, sf):
    return flt.cluster_events(fx.faults(spark, sf), fx.GAP_H)


@query("win_10_first_per_bucket", sql("SELECT entity_id, ts, family, code, message, status, event_ts, event_id FROM fx_faults",
                                      "fx_faults"))
def _(spark, sf):
    return fx.faults(spark, sf)


def _smooth_sql(n):
    left, right = n // 2, n - n // 2 - 1
    return f"""SELECT family, {n} AS n, tp, fp, fn, round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6)::DOUBLE AS precision,
      round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6)::DOUBLE AS recall FROM (
      SELECT family, count(*) FILTER (WHERE a AND is_pre) AS tp, count(*) FILTER (WHERE a AND NOT is_pre) AS fp,
        count(*) FILTER (WHERE NOT a AND is_pre) AS fn FROM (
        SELECT family, is_pre, own, round(avg(score) OVER (PARTITION BY entity_id, family ORDER BY k
          ROWS BETWEEN {left} PRECEDING AND {right} FOLLOWING), 9) >= 0.2::DOUBLE AS a FROM (
          SELECT *, true AS own FROM fx_ranked UNION ALL
          SELECT * REPLACE (1 - k AS k), false FROM fx_ranked WHERE k <= {left} UNION ALL
          SELECT * REPLACE (2 * n + 1 - k AS k), false FROM fx_ranked WHERE k > n - {right})) WHERE own GROUP BY 1)"""


@query("win_11_smoothed_scores", sql(" UNION ALL ".join(_smooth_sql(n) for n in (1, 3, 6, 12)), "fx_ranked"))
def _(spark, sf):
    rows = fx.scored_table(spark, sf).select("entity_id", "family", "ts", "is_pre", "score")
    parts = []
    for n in (1, 3, 6, 12):
        smooth = smooth_centered(rows, "score", n, ["entity_id", "family"], chunk_rows=fx.CHUNK)
        cm = ev.confusion(smooth, F.round("smoothed", 9) >= 0.2, F.col("is_pre"))
        parts.append(cm.select("family", F.lit(n).alias("n"), "tp", "fp", "fn", r("precision").alias("precision"),
                               r("recall").alias("recall")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("win_12_context_rows", sql("""
    SELECT entity_id, ts, row_no, is_new FROM (SELECT *, ts > TIMESTAMP '2024-01-20' AS is_new,
      min(row_no) FILTER (WHERE ts > TIMESTAMP '2024-01-20') OVER (PARTITION BY entity_id) AS f FROM fx_filled)
    WHERE row_no >= f - 1008""", "fx_filled"))
def _(spark, sf):
    tel = fx.telemetry(spark, sf).select("entity_id", "ts")
    mark = tel.select("entity_id").distinct().withColumn("stored_until", F.lit("2024-01-20").cast("timestamp"))
    return nightly.with_context(tel, mark).select("entity_id", "ts", "row_no", "is_new")


@query("win_12_trailing_rows", sql("""SELECT entity_id, ts, n_events FROM (SELECT *, row_number() OVER (
    PARTITION BY entity_id ORDER BY ts DESC) AS k FROM fx_telemetry) WHERE k <= 1008""", "fx_telemetry"))
def _(spark, sf):
    return nightly.trailing_rows(fx.telemetry(spark, sf).select("entity_id", "ts", "n_events"))


def stored_history(spark, sf, *columns):
    """The telemetry as a history of three increments with its block index."""
    rows = fx.telemetry(spark, sf).select("entity_id", "ts", *columns)
    store = History(spark, fresh_path(spark, "history"), days=fx.BLOCK_DAYS)
    for i, (a, b) in enumerate((("2000-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2100-01-01"))):
        store.append(rows.where((F.col("ts") >= F.lit(a).cast("timestamp")) & (F.col("ts") < F.lit(b).cast("timestamp"))), i)
    return store


@query("win_12_history_context", sql("""
    SELECT entity_id, ts, row_no, is_new FROM (SELECT *, ts > TIMESTAMP '2024-01-20' AS is_new,
      min(row_no) FILTER (WHERE ts > TIMESTAMP '2024-01-20') OVER (PARTITION BY entity_id) AS f FROM fx_filled)
    WHERE row_no >= f - 1008""", "fx_filled"))
def _(spark, sf):
    """The same from the stored history: the block index tells from where to read."""
    store = stored_history(spark, sf)
    mark = store.known().select("entity_id", F.lit("2024-01-20").cast("timestamp").alias("stored_until"))
    return store.trailing(1008, mark).select("entity_id", "ts", "row_no", "is_new")


@query("win_13_consecutive", sql("""SELECT entity_id, ts, k >= 3 AND coalesce(min(CASE WHEN abs(s_click - s_view) > 1.5 THEN 1 ELSE 0 END)
    OVER (PARTITION BY entity_id ORDER BY ts ROWS 2 PRECEDING), 0) = 1 AS confirmed FROM (SELECT *, row_no AS k FROM fx_filled)""",
    "fx_filled"))
def _(spark, sf):
    filled = fill_forward(fx.telemetry(spark, sf).select("entity_id", "ts", *fx.SENSORS), KEY, "ts", fx.SENSORS)
    out = domain.confirm_consecutive(filled, F.abs(F.col("s_click") - F.col("s_view")) > 1.5, 3, chunk_rows=fx.CHUNK)
    return out.select("entity_id", "ts", "confirmed")


@query("win_14_all_features", rolling_sql(fx.SENSORS, ALL, ("mean", "std", "p95", "exceed"), ratio=True))
def _(spark, sf):
    return _rolling(spark, sf, fx.SENSORS, ALL, "halo", feature_names(fx.SENSORS))


def _domain_sensors(columns):
    """The sensors of all families that the readings and the domain features offer."""
    return list(dict.fromkeys(s for group in config.FAMILY_SENSORS.values() for s in group if s in columns))


def _domain_sql(digits=4):
    """Domain features, filling, baseline and frames of all these sensors; every value gets the same hair before rounding."""
    made = {c: expr.format(**scalars._LISTS) for columns in scalars._SC.values() for c, expr in columns}
    steps = {"cable_rate": f"coalesce(cable_windings_from_calibration_point - lag(cable_windings_from_calibration_point) {_W}, 0)",
             "metal_particle_rate": f"greatest(coalesce(metal_particle_count - lag(metal_particle_count) {_W}, 0), 0)",
             "t_bearing_delta_roc": f"t_bearing_delta - lag(t_bearing_delta, 6) {_W}",
             "t_stator_roc": f"stator_temperature_1_c - lag(stator_temperature_1_c, 6) {_W}"}
    sensors = _domain_sensors({name for name, *_ in fx.READINGS} | set(made) | set(steps))
    frames = ", ".join(f"w_{win} AS (PARTITION BY entity_id ORDER BY ts ROWS {w - 1} PRECEDING)" for win, w in ALL.items())
    longest = max(ALL, key=ALL.get)
    cols = []
    for s in sensors:
        for win, w in ALL.items():
            gate = f"row_no >= {max(1, w // 3)}"
            body = {"mean": f"CASE WHEN {gate} THEN avg({s}) OVER w_{win} END",
                    "std": f"CASE WHEN {gate} THEN coalesce(stddev_samp({s}) OVER w_{win}, 0) ELSE 0 END",
                    "p95": f"CASE WHEN {gate} THEN quantile_cont({s}, 0.95) OVER w_{win} END",
                    "exceed": f"CASE WHEN {gate} THEN avg(({s} > {s}__p90)::INT) OVER w_{win} END"}
            cols += [f"round({body[k]} + 1e-8, {digits}) AS {s}__{k}_{win}" for k in STATS]
        cols.append(f"round(CASE WHEN row_no >= {ALL[longest] // 3} AND abs(coalesce({s}__mean, 1)) > 1e-6 "
                    f"THEN avg({s}) OVER w_{longest} / abs(coalesce({s}__mean, 1)) END + 1e-8, {digits}) AS {s}__baseline_ratio")
    return sql(f"""SELECT entity_id, ts, {", ".join(cols)} FROM (
      WITH made AS (SELECT *, {", ".join(f"{expr} AS {c}" for c, expr in made.items())} FROM fx_scada),
        stepped AS (SELECT *, {", ".join(f"{expr} AS {c}" for c, expr in steps.items())} FROM made),
        filled AS (SELECT entity_id, ts, row_number() OVER w AS row_no, {", ".join(f"coalesce(last_value({s} IGNORE NULLS) OVER w, 0) AS {s}" for s in sensors)}
          FROM stepped WINDOW w AS (PARTITION BY entity_id ORDER BY ts ROWS UNBOUNDED PRECEDING)),
        base AS (SELECT entity_id, {", ".join(f"round(avg({s}), 6) AS {s}__mean, round(quantile_cont({s}, 0.9), 6) AS {s}__p90" for s in sensors)}
          FROM stepped JOIN (SELECT entity_id, min(ts) + INTERVAL {fx.BASELINE_DAYS} DAY AS til FROM stepped GROUP BY 1) USING (entity_id)
          WHERE ts < til GROUP BY 1)
      SELECT * FROM filled JOIN base USING (entity_id)) WINDOW {frames}""", "fx_scada")


@query("win_14_domain_sensors", _domain_sql())
def _(spark, sf):
    """Every sensor of every family that the readings offer, computed once and viewed per family."""
    df = materialize(domain.add_domain_features(fx.scada(spark, sf), chunk_rows=fx.CHUNK), "domain")
    wanted = _domain_sensors(df.columns)
    out = rolling_features(df, wanted, baseline(df, wanted, days=fx.BASELINE_DAYS), chunk_rows=fx.CHUNK)
    return out.select("entity_id", "ts", *[rounded(F.col(c) + 1e-8, 4).alias(c) for c in feature_names(wanted)])
