"""Round trips through every source and sink. The files are written by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadtime.checks import fixtures as fx
from leadtime.checks.fixtures import sql
from leadtime.checks.registry import query, r
from leadtime.functions.headers import clean_header
from leadtime.operators import evaluate as ev, report
from leadtime.operators.baseline import baseline
from leadtime.plans.lineage import fresh_path, materialize
from leadtime.sources import files, ranged, sinks

TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _status_csv(spark, sf):
    """The status log in its CSV form: text times, '-' for an open end, a comment line first."""
    st = fx.status(spark, sf)
    path = fresh_path(spark, "status")
    out = st.select(
        F.date_format("event_ts", TEXT).alias("Timestamp start"),
        F.when(F.col("status") == "Stop", F.date_format(F.col("event_ts") + F.expr("INTERVAL 1 HOUR"), TEXT))
        .otherwise("-").alias("Timestamp end"), F.lit("").alias("Duration"), F.col("status").alias("Status"),
        F.col("code").alias("Code"), F.col("message").alias("Message"), F.lit("").alias("Comment"),
        F.lit("c").alias("Service contract category"), F.lit("i").alias("IEC category"),
        F.year("event_ts").alias("year"), "entity_id")
    out.write.partitionBy("year", "entity_id").option("header", True).csv(path)
    return path


@query("src_1_file_discovery", sql("""SELECT entity_id, count(*) AS n FROM fx_status WHERE year(event_ts) IN (2023, 2024, 2025)
    GROUP BY 1""", "fx_status"))
def _(spark, sf):
    paths = files.yearly_globs(_status_csv(spark, sf), [2024], "year={year}*", "entity_id=*")
    df = spark.read.option("pathGlobFilter", "*.csv").option("header", True).schema(files.STATUS_SCHEMA).csv(paths)
    entity = F.regexp_extract(F.col("_metadata.file_path"), r"entity_id=(\d+)", 1).cast("int")
    return df.select(entity.alias("entity_id")).groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"))


SCADA = {"s_click": ('"Wind speed, sensor 1 (m/s)"', "wind_speed_sensor_1_ms"), "s_view": ("Power (kW)", "power_kw"),
         "s_purchase": ("Rotor speed (RPM)", "rotor_speed_rpm"), "s_signup": ("Nacelle position (°)", "nacelle_position"),
         "s_error": ("Reactive power (kvar)", "reactive_power_kvar")}
#: Column lines of the two halves of a month: the second one has a column more and no mark.
HEADS = {0: "# Date and time," + ",".join(title for title, _ in list(SCADA.values())[:4]),
         1: "Date and time," + ",".join(title for title, _ in SCADA.values())}


def _scada_files(spark, sf):
    """One text file per entity and half month, all sensors in the second half, and a file without a column line per entity."""
    tel = fx.telemetry(spark, sf).withColumn("half", (F.dayofmonth("ts") > 15).cast("int"))
    cells = [F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), *[F.coalesce(F.col(s).cast("string"), F.lit(("NaN", "")[i % 2])) for i, s in enumerate(SCADA)]]
    line = F.when(F.col("half") == 0, F.concat_ws(",", *cells[:5])).otherwise(F.concat_ws(",", *cells))
    data = tel.select("entity_id", "half", F.unix_seconds("ts").alias("pos"), line.alias("value"))
    halves = tel.select("entity_id", "half").distinct()
    other = tel.select("entity_id", F.lit(2).alias("half")).distinct()
    tops = halves.unionByName(other).select("entity_id", "half", F.explode(F.sequence(F.lit(-10), F.lit(-1))).alias("pos"))
    head = F.when(F.col("half") == 0, HEADS[0]).when(F.col("half") == 1, HEADS[1]).otherwise("# preamble")
    tops = tops.withColumn("value", F.when(F.col("pos") == -1, head).otherwise(
        F.concat(F.lit("# preamble "), F.col("pos").cast("string"))))
    path = fresh_path(spark, "scada")
    (tops.withColumn("pos", F.col("pos").cast("long")).unionByName(data).repartition("entity_id", "half")
     .sortWithinPartitions("entity_id", "half", "pos").select("entity_id", "half", "value")
     .write.partitionBy("entity_id", "half").text(path))
    return path


@query("src_2_scada_csv", sql("SELECT entity_id, ts AS timestamp, " + ", ".join(
    f"CASE WHEN day(ts) > 15 OR '{s}' <> 's_error' THEN round({s}, 6) END AS {name}" for s, (_, name) in SCADA.items()) + " FROM fx_telemetry", "fx_telemetry"))
def _(spark, sf):
    """All sensors; the first half has no column for the last one."""
    df = files.read_scada(spark, [_scada_files(spark, sf) + "/*/*"], entity_from=r"entity_id=(\d+)")
    return df.select("entity_id", "timestamp", *[r(name).alias(name) for _, name in SCADA.values()])


@query("src_2_file_probe", sql("""SELECT entity_id, half, half < 2 AS accepted, CASE half WHEN 0 THEN true WHEN 1 THEN false END AS marked,
    CASE WHEN half = 2 THEN 'no column line on line 10' END AS reason FROM (SELECT DISTINCT entity_id, (day(ts) > 15)::INT AS half FROM fx_telemetry
    UNION ALL SELECT DISTINCT entity_id, 2 FROM fx_telemetry)""", "fx_telemetry"))
def _(spark, sf):
    """What was read and what was skipped, and why."""
    found = files.probe_files(spark, [_scada_files(spark, sf) + "/*/*"])
    part = lambda name: F.regexp_extract("file", rf"{name}=(\d+)", 1).cast("int").alias(name)
    return found.select(part("entity_id"), part("half"), "accepted", "marked", "reason")


@query("src_3_clean_header", sql("""
    SELECT 'timestamp,' || event_type || '_speed_sensor_' || regexp_extract(props, '[0-9]+') || '_ms,power_kw' AS header,
      count(*) AS n FROM events GROUP BY 1"""))
def _(spark, sf):
    k = F.get_json_object("props", "$.k")
    line = F.concat(F.lit('# Date and time,"'), F.initcap("event_type"), F.lit(" speed, sensor "), k,
                    F.lit(' (m/s)",Power  (kW)'))
    return (fx.table(spark, sf, "events").select(clean_header(line).alias("header"))
            .groupBy("header").agg(F.count(F.lit(1)).alias("n")))


@query("src_4_status_csv", sql("SELECT status, code, count(*) AS n FROM fx_status GROUP BY 1, 2", "fx_status"))
def _(spark, sf):
    df = files.read_status(spark, _status_csv(spark, sf) + "/*/*")
    return df.groupBy(F.col("Status").alias("status"), F.col("Code").alias("code")).agg(F.count(F.lit(1)).alias("n"))


@query("src_5_status_times", sql("""
    SELECT code, event_ts AS timestamp_start, CASE WHEN status = 'Stop' THEN event_ts + INTERVAL 1 HOUR END AS timestamp_end
    FROM fx_status""", "fx_status"))
def _(spark, sf):
    return files.read_status_events(spark, _status_csv(spark, sf) + "/*/*").select(
        F.col("Code").alias("code"), "timestamp_start", "timestamp_end")


@query("src_6_parquet_scan", """SELECT event_type, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts
    FROM events GROUP BY 1""")
def _(spark, sf):
    return files.read_telemetry(spark, f"{sf}/events.parquet").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query("src_7_optional_store", """SELECT 'orders' AS store, count(*) AS n, sum(o_custkey)::BIGINT AS keys FROM orders
    UNION ALL SELECT 'absent', 0, 0""")
def _(spark, sf):
    there = files.read_or_empty(spark, f"{sf}/orders.parquet", "o_orderkey bigint, o_custkey bigint")
    absent = files.read_or_empty(spark, fresh_path(spark, "absent"), there.schema)
    both = [df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("o_custkey"), F.lit(0)).alias("keys"))
            .select(F.lit(name).alias("store"), "n", "keys") for name, df in (("orders", there), ("absent", absent))]
    return both[0].unionByName(both[1])


@query("src_8_baseline_json", sql("SELECT entity_id, sensor, mean, p90 FROM fx_baseline", "fx_baseline"))
def _(spark, sf):
    base = baseline(fx.telemetry(spark, sf), fx.SENSORS, days=fx.BASELINE_DAYS)
    path = fresh_path(spark, "baseline")
    sinks.baseline_documents(base, 3).write.json(path)
    return files.read_baseline(spark, path)


@query("snk_1_parquet_overwrite", "SELECT l_returnflag, count(*) AS n, round(sum(l_tax), 4) AS tax FROM lineitem GROUP BY 1")
def _(spark, sf):
    path = fresh_path(spark, "lineitem")
    rows = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_tax")
    sinks.write_table(rows.select("l_orderkey", "l_returnflag", (F.col("l_tax") * 2).alias("l_tax")), path)
    sinks.write_table(rows, path)
    return spark.read.parquet(path).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), r(F.sum("l_tax"), 4).alias("tax"))


@query("snk_2_single_csv", sql("SELECT code, count(*) AS n FROM fx_status GROUP BY 1", "fx_status"))
def _(spark, sf):
    path = fresh_path(spark, "catalog")
    counts = fx.status(spark, sf).groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    sinks.write_csv(counts, path, one_file=True)
    return spark.read.option("header", True).schema("code int, n bigint").csv(path)


def _upsert_sides(spark, sf):
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = orders.where("o_orderstatus IN ('O', 'P')").withColumn("o_totalprice", -F.col("o_totalprice"))
    return orders.where("o_orderstatus IN ('F', 'P')"), new


@query("snk_3_upsert_last", """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus IN ('O', 'P') THEN -o_totalprice
    ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')""")
def _(spark, sf):
    return sinks.upsert(*_upsert_sides(spark, sf), ["o_orderkey"], "last")


@query("snk_3_upsert_first", """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN -o_totalprice
    ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')""")
def _(spark, sf):
    return sinks.upsert(*_upsert_sides(spark, sf), ["o_orderkey"], "first")


@query("snk_3_ranged_merge", """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus IN ('O', 'P') THEN -o_totalprice
    ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')""")
def _(spark, sf):
    """The same merge into a store of key ranges, in two batches that commit a version each."""
    existing, new = _upsert_sides(spark, sf)
    root = fresh_path(spark, "ranged")
    ranged.create(existing, root, ["o_orderkey"], file_rows=2_000)
    for status in ("O", "P"):
        ranged.merge(new.where(F.col("o_orderstatus") == status), root, ["o_orderkey"], file_rows=2_000)
    return ranged.read(spark, root)


@query("snk_3_fault_log_upsert", sql("""SELECT entity_id, ts, family, code, status FROM fx_faults""", "fx_faults"))
def _(spark, sf):
    """A log written up to the middle and updated with a batch that overlaps it."""
    log = fx.faults(spark, sf)
    early, late = log.where("day(ts) <= 20"), log.where("day(ts) >= 10")
    return sinks.upsert(early, late, ["entity_id", "ts", "family", "code"], "first", ["event_ts"]).select(
        "entity_id", "ts", "family", "code", "status")


@query("snk_4_versioned_commit", """SELECT count(*) FILTER (WHERE o_orderstatus IN ('F', 'P')) AS n_before,
    count(*) FILTER (WHERE o_orderstatus IN ('F', 'O', 'P')) AS n_after FROM orders""")
def _(spark, sf):
    """The store that was read is still whole after the merged version has been written."""
    existing, new = _upsert_sides(spark, sf)
    root = fresh_path(spark, "store")
    first = sinks.commit_version(existing, root)
    merged = sinks.upsert(files.read_or_empty(spark, sinks.current_version(spark, root), existing.schema), new, ["o_orderkey"])
    sinks.commit_version(merged, root)
    second = sinks.current_version(spark, root)
    n = [spark.read.parquet(p).agg(F.count(F.lit(1)).alias(c)) for p, c in ((first, "n_before"), (second, "n_after"))]
    return n[0].unionByName(n[1], allowMissingColumns=True).agg(
        F.max("n_before").alias("n_before"), F.max("n_after").alias("n_after"))


@query("snk_5_dry_run", """SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus IN ('F', 'O', 'P') GROUP BY 1""")
def _(spark, sf):
    """``upsert`` only describes the merged rows; nothing is written."""
    return sinks.upsert(*_upsert_sides(spark, sf), ["o_orderkey"]).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"))


@query("snk_6_float32", """SELECT event_id, round(value::FLOAT::DOUBLE, 4) AS value,
    try_cast(event_type AS FLOAT)::DOUBLE AS event_type, regexp_extract(props, '[0-9]+')::FLOAT::DOUBLE AS k FROM events""")
def _(spark, sf):
    ev_ = fx.table(spark, sf, "events").select("event_id", "ts", "value", "event_type",
                                               F.get_json_object("props", "$.k").alias("k"))
    out = sinks.to_float32(ev_, keep=["event_id"])
    return out.select("event_id", r(F.col("value").cast("double"), 4).alias("value"),
                      F.col("event_type").cast("double").alias("event_type"), F.col("k").cast("double").alias("k"))


@query("snk_7_dashboard_json", sql("""
    SELECT entity_id, family, n_bins, n_events, n_points, n_pos, first_bin, round(mae_raw, 6) AS mae_raw, round(mae_cal, 6) AS mae_cal,
      precision, recall, round(n_detected / n_events, 4) AS event_recall, lead_hours, alert_h, test_start, test_end, round(best_total, 6) AS best_total, n_detected FROM (
      SELECT entity_id, family, 1 + date_diff('hour', min(time_bucket(INTERVAL '6 hours', ts)),
        max(time_bucket(INTERVAL '6 hours', ts))) // 6 AS n_bins, least(800, count(*) FILTER (WHERE is_pre)) AS n_points,
        count(*) FILTER (WHERE is_pre) AS n_pos, strftime(min(time_bucket(INTERVAL '6 hours', ts)), '%Y-%m-%d %H:%M') AS first_bin,
        avg(abs(hours_to - raw_h)) FILTER (WHERE is_pre) AS mae_raw, avg(abs(hours_to - pred_h)) FILTER (WHERE is_pre) AS mae_cal,
        round(coalesce(count(*) FILTER (WHERE is_pre AND pred_h <= alert_h) / nullif(count(*) FILTER (WHERE pred_h <= alert_h), 0), 0), 4) AS precision,
        round(coalesce(count(*) FILTER (WHERE is_pre AND pred_h <= alert_h) / nullif(count(*) FILTER (WHERE is_pre), 0), 0), 4) AS recall,
        any_value(lead_hours) AS lead_hours, any_value(alert_h) AS alert_h, strftime(min(ts), '%Y-%m-%d %H:%M') AS test_start, strftime(max(ts), '%Y-%m-%d %H:%M') AS test_end
      FROM fx_scored GROUP BY 1, 2)
    JOIN (SELECT entity_id, family, count(*) AS n_events, sum(best_score) AS best_total, count(*) FILTER (WHERE best_score <= alert_h) AS n_detected
      FROM fx_windows GROUP BY 1, 2) USING (entity_id, family)""",
    "fx_scored", "fx_windows"))
def _(spark, sf):
    keys = ["entity_id", "family"]
    scored = fx.scored_table(spark, sf)
    lines = report.alert_timeline(scored, fx.lead())
    events = ev.event_windows(scored, fx.lead(), 12).withColumn("detected", F.col("best_score") <= fx.alert_h())
    metrics = ev.dashboard_metrics(scored, events, fx.lead(), fx.alert_h(), keys)
    points = report.sample_rows(scored.where("is_pre").select(*keys, "ts", "hours_to", "pred_h"), 800, ["ts"], keys)
    path = fresh_path(spark, "dashboard")
    sinks.write_json_lines(report.dashboard_documents(metrics, lines, events, points), path)
    schema = ("entity_id int, family string, metrics struct<n: bigint, mae_raw: double, mae_cal: double, precision: double, recall: double, "
              "event_recall: double, lead_hours: double, alert_h: double, test_start: timestamp, test_end: timestamp, generated: timestamp>, "
              "timeline array<struct<bin: timestamp>>, events array<struct<best_score: double, detected: boolean>>, scatter array<struct<hours_to: double>>")
    doc = spark.read.text(path).select(F.from_json("value", schema).alias("d")).where("d.metrics.generated IS NOT NULL")
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm")
    return doc.select(
        "d.entity_id", "d.family", F.size("d.timeline").alias("n_bins"), F.size("d.events").alias("n_events"), F.size("d.scatter").alias("n_points"),
        F.col("d.metrics.n").alias("n_pos"), stamp(F.array_min("d.timeline.bin")).alias("first_bin"),
        *[r(F.col(f"d.metrics.{c}")).alias(c) for c in ("mae_raw", "mae_cal", "precision", "recall", "event_recall", "lead_hours", "alert_h")],
        *[stamp(F.col(f"d.metrics.{c}")).alias(c) for c in ("test_start", "test_end")],
        r(F.aggregate("d.events.best_score", F.lit(0.0), lambda a, x: a + x)).alias("best_total"),
        F.size(F.filter("d.events.detected", lambda x: x)).cast("long").alias("n_detected"))


@query("snk_8_snapshot", sql("SELECT entity_id, " + ", ".join(
    f"max(ts) FILTER (WHERE family = '{f.name}') AS {f.name}__ts, arg_max(is_pre, ts) FILTER (WHERE family = '{f.name}') AS {f.name}__is_pre, "
    f"round(arg_max(hours_to, ts) FILTER (WHERE family = '{f.name}'), 6) AS {f.name}__hours_to" for f in fx.FAMILIES)
    + ", '2024-02-01' AS date FROM fx_last GROUP BY 1", "fx_last"))
def _(spark, sf):
    rows = materialize(fx.labels(spark, sf), "labels")
    stores = {f.name: rows.where(F.col("family") == f.name).select("entity_id", "ts", "is_pre", r("hours_to").alias("hours_to")) for f in fx.FAMILIES}
    path = fresh_path(spark, "snapshot")
    sinks.append_rows(sinks.family_snapshot(stores, F.lit("2024-02-01")), path)
    return spark.read.parquet(path)


@query("snk_8_append", "SELECT o_orderstatus, 2 * count(*) AS n FROM orders GROUP BY 1")
def _(spark, sf):
    path = fresh_path(spark, "log")
    rows = fx.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    sinks.append_rows(rows, path)
    sinks.append_rows(rows, path)
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


