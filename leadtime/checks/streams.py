"""Streaming jobs run to the end of the given tables; their tables equal the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadtime import config
from leadtime.checks import fixtures as fx
from leadtime.checks.fixtures import sql
from leadtime.checks.joins import fx_baseline
from leadtime.checks.registry import query, r
from leadtime.checks.windows import off_half, rolling_sql
from leadtime.operators import faults as flt
from leadtime.plans.lineage import fresh_path, materialize
from leadtime.streaming import increments, jobs, since

CUTS = ("2024-01-08", "2024-01-15", "2024-01-23")
LATE_MINUTES = 40  # less than the watermark's hour


def _feed(spark, sf, late=False, repeated=False):
    """The event table as a feed of four files and a heartbeat, read one file per micro-batch.

    ``late``: every seventh event of the last minutes before a cut comes with the next file.
    ``repeated``: all events of those minutes come again with the next file. The heartbeat moves the
    watermark past everything, so the last bins and sessions are closed as well.
    """
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    file, near = F.lit(0), F.lit(False)
    for day in CUTS:
        cut = F.lit(day).cast("timestamp")
        file = file + (F.col("ts") >= cut).cast("int")
        near = near | ((F.col("ts") < cut) & (F.col("ts") >= cut - F.expr(f"INTERVAL {LATE_MINUTES} MINUTES")))
    if late:
        file = file + (near & (F.col("event_id") % 7 == 0)).cast("int")
    rows = events.withColumn("file", file)
    if repeated:
        rows = rows.unionByName(rows.where(near).withColumn("file", F.col("file") + 1))
    rows, path = materialize(rows, "events"), fresh_path(spark, "feed")
    for i in range(len(CUTS) + 1):
        rows.where(F.col("file") == i).drop("file").repartition(1).write.mode("append").parquet(path)
    last = {"ts": F.expr("timestamp '2100-01-01'"), "event_type": F.lit("error"), "props": F.lit('{"k": 1}')}
    beat = spark.range(1).select(*[last.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in events.schema])
    beat.repartition(1).write.mode("append").parquet(path)
    raw = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return fx.with_entity(raw)


def _status_of(events):
    kind, code = F.col("event_type"), F.get_json_object("props", "$.k").cast("int")
    return events.select(
        "entity_id", F.col("ts").alias("event_ts"), "event_id", code.alias("code"),
        F.when(kind == "error", "Stop").when(kind == "signup", "Warning").otherwise("Other").alias("status"),
        F.concat(F.lit("code "), code.cast("string")).alias("message"))


def _faults(spark, sf):
    critical = flt.critical_events(_status_of(_feed(spark, sf, late=True)))
    return flt.map_family(critical, fx.families(spark)).where("family IS NOT NULL")


def _split_telemetry(spark, sf):
    """Telemetry as three folders of consecutive days."""
    path = fresh_path(spark, "telemetry")
    tel = fx.telemetry(spark, sf).select("entity_id", "ts", *fx.SENSORS)
    third = F.when(F.col("ts") < F.lit("2024-01-11").cast("timestamp"), 0).when(
        F.col("ts") < F.lit("2024-01-21").cast("timestamp"), 1).otherwise(2)
    tel.withColumn("part", third).write.partitionBy("part").parquet(path)
    return tel.schema, path


def _run_features(spark, sf):
    schema, path = _split_telemetry(spark, sf)
    base = materialize(fx_baseline(spark, sf, fx.SENSORS), "baseline")
    store, check = fresh_path(spark, "store"), fresh_path(spark, "progress")
    for i in range(3):  # three nightly runs over a growing folder
        stream = spark.readStream.schema(schema).parquet(f"{path}/part={i}")
        handle = jobs.feature_batches(store, fx.SENSORS, base, config.WINDOWS)
        jobs.run_batches(stream, lambda df, n, h=handle, first=i: h(df, first + n), f"{check}/{i}")
    return spark.read.parquet(f"{store}/features")


@query("str_1_incremental_features", rolling_sql(fx.SENSORS, config.WINDOWS, ("mean", "std", "p95", "exceed"), ratio=True))
def _(spark, sf):
    """Three increments give the features of one full run."""
    out = _run_features(spark, sf).drop("batch_id")
    return out.select("entity_id", "ts", *[r(F.col(c) + off_half(c)).alias(c) for c in out.columns
                                           if c not in ("entity_id", "ts")])


NEAR_DAYS = 2  # readings of these days before a cut may come with the next part


def _run_late(spark, sf):
    """Three increments: every seventh reading near a cut comes late, the one after it twice, the last increment runs twice."""
    tel = fx.telemetry(spark, sf).select("entity_id", "ts", *fx.SENSORS)
    home, near = F.lit(0), F.lit(False)
    for day in ("2024-01-11", "2024-01-21"):
        cut = F.lit(day).cast("timestamp")
        home = home + (F.col("ts") >= cut).cast("int")
        near = near | ((F.col("ts") < cut) & (F.col("ts") >= cut - F.expr(f"INTERVAL {NEAR_DAYS} DAYS")))
    slot = F.floor(F.unix_seconds("ts") / 600) % 7
    rows = tel.withColumn("part", home + (near & (slot == 0)).cast("int"))
    rows = materialize(rows.unionByName(tel.where(near & (slot == 1)).withColumn("part", home + 1)), "increments")
    base = materialize(fx_baseline(spark, sf, fx.SENSORS), "baseline")
    store = increments.FeatureStore(fresh_path(spark, "store"), fx.SENSORS, base, windows=config.WINDOWS)
    for i in (0, 1, 2, 2):
        store.add(rows.where(F.col("part") == i).drop("part"), i)
    return store


@query("str_1_late_readings", rolling_sql(fx.SENSORS, config.WINDOWS, ("mean", "std", "p95", "exceed"), ratio=True))
def _(spark, sf):
    """Increments with late and repeated readings, one of them run again, give the features of one full run."""
    out = _run_late(spark, sf).features(spark)
    return out.select("entity_id", "ts", *[r(F.col(c) + off_half(c)).alias(c) for c in out.columns if c not in ("entity_id", "ts")])


@query("str_1_increment_counts", sql(f"""SELECT * FROM (
    WITH placed AS (SELECT entity_id, ts, (ts >= '2024-01-11')::INT + (ts >= '2024-01-21')::INT AS home,
        (ts < '2024-01-11' AND ts >= TIMESTAMP '2024-01-11' - INTERVAL {NEAR_DAYS} DAY)
          OR (ts < '2024-01-21' AND ts >= TIMESTAMP '2024-01-21' - INTERVAL {NEAR_DAYS} DAY) AS near,
        floor(epoch(ts) / 600)::BIGINT % 7 AS slot FROM fx_telemetry),
      given AS (SELECT entity_id, ts, home + (near AND slot = 0)::INT AS part, false AS again FROM placed
        UNION ALL SELECT entity_id, ts, home + 1, true FROM placed WHERE near AND slot = 1),
      known AS (SELECT p.entity_id, p.part, max(g.ts) AS until FROM (SELECT DISTINCT entity_id, part FROM given) p
        JOIN given g ON g.entity_id = p.entity_id AND g.part < p.part GROUP BY 1, 2)
    SELECT part::BIGINT AS increment, count(*) AS n_given, 0::BIGINT AS n_without_time, count(*) FILTER (WHERE again) AS n_repeated,
      count(*) FILTER (WHERE NOT again AND coalesce(ts <= until, false)) AS n_late,
      count(*) FILTER (WHERE NOT again AND NOT coalesce(ts <= until, false)) AS n_new
    FROM given LEFT JOIN known USING (entity_id, part) GROUP BY 1)""", "fx_telemetry"))
def _(spark, sf):
    """Rows of every increment: given, without a time, repeated, late and new."""
    counts = _run_late(spark, sf).counts(spark)
    return counts.select(F.col("increment").cast("long").alias("increment"), "n_given", "n_without_time", "n_repeated", "n_late", "n_new")


@query("str_2_replayed_batch", sql("SELECT entity_id, count(*) AS n, count(*) AS n_distinct FROM fx_telemetry GROUP BY 1",
                                   "fx_telemetry"))
def _(spark, sf):
    """A batch that runs twice leaves every row once."""
    schema, path = _split_telemetry(spark, sf)
    base = materialize(fx_baseline(spark, sf, fx.SENSORS), "baseline")
    store = fresh_path(spark, "store")
    handle = jobs.feature_batches(store, fx.SENSORS, base, config.WINDOWS)
    for i in (0, 1, 1, 2):
        handle(spark.read.schema(schema).parquet(f"{path}/part={i}"), i)
    return spark.read.parquet(f"{store}/features").groupBy("entity_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("ts").alias("n_distinct"))


@query("str_3_event_dedup", sql("""SELECT DISTINCT entity_id, code, time_bucket(INTERVAL '10 minutes', event_ts) AS ts
    FROM fx_status WHERE status IN ('Stop', 'Warning')""", "fx_status"))
def _(spark, sf):
    """Events that come again with the next file are met by the state of the earlier batch."""
    stream = jobs.dedup_events(flt.critical_events(_status_of(_feed(spark, sf, repeated=True))))
    path = fresh_path(spark, "dedup")
    jobs.run_to_table(stream.select("entity_id", "code", "ts"), path, fresh_path(spark, "progress"))
    return spark.read.parquet(path).where("entity_id IS NOT NULL")


@query("str_4_timeline", sql(f"""SELECT * FROM (SELECT CAST(user_id % 2 + 2 * (user_id // 150) + 1 AS INTEGER) AS entity_id,
    time_bucket(INTERVAL '6 hours', ts) AS bin, count(*) AS n, round(max(value), 6) AS top FROM events GROUP BY 1, 2)"""))
def _(spark, sf):
    """All bins, the last ones included, with late rows in their bins."""
    stream = jobs.timeline(_feed(spark, sf, late=True), {"n": F.count(F.lit(1)), "top": r(F.max("value"))})
    path = fresh_path(spark, "timeline")
    jobs.run_to_table(stream, path, fresh_path(spark, "progress"))
    return spark.read.parquet(path)


@query("str_5_fault_sessions", sql(f"""
    SELECT entity_id, family, min(ts) AS ts, max(ts) AS last_ts, count(*) AS n_faults FROM (SELECT *, sum(new) OVER (
      PARTITION BY entity_id, family ORDER BY ts, event_id) AS c FROM (SELECT entity_id, family, event_ts AS ts, event_id,
      CASE WHEN epoch_us(event_ts) - epoch_us(lag(event_ts) OVER (PARTITION BY entity_id, family ORDER BY event_ts, event_id))
        <= {fx.GAP_H} * 3600000000 THEN 0 ELSE 1 END AS new FROM fx_critical WHERE family IS NOT NULL))
    GROUP BY entity_id, family, c""", "fx_critical"))
def _(spark, sf):
    """All sessions; late faults join the session that they belong to."""
    stream = jobs.fault_sessions(_faults(spark, sf).withColumnRenamed("event_ts", "ts"), f"{fx.GAP_H} hours")
    path = fresh_path(spark, "sessions")
    jobs.run_to_table(stream, path, fresh_path(spark, "progress"))
    return spark.read.parquet(path)


@query("str_6_hours_since_last", sql("""SELECT entity_id, ts, round(CASE WHEN prev_ts IS NULL THEN 8760.0::DOUBLE
    ELSE (epoch_us(ts) - epoch_us(prev_ts)) / 3.6e9 END, 6) AS hours_since, family FROM fx_prev""", "fx_prev"))
def _(spark, sf):
    """All families, over five micro-batches with late faults and late readings; the state is keyed."""
    since.keyed_state(spark)
    feed, path = _feed(spark, sf, late=True), fresh_path(spark, "hours")
    events = flt.map_family(_status_of(feed), fx.families(spark))
    fault = F.col("status").isin(*config.FAULT_STATUSES) & ~F.col("code").isin(*fx.EXCLUDED)
    out = since.hours_since_stream(events.withColumn("family", F.when(fault, F.col("family"))), fx.FAMILIES)
    jobs.run_to_table(out, path, fresh_path(spark, "progress"))
    return spark.read.parquet(path).select("entity_id", "ts", "family", r("hours_since").alias("hours_since"))


@query("str_7_sliding_statistics", sql(f"""
    SELECT entity_id, w AS window_start, w + INTERVAL 1 HOUR AS window_end, count(*) AS n, round(max(value), 6) AS top FROM (
      SELECT CAST(user_id % 2 + 2 * (user_id // 150) + 1 AS INTEGER) AS entity_id, value, ts,
        unnest(generate_series(time_bucket(INTERVAL '10 minutes', ts) - INTERVAL 50 MINUTE,
          time_bucket(INTERVAL '10 minutes', ts), INTERVAL 10 MINUTE)) AS w FROM events)
    GROUP BY ALL"""))
def _(spark, sf):
    """All windows, with late rows in theirs."""
    stream = jobs.sliding_statistics(_feed(spark, sf, late=True), {"n": F.count(F.lit(1)), "top": r(F.max("value"))})
    path = fresh_path(spark, "sliding")
    jobs.run_to_table(stream, path, fresh_path(spark, "progress"))
    return spark.read.parquet(path)
