"""Regular time bins, dashboard documents, samples and latest states."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadtime.plans.lineage import join_sized
from leadtime.plans.series import HOUR_US, hours_between, interval_join, number_rows

#: Hexadecimal digits of a hash by which a sample counts first.
PREFIX = 4


def resample(df: DataFrame, every: str, aggs: Sequence[Column], by: Sequence[str] = ("entity_id", "family"),
             time: str = "ts", fill_empty: bool = True, offset: str | None = None) -> DataFrame:
    """Aggregates per clock-aligned bin (column ``bin``). Bins without rows are emitted with NULLs."""
    start = F.window(time, every, startTime=offset).start if offset else F.window(time, every).start
    seen = df.withColumn("bin", start).groupBy(*by, "bin").agg(*aggs)
    if not fill_empty:
        return seen
    spine = (seen.groupBy(*by)
             .agg(F.sequence(F.min("bin"), F.max("bin"), F.expr(f"INTERVAL {every}")).alias("_b"))
             .select(*by, F.explode("_b").alias("bin")))
    return spine.join(seen, [*by, "bin"], "left")


def alert_timeline(scored: DataFrame, lead_hours: Column, every: str = "6 hours",
                   by: Sequence[str] = ("entity_id", "family"), time: str = "ts",
                   score_digits: int = 3, hour_digits: int = 1) -> DataFrame:
    """First reading, mean alert score, mean prediction and any-positive flag per bin."""
    rows = scored.withColumns({"_score": F.round(1 - F.col("pred_h") / lead_hours, score_digits),
                               "_pred": F.round("pred_h", hour_digits)})
    # the means are those of exact decimals, so rounding them doesn't depend on the order of the rows
    score, pred = (F.sum(F.col(c).cast(f"decimal(28,{d})")) / F.count(c) for c, d in (("_score", score_digits), ("_pred", hour_digits)))
    return resample(rows, every, [
        F.min(time).alias("first_ts"), F.round(score, score_digits).cast("double").alias("alert_score"),
        F.round(pred, hour_digits).cast("double").alias("pred_h"), F.max(F.col("is_pre").cast("int")).alias("is_pre")], by, time)


def weekly_share(labels: DataFrame, by: Sequence[str] = ("family",), time: str = "ts") -> DataFrame:
    """Share of positives per week, Monday to Sunday, labelled with the Sunday; empty weeks are NULL."""
    monday = F.date_trunc("week", time)
    seen = labels.withColumn("_m", monday).groupBy(*by, "_m").agg(
        F.avg(F.col("is_pre").cast("int")).alias("share_pos"))
    spine = (seen.groupBy(*by).agg(F.sequence(F.min("_m"), F.max("_m"), F.expr("INTERVAL 7 DAYS")).alias("_w"))
             .select(*by, F.explode("_w").alias("_m")))
    return spine.join(seen, [*by, "_m"], "left").select(
        *by, (F.col("_m") + F.expr("INTERVAL 6 DAYS")).alias("week"), "share_pos")


def sample_rows(df: DataFrame, n: int, key: Sequence[str], by: Sequence[str] = ("family",),
                seed: int = 42) -> DataFrame:
    """At most ``n`` rows per group without replacement, the same ones on every run.

    Rows are ordered by a hash of their key. The hashes are first counted by their first ``PREFIX`` digits, combined
    before the shuffle; the prefix in which the ``n``-th hash of a group lies is known from the counts, and rows behind
    it are dropped where they are read. About ``n`` rows and one in 65,536 of a group are ranked, however large ``n`` is.
    """
    by = list(by)
    text = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]
    hashed = (df.withColumn("_h", F.md5(F.concat_ws("|", *text, F.lit(str(seed))).cast("binary")))
              .withColumn("_prefix", F.substring("_h", 1, PREFIX)))
    upto = Window.partitionBy(*by).orderBy("_prefix")  # a row per prefix
    counts = hashed.groupBy(*by, "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    last = (counts.withColumn("_n", F.sum("_n").over(upto)).where(F.col("_n") >= n)
            .groupBy(*by).agg(F.min("_prefix").alias("_last")))
    some = join_sized(hashed, last, by, "left").where(F.col("_last").isNull() | (F.col("_prefix") <= F.col("_last")))
    order = Window.partitionBy(*by).orderBy("_h", *key)
    return some.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= n).select(*df.columns)


def latest(df: DataFrame, by: Sequence[str] = ("entity_id",), time: str = "ts") -> DataFrame:
    """The last row of every group, found with map-side reduction."""
    rest = [c for c in df.columns if c not in by]
    return (df.groupBy(*by).agg(F.max_by(F.struct(*rest), F.col(time)).alias("_r"))
            .select(*[c if c in by else F.col(f"_r.{c}").alias(c) for c in df.columns]))


def high_water_mark(store: DataFrame, by: Sequence[str] = ("family",), time: str = "ts") -> DataFrame:
    return store.groupBy(*by).agg(F.max(time).alias("stored_until"))


def common_mark(marks: DataFrame) -> DataFrame:
    """Time up to which every family is stored."""
    return marks.agg(F.min("stored_until").alias("stored_until"))


def time_range(df: DataFrame, by: Sequence[str] = (), time: str = "ts") -> DataFrame:
    return df.groupBy(*by).agg(F.min(time).alias("first_ts"), F.max(time).alias("last_ts"),
                               F.count(F.lit(1)).alias("n_rows"))


def event_slice(df: DataFrame, faults: DataFrame, family: str, nth: int, columns: Sequence[str],
                days_before: float = 10, hours_after: float = 2, by: Sequence[str] = ("entity_id",),
                time: str = "ts") -> DataFrame:
    """Rows from ``days_before`` days before the n-th fault of a family to ``hours_after`` hours after it."""
    hours = days_before * 24
    picked = number_rows(faults.where(F.col("family") == family).select(*by, time).distinct(),
                         by, time).where(F.col("row_no") == nth)
    windows = picked.select(
        *by, F.col(time).alias("fault_ts"),
        F.timestamp_micros(F.unix_micros(time) - F.lit(int(hours * HOUR_US))).alias("_from"),
        F.timestamp_micros(F.unix_micros(time) + F.lit(int(hours_after * HOUR_US))).alias("_to"))
    pairs = interval_join(df, windows, by, time, "_from", "_to", hours=hours, include_end=True)
    return pairs.select(*by, time, "fault_ts", hours_between(F.col("fault_ts"), F.col(time)).alias("hours_before"),
                        *columns)


def dashboard_documents(metrics: DataFrame, timeline: DataFrame, events: DataFrame, scatter: DataFrame,
                        by: Sequence[str] = ("entity_id", "family")) -> DataFrame:
    """One JSON document per entity and family: metrics, timeline, events, scatter.

    The lists are bounded by design: one entry per 6-hour bin and per real event, and a sample of
    at most 800 points.
    """
    def listed(df, name):
        rest = [c for c in df.columns if c not in by]
        return df.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(*rest))).alias(name))

    values = [c for c in metrics.columns if c not in by]
    out = metrics.select(*by, F.struct(*values).alias("metrics"))
    for part, name in ((timeline, "timeline"), (events, "events"), (scatter, "scatter")):
        out = out.join(listed(part, name), list(by), "left")
    body = F.struct(*by, "metrics", "timeline", "events", "scatter")
    return out.select(*by, F.to_json(body, {"ignoreNullFields": "false"}).alias("document"))
