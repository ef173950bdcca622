"""Alert quality per row and per real event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadtime.functions.scalars import guarded_ratio, harmonic
from leadtime.plans.series import HOUR_US, interval_join, previous_row

SERIES = ("entity_id", "family")


def confusion(scored: DataFrame, alert: Column, label: Column, by: Sequence[str] = ("family",)) -> DataFrame:
    """tn, fp, fn, tp with precision, recall and F1; a rate with denominator 0 is 0."""
    a, y = F.coalesce(alert, F.lit(False)), F.coalesce(label, F.lit(False))
    counts = scored.groupBy(*by).agg(
        F.count_if(~a & ~y).alias("tn"), F.count_if(a & ~y).alias("fp"),
        F.count_if(~a & y).alias("fn"), F.count_if(a & y).alias("tp"))
    rated = counts.withColumns({
        "precision": guarded_ratio(F.col("tp"), F.col("tp") + F.col("fp")),
        "recall": guarded_ratio(F.col("tp"), F.col("tp") + F.col("fn"))})
    return rated.withColumn("f1", harmonic(F.col("precision"), F.col("recall")))


def regression_metrics(scored: DataFrame, by: Sequence[str] = ("family",), actual: str = "hours_to",
                       raw: str = "raw_h", calibrated: str = "pred_h") -> DataFrame:
    """MAE before and after calibration, RMSE and R² on the positive rows."""
    y, r, c = F.col(actual), F.col(raw), F.col(calibrated)
    sums = scored.where("is_pre").groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(y - r)).alias("mae_raw"),
        F.avg(F.abs(y - c)).alias("mae_cal"), F.avg((y - c) * (y - c)).alias("_mse"),
        F.var_pop(y).alias("_var"))
    return sums.select(*by, "n", "mae_raw", "mae_cal", F.sqrt("_mse").alias("rmse"),
                       (1 - F.try_divide("_mse", "_var")).alias("r2"))


def calibration_gain(metrics: DataFrame, target: float = 0.80) -> DataFrame:
    return metrics.withColumns({"gain": F.col("mae_raw") - F.col("mae_cal"),
                                "passed": F.col("event_recall") >= F.lit(target)})


def event_starts(scored: DataFrame, by: Sequence[str] = SERIES, time: str = "ts",
                 flag: str = "is_pre") -> DataFrame:
    """Rows at which the flag turns from false to true. Windows that touch are one event."""
    flagged = scored.select(*by, time, F.coalesce(F.col(flag), F.lit(False)).alias("_flag"))
    linked = previous_row(flagged, by, time, ["_flag"])
    return (linked.where(F.col("_flag") & ~F.coalesce(F.col("prev__flag"), F.lit(False)))
            .select(*by, F.col(time).alias("event_start")))


def event_windows(scored: DataFrame, lead_hours: Column, max_lead: float, *, score: str = "pred_h",
                  best: str = "min", by: Sequence[str] = SERIES, time: str = "ts") -> DataFrame:
    """Best score inside ``[start, start + lead)`` of every event.

    The join is on slices of time as long as the longest lead, so an event meets only the rows of
    two slices; the best score is reduced on the map side.
    """
    starts = event_starts(scored, by, time).withColumn(
        "event_end", F.timestamp_micros(
            F.unix_micros("event_start") + (lead_hours * HOUR_US).cast("long")))
    pairs = interval_join(scored.select(*by, time, score), starts, by, time,
                          "event_start", "event_end", hours=max_lead)
    pick = F.min if best == "min" else F.max
    return pairs.groupBy(*by, "event_start").agg(pick(score).alias("best_score"))


def event_recall(events: DataFrame, hit: Column, by: Sequence[str] = ("family",)) -> DataFrame:
    return events.groupBy(*by).agg(
        F.count_if(hit).alias("events_detected"), F.count(F.lit(1)).alias("events_total")).withColumn(
        "event_recall", F.round(guarded_ratio(F.col("events_detected"), F.col("events_total")), 4))


def count_label_events(labelled: DataFrame, by: Sequence[str] = SERIES, time: str = "ts",
                       hours: str = "hours_to", flag: str = "is_pre") -> DataFrame:
    """Distinct faults behind the positive rows: rises of the remaining hours, plus one; 0 if none."""
    positive = labelled.where(F.col(flag)).select(*by, time, hours)
    linked = previous_row(positive, by, time, [hours])
    rises = linked.groupBy(*by).agg(
        (F.count_if(F.col(hours) > F.col(f"prev_{hours}")) + 1).alias("n_events"))
    return (labelled.select(*by).distinct().join(rises, list(by), "left")
            .select(*by, F.coalesce("n_events", F.lit(0)).alias("n_events")))


def alert_summary(rows: DataFrame, events: DataFrame, by: Sequence[str] = ("family",)) -> DataFrame:
    """Row precision and recall beside event recall, and the F1 of (event recall, precision)."""
    out = rows.join(events, list(by), "left").withColumns({
        "event_recall": F.coalesce("event_recall", F.lit(0.0)),
        "precision": F.round("precision", 4), "recall": F.round("recall", 4)})
    return out.withColumn("f1_ep", F.round(harmonic(F.col("event_recall"), F.col("precision")), 4))


def dashboard_metrics(scored: DataFrame, events: DataFrame, lead_hours: Column, alert_h: Column,
                      by: Sequence[str] = SERIES, time: str = "ts") -> DataFrame:
    """Everything a dashboard says about a model: errors, precision and recall of rows and events, its parameters,
    the time that was tested and when the document was made. ``events`` has a flag ``detected``."""
    rows = confusion(scored, F.col("pred_h") <= alert_h, F.col("is_pre"), by).select(
        *by, F.round("precision", 4).alias("precision"), F.round("recall", 4).alias("recall"))
    found = event_recall(events, F.col("detected"), by)
    span = scored.groupBy(*by).agg(F.min(time).alias("test_start"), F.max(time).alias("test_end"))
    return (regression_metrics(scored, by).join(rows, list(by), "full").join(found, list(by), "left").join(span, list(by))
            .withColumns({"lead_hours": lead_hours, "alert_h": alert_h, "generated": F.current_timestamp()}))


def pick_winner(candidates: DataFrame, by: Sequence[str] = ("family",), metric: str = "f1_ep",
                preferred: str = "donor+target") -> DataFrame:
    """Best candidate per family; on a tie the one trained on more sources."""
    rank = F.struct(F.col(metric), (F.col("source") == preferred).cast("int"))
    rest = [c for c in candidates.columns if c not in by]
    best = candidates.groupBy(*by).agg(
        F.max_by(F.struct(*rest), rank).alias("_w"), F.count(F.lit(1)).alias("n_candidates"),
        F.max(metric).alias("_top"), F.collect_list(metric).alias("_all"))  # two candidates
    ties = F.size(F.filter("_all", lambda v: v == F.col("_top")))
    reason = (F.when(F.col("n_candidates") == 1, "only candidate")
              .when(ties > 1, "tie, more training data").otherwise(f"best {metric}"))
    return best.select(*by, *[f"_w.{c}" for c in rest], reason.alias("reason"))


def retrain_log_rows(candidates: DataFrame, winners: DataFrame, sources: Sequence[str],
                     metrics: Sequence[str], by: Sequence[str] = ("family",)) -> DataFrame:
    """One row per family: the winner's columns and every candidate's metrics side by side."""
    flat = []
    for s in sources:
        safe = s.replace("+", "_")
        flat += [F.max(F.when(F.col("source") == s, F.col(m))).alias(f"{m}_{safe}") for m in metrics]
    return winners.withColumnRenamed("source", "winner").join(
        candidates.groupBy(*by).agg(*flat), list(by))
