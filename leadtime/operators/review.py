"""Alert threshold review: sweep thresholds over logged predictions and real events.

A threshold never needs its own pass. Predictions are counted into the gaps of the threshold
grid, and an event contributes only the readings at which its lowest prediction so far falls;
cumulative sums over the grid (about a hundred rows per family) give every threshold at once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadtime import config
from leadtime.operators.faults import cluster_events
from leadtime.plans.lineage import join_sized, materialize
from leadtime.plans.series import HOUR_US, hours_between, interval_join, previous_row

KEYS = ("entity_id", "family")


def threshold_grid(floors: DataFrame, ceiling: int = config.SWEEP_CEILING_H,
                   step: int = config.SWEEP_STEP_H) -> DataFrame:
    """(family, threshold) from the operational floor to the ceiling."""
    return floors.select("family", F.explode(F.when(
        F.col("floor_h") <= ceiling, F.sequence(F.col("floor_h"), F.lit(ceiling), F.lit(step)))).alias("threshold"))


def event_hits(preds: DataFrame, events: DataFrame, match_hours: float = config.MATCH_WINDOW_H,
               time: str = "ts") -> DataFrame:
    """(family, event, pred_h, lead_h): predictions strictly before an event, within the match window.

    Events are cluster starts, so they are more than a cluster gap apart and a prediction belongs
    to a bounded number of events.
    """
    back = F.lit(int(match_hours * HOUR_US))
    spans = events.select(*KEYS, F.col(time).alias("event_ts"),
                          F.timestamp_micros(F.unix_micros(time) - back).alias("_from"))
    pairs = interval_join(preds.select(*KEYS, time, "pred_h"), spans, KEYS, time, "_from", "event_ts",
                          hours=match_hours)
    return pairs.select(*KEYS, "event_ts", time, "pred_h",
                        hours_between(F.col("event_ts"), F.col(time)).alias("lead_h"))


def alert_hits(preds: DataFrame, events: DataFrame, match_hours: float = config.MATCH_WINDOW_H,
               time: str = "ts") -> DataFrame:
    """Predictions with ``hit``: an event follows within the match window (or at the same instant).

    The window of an event starts after the event before it, so windows do not overlap and every
    prediction meets at most one.
    """
    linked = previous_row(events.select(*KEYS, time), KEYS, time, [time])
    opens = F.greatest(F.unix_micros(time) - F.lit(int(match_hours * HOUR_US)),
                       F.unix_micros(f"prev_{time}") + 1)
    spans = linked.select(*KEYS, F.col(time).alias("_event"), F.timestamp_micros(opens).alias("_from"))
    pairs = interval_join(preds, spans, KEYS, time, "_from", "_event", hours=match_hours,
                          include_end=True, how="left")
    return pairs.withColumn("hit", F.col("_event").isNotNull()).drop("_event", "_from")


def _slot(value: Column, floor: Column, step: int) -> Column:
    """Index of the lowest grid threshold that lies above the value."""
    return F.greatest(F.floor((value - floor) / step) + 1, F.lit(0))


def _floor_of(floors: DataFrame) -> Column:
    """Operational floor of the row's family as a literal map: the parameters are a row per family."""
    pairs = [F.lit(v) for row in floors.select("family", "floor_h").collect() for v in row]
    return F.try_element_at(F.create_map(*pairs), F.col("family")) if pairs else F.lit(None).cast("int")


def with_missing_floors(floors: DataFrame, *frames: DataFrame) -> DataFrame:
    """(family, floor_h, floor_missing): a family that has rows but no floor is reviewed with floor 0."""
    seen = reduce(DataFrame.union, (f.select("family") for f in frames)).distinct()
    known = floors.select("family", "floor_h", F.lit(False).alias("floor_missing"))
    absent = seen.join(known, "family", "left_anti").select("family", F.lit(0).cast(floors.schema["floor_h"].dataType).alias("floor_h"),
                                                           F.lit(True).alias("floor_missing"))
    return materialize(known.union(absent), "floors")


def threshold_sweep(preds: DataFrame, events: DataFrame, floors: DataFrame, *,
                    ceiling: int = config.SWEEP_CEILING_H, step: int = config.SWEEP_STEP_H,
                    match_hours: float = config.MATCH_WINDOW_H, time: str = "ts") -> DataFrame:
    """Per family and threshold: alerts, events met, recall, precision and mean lead of the earliest alert.

    An alert is ``pred_h < threshold``. Recall is NULL without events, precision without alerts.
    ``floors`` has (family, floor_h); a family without one starts at 0.
    """
    floors = with_missing_floors(floors, preds, events)
    floor = _floor_of(floors)
    events = materialize(events.select(*KEYS, time), "events")  # sparse, and read three times
    slot = _slot(F.col("pred_h"), floor, step).alias("slot")
    alerts = (alert_hits(preds.where(F.col("pred_h").isNotNull()), events, match_hours, time)
              .where(floor.isNotNull()).groupBy("family", slot)
              .agg(F.count(F.lit(1)).alias("n"), F.count_if("hit").alias("n_hit")))

    # readings at which the lowest prediction of an event so far falls, in time order
    before = Window.partitionBy(*KEYS, "event_ts").orderBy(time)
    lows = (event_hits(preds, events, match_hours, time)
            .withColumn("_low", F.min("pred_h").over(before.rowsBetween(Window.unboundedPreceding, -1)))
            .where(F.col("_low").isNull() | (F.col("pred_h") < F.col("_low"))))
    later = F.lead("lead_h").over(before)
    met = (lows.withColumns({"_event": later.isNull().cast("int"),
                             "_gain": F.col("lead_h") - F.coalesce(later, F.lit(0.0))})
           .where(floor.isNotNull()).groupBy("family", slot)
           .agg(F.sum("_event").alias("met"), F.sum("_gain").alias("lead")))

    totals = events.groupBy("family").agg(F.count(F.lit(1)).alias("n_events"))
    grid = threshold_grid(floors, ceiling, step).withColumn(
        "slot", (F.row_number().over(Window.partitionBy("family").orderBy("threshold")) - 1).cast("long"))
    upto = (Window.partitionBy("family").orderBy("slot")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    full = (grid.join(alerts, ["family", "slot"], "left").join(met, ["family", "slot"], "left")
            .join(totals, "family", "left").na.fill(0, ["n", "n_hit", "met", "lead", "n_events"]))
    n, hit, found, lead = (F.sum(c).over(upto) for c in ("n", "n_hit", "met", "lead"))
    return full.select(
        "family", "threshold", n.alias("n_alerts"), found.alias("tp_events"), "n_events",
        F.try_divide(found.cast("double"), F.col("n_events")).alias("recall"),
        F.try_divide(hit.cast("double"), n).alias("precision"),
        F.when(found > 0, lead / found).alias("avg_lead_h"))


def recommend_threshold(sweep: DataFrame, floors: DataFrame) -> DataFrame:
    """Lowest threshold with full recall, but not below the operational floor; NULL with a reason if none."""
    full = sweep.groupBy("family").agg(
        F.min(F.when(F.col("recall") >= 0.999, F.col("threshold"))).alias("data_driven"))
    value = F.when(F.col("data_driven").isNotNull(), F.greatest("data_driven", "floor_h"))
    return floors.join(full, "family", "left").select(
        "family", "floor_h", "data_driven", value.alias("recommended"),
        F.when(F.col("data_driven").isNull(), "no threshold reaches full recall")
        .when(F.col("data_driven") < F.col("floor_h"), "operational floor")
        .otherwise("data").alias("reason"))


def review_trigger(faults: DataFrame, since: Column, min_new: int = 2,
                   gap_hours: float = config.CLUSTER_GAP_H, by=KEYS, time: str = "ts") -> DataFrame:
    """Are there enough new clusters since the last review? Clusters are formed over all faults first."""
    clusters = cluster_events(faults, gap_hours, by, time)
    new = F.col(time) >= since
    counts = clusters.groupBy("family").agg(F.count_if(new).alias("new_events"), F.min(F.when(new, F.col(time))).alias("first_new"),
                                            F.max(F.when(new, F.col(time))).alias("last_new"))
    return counts.withColumns({"min_required": F.lit(min_new), "should_review": F.col("new_events") >= min_new})


def new_events(faults: DataFrame, since: Column, gap_hours: float = config.CLUSTER_GAP_H, by=KEYS, time: str = "ts") -> DataFrame:
    """The clusters since the last review, with their dates."""
    return cluster_events(faults, gap_hours, by, time).where(F.col(time) >= since).select(*by, F.col(time).alias("event_ts"), F.to_date(time).alias("event_date"))


def threshold_review(preds: DataFrame, faults: DataFrame, floors: DataFrame, *,
                     gap_hours: float = config.CLUSTER_GAP_H, match_hours: float = config.MATCH_WINDOW_H,
                     ceiling: int = config.SWEEP_CEILING_H, step: int = config.SWEEP_STEP_H,
                     by=KEYS, time: str = "ts") -> DataFrame:
    """One row per family: evaluable events, small-sample warning, recommendation.

    Evaluable events are the clusters from the day of the first prediction on, judged for each entity and
    family by itself: an entity that is logged later owes nothing for earlier clusters, one without
    predictions owes nothing at all. A family without a floor is reviewed with floor 0 and a warning.
    """
    floors = with_missing_floors(floors, preds)
    first = preds.groupBy(*by).agg(F.date_trunc("day", F.min(time)).alias("_since"))
    events = (join_sized(cluster_events(faults, gap_hours, by, time), first, list(by))
              .where(F.col(time) >= F.col("_since")).drop("_since"))
    sweep = threshold_sweep(preds, events, floors, ceiling=ceiling, step=step, match_hours=match_hours, time=time)
    counts = events.groupBy("family").agg(F.count(F.lit(1)).alias("n_events"))
    n = F.coalesce("n_events", F.lit(0))
    return (recommend_threshold(sweep, floors).join(first, "family", "left_semi")
            .join(counts, "family", "left").join(floors.select("family", "floor_missing"), "family")
            .withColumns({"n_events": n, "small_sample": n < 2}))
