"""Healthy-period reference of every sensor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadtime import config
from leadtime.plans.lineage import join_null_safe, materialize
from leadtime.plans.ranking import percentiles
from leadtime.plans.series import fill_forward


def baseline(df: DataFrame, sensors: Sequence[str], *, days: int | None = config.BASELINE_DAYS,
             months: int | None = None, by: Sequence[str] = ("entity_id",), time: str = "ts") -> DataFrame:
    """(entity, sensor, mean, p90, n_rows) over the first days or calendar months of each entity.

    The period is found with a map-side-reduced minimum; the percentile is exact (linear
    interpolation) and ranks values in slots, so no task holds a whole sensor of a large entity.
    """
    by = list(by)
    span: Column = F.make_interval(months=F.lit(months)) if months else F.make_interval(days=F.lit(days))
    starts = materialize(df.groupBy(*by).agg((F.min(time) + span).alias("_until")), "starts")
    last = starts.agg(F.max("_until")).first()[0]
    if last is None:
        raise ValueError("no reading has a time: there is no baseline period")
    readings = df.select(*by, time, *[F.col(s).cast("double").alias(s) for s in sensors])
    # the latest end goes into the scan as a literal
    period = join_null_safe(readings.where(F.col(time) < F.lit(last)), starts, by).where(F.col(time) < F.col("_until"))
    means = (period.groupBy(*by)
             .agg(F.count(F.lit(1)).alias("n_rows"), *[F.round(F.avg(s), 6).alias(s) for s in sensors])
             .unpivot([*by, "n_rows"], list(sensors), "sensor", "mean"))
    long = period.unpivot([*by, time], list(sensors), "sensor", "value")
    p90 = percentiles(long, [*by, "sensor"], "value", {"p90": 0.90})
    return means.join(p90, [*by, "sensor"], "left").select(
        *by, "sensor", "mean", F.round("p90", 6).alias("p90"), "n_rows")


def baseline_wide(base: DataFrame, sensors: Sequence[str], by: Sequence[str] = ("entity_id",)) -> DataFrame:
    """One row per entity with ``{sensor}__bl_mean`` and ``{sensor}__bl_p90`` columns."""
    aggs = []
    for s in sensors:
        hit = F.col("sensor") == s
        aggs += [F.max(F.when(hit, F.col("mean"))).alias(f"{s}__bl_mean"),
                 F.max(F.when(hit, F.col("p90"))).alias(f"{s}__bl_p90")]
    return base.groupBy(*by).agg(*aggs)


def series_p90(df: DataFrame, sensors: Sequence[str], by: Sequence[str] = ("entity_id",),
               time: str = "ts") -> DataFrame:
    """Fallback threshold: p90 of the whole series, filled first. It looks ahead; use a baseline if there is one."""
    narrow = df.select(*by, time, *[F.col(s).cast("double").alias(s) for s in sensors])
    long = fill_forward(narrow, by, time, sensors).unpivot(
        [*by, time], list(sensors), "sensor", "value")
    return percentiles(long, [*by, "sensor"], "value", {"p90": 0.90})
