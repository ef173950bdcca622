"""Exact ranks and percentiles of large groups without sorting a group in one task.

Equal values are first counted together (so a constant that fills a third of the rows is one
row afterwards), then values are laid into slots that keep their order. The slots end at quantiles
of the group's own distinct values (a sketch, reduced on the map side), so each holds about the same
number of them, however narrow the band the values lie in. Totals per slot are accumulated over the
slots of a group, and only values of one slot are sorted against each other. NaN counts as missing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadtime.plans.lineage import join_null_safe, join_sized, materialize

SLOTS = 128  # of a group


def with_slots(counts: DataFrame, by: Sequence[str], value: str, slots: int = SLOTS) -> DataFrame:
    """Adds ``_slot``: how many of the group's cut points lie below the value.

    ``counts`` has one row per group and distinct value and is read twice: pass a written table.
    """
    points = F.array(*[F.lit(i / slots) for i in range(1, slots)])
    cuts = counts.groupBy(*by).agg(F.percentile_approx(F.col(value).cast("double"), points, 20 * slots).alias("_cuts"))
    below = F.size(F.filter("_cuts", lambda c: c < F.col(value).cast("double"))).cast("long")
    return join_sized(counts, cuts, by).withColumn("_slot", below).drop("_cuts")


def running_counts(df: DataFrame, by: Sequence[str], value: str, sums: dict[str, Column], *,
                   slot: Column | None = None, slots: int = SLOTS) -> DataFrame:
    """One row per distinct value with, for each name in ``sums``, the sum at the value
    (``name``), over all smaller values (``name_below``) and over the group (``name_total``)."""
    names = list(sums)
    if not by:  # the whole frame is one group
        return running_counts(df.withColumn("_all", F.lit(0)), ["_all"], value, sums, slot=slot, slots=slots).drop("_all")
    by = list(by)
    if dict(df.dtypes)[value] in ("double", "float"):
        df = df.where(~F.isnan(value))
    counts = materialize(df.groupBy(*by, value).agg(*[expr.alias(n) for n, expr in sums.items()]), "counts")
    counts = counts.withColumn("_slot", slot) if slot is not None else with_slots(counts, by, value, slots)
    over_slots = Window.partitionBy(*by).orderBy("_slot")
    whole = Window.partitionBy(*by)
    totals = counts.groupBy(*by, "_slot").agg(*[F.sum(n).alias(n) for n in names])
    totals = totals.select(
        *by, "_slot",
        *[F.coalesce(F.sum(n).over(over_slots.rowsBetween(Window.unboundedPreceding, -1)),
                     F.lit(0)).alias(f"_off_{n}") for n in names],
        *[F.sum(n).over(whole).alias(f"{n}_total") for n in names])
    inside = (Window.partitionBy(*by, "_slot").orderBy(value)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = join_null_safe(counts, totals, [*by, "_slot"])
    return joined.select(
        *by, value, *names, *[f"{n}_total" for n in names],
        *[(F.col(f"_off_{n}") + F.sum(n).over(inside) - F.col(n)).alias(f"{n}_below") for n in names])


def percentiles(df: DataFrame, by: Sequence[str], value: str, points: dict[str, float], *,
                slot: Column | None = None) -> DataFrame:
    """Exact percentiles with linear interpolation, NULLs skipped; one row per group."""
    by = list(by)
    ranked = running_counts(df.where(F.col(value).isNotNull()), by, value,
                            {"n": F.count(F.lit(1))}, slot=slot)
    picks = []
    for name, p in points.items():
        target = F.lit(float(p)) * (F.col("n_total") - 1)
        for edge, at in (("lo", F.floor(target)), ("hi", F.ceil(target))):
            held = (F.col("n_below") <= at) & (at < F.col("n_below") + F.col("n"))
            picks.append(F.max(F.when(held, F.col(value))).alias(f"_{name}_{edge}"))
    grouped = ranked.groupBy(*by) if by else ranked.groupBy()
    found = grouped.agg(*picks, F.max("n_total").alias("_n"))
    out = []
    for name, p in points.items():
        target = F.lit(float(p)) * (F.col("_n") - 1)
        part = target - F.floor(target)
        lo, hi = F.col(f"_{name}_lo").cast("double"), F.col(f"_{name}_hi").cast("double")
        out.append((lo + (hi - lo) * part).alias(name))
    return found.select(*by, *out)
