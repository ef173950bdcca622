"""Nearest faults before and after every reading.

Readings and faults are laid into time blocks and ordered together once; running minima and
maxima over that order answer every as-of question for all families in one shuffle. A fault
becomes visible to

* ``previous``: readings at or after it (latest fault so far),
* ``next``: readings strictly before it (earliest fault to come),
* ``cover``: readings at or after ``fault - lead`` (latest fault whose window has opened).

What a block needs from outside arrives as one seed row per block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadtime import config
from leadtime.functions.scalars import floor_ts
from leadtime.plans.series import BLOCK_DAYS, block_of, hours_between

KINDS = ("previous", "next", "cover")


def fault_context(df: DataFrame, faults: DataFrame, families: Sequence[config.Family], *,
                  kinds: Sequence[str] = ("previous",), by: Sequence[str] = ("entity_id",),
                  time: str = "ts", days: float = BLOCK_DAYS) -> DataFrame:
    """Adds ``{kind}_{family}`` timestamps. ``faults`` has the keys, ``time`` and ``family``."""
    by, names = list(by), [f.name for f in families]
    wanted = [f"{k}_{n}" for k in kinds for n in names]
    steps = _steps(faults, families, kinds, by, time, days)
    probes = df.withColumns({"_block": block_of(time, days), "_probe": F.lit(1)})

    merge = {c: (F.min if c.startswith("next_") else F.max) for c in wanted}
    per_block = (probes.select(*by, "_block")
                 .unionByName(steps.drop(time, "_probe"), allowMissingColumns=True)
                 .groupBy(*by, "_block").agg(*[merge[c](c).alias(c) for c in wanted]))
    series = Window.partitionBy(*by).orderBy("_block")
    before = series.rowsBetween(Window.unboundedPreceding, -1)
    after = series.rowsBetween(1, Window.unboundedFollowing)
    seeds = per_block.select(
        *by, "_block", F.lit(0).alias("_probe"), F.lit(None).cast("timestamp").alias(time),
        *[merge[c](c).over(after if c.startswith("next_") else before).alias(c) for c in wanted])

    rows = (probes.unionByName(steps, allowMissingColumns=True)
            .unionByName(seeds, allowMissingColumns=True))
    block = Window.partitionBy(*by, "_block")
    upto = (block.orderBy(F.col(time).asc_nulls_first(), "_probe")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    downto = (block.orderBy(F.col(time).desc_nulls_first(), F.desc("_probe"))
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = [merge[c](c).over(downto if c.startswith("next_") else upto).alias(c) for c in wanted]
    return (rows.select(*df.columns, "_probe", *found).where("_probe = 1").drop("_probe"))


def _steps(faults, families, kinds, by, time, days) -> DataFrame:
    """One row per instant at which some answer changes, with the new answers as columns."""
    instants = faults.select(*by, "family", F.col(time).cast("timestamp").alias("_fault")).where(
        F.col("family").isin([f.name for f in families]))
    parts = []
    moments = {}
    if {"previous", "next"} & set(kinds):
        moments["at"] = F.col("_fault")
    if "cover" in kinds:
        lead_us = F.lit(None).cast("long")
        for f in families:
            lead_us = F.when(F.col("family") == f.name, F.lit(int(f.lead_hours * 3_600_000_000))).otherwise(lead_us)
        moments["open"] = F.timestamp_micros(F.unix_micros("_fault") - lead_us)
    for moment, at in moments.items():
        values = []
        for k in kinds:
            if (k == "cover") == (moment == "open"):
                values += [F.max(F.when(F.col("family") == f.name, F.col("_fault"))).alias(f"{k}_{f.name}")
                           for f in families]
        parts.append(instants.withColumn(time, at).groupBy(*by, time).agg(*values))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.withColumns({"_block": block_of(time, days), "_probe": F.lit(0)})


def hours_since_last(df: DataFrame, faults: DataFrame, families: Sequence[config.Family] = config.FAMILIES, *,
                     no_history_hours: float = config.NO_HISTORY_HOURS,
                     cold_start_hours: float = config.COLD_START_HOURS,
                     by: Sequence[str] = ("entity_id",), time: str = "ts",
                     days: float = BLOCK_DAYS) -> DataFrame:
    """``hours_since_last_{family}`` and its ``log1p``.

    ``no_history_hours`` before the first fault, ``cold_start_hours`` for an entity that has no
    fault of the family at all.
    """
    found = fault_context(df, faults, families, kinds=("previous", "next"), by=by, time=time, days=days)
    added = {}
    for f in families:
        last, ahead = F.col(f"previous_{f.name}"), F.col(f"next_{f.name}")
        hours = (F.when(last.isNotNull(), hours_between(F.col(time), last))
                 .when(ahead.isNotNull(), F.lit(float(no_history_hours)))
                 .otherwise(F.lit(float(cold_start_hours))))
        added[f"hours_since_last_{f.name}"] = hours
        added[f"hours_since_last_{f.name}_log"] = F.log1p(hours)
    drop = [f"{k}_{f.name}" for k in ("previous", "next") for f in families]
    return found.withColumns(added).drop(*drop)


def label_hours_to_fault(df: DataFrame, faults: DataFrame,
                         families: Sequence[config.Family] = config.FAMILIES, *,
                         mode: str = "nearest",
                         exclude_after_hours: float | None = config.POST_FAULT_EXCLUSION_H,
                         as_of: Column | None = None, by: Sequence[str] = ("entity_id",),
                         time: str = "ts", days: float = BLOCK_DAYS) -> DataFrame:
    """``hours_to_{family}``, ``is_pre_{family}`` and ``excluded_{family}``.

    ``nearest``: hours to the next fault if within the lead time, else NULL.
    ``last``: hours to the latest fault whose lead window covers the row; other rows get the lead
    time. ``excluded`` marks rows less than ``exclude_after_hours`` after a fault; they stay in the
    frame because another family may still use them (see ``family_rows``).
    """
    if mode not in ("nearest", "last"):
        raise ValueError("mode must be 'nearest' or 'last'")
    known = faults if as_of is None else faults.where(F.col(time) <= as_of)
    known = known.withColumn(time, floor_ts(F.col(time).cast("timestamp")))
    answer = "next" if mode == "nearest" else "cover"
    kinds = (answer,) if exclude_after_hours is None else ("previous", answer)
    found = fault_context(df, known, families, kinds=kinds, by=by, time=time, days=days)
    added = {}
    for f in families:
        lead = F.lit(float(f.lead_hours))
        ahead = hours_between(F.col(f"{answer}_{f.name}"), F.col(time))
        hit = F.coalesce((ahead > 0) & (ahead <= lead), F.lit(False))
        added[f"hours_to_{f.name}"] = F.when(hit, ahead).otherwise(
            F.lit(None).cast("double") if mode == "nearest" else lead)
        added[f"is_pre_{f.name}"] = hit
        if exclude_after_hours is not None:
            since = hours_between(F.col(time), F.col(f"previous_{f.name}"))
            added[f"excluded_{f.name}"] = F.coalesce(since < F.lit(float(exclude_after_hours)), F.lit(False))
        else:
            added[f"excluded_{f.name}"] = F.lit(False)
    return found.withColumns(added).drop(*[f"{k}_{f.name}" for k in kinds for f in families])


def family_rows(labelled: DataFrame, family: str, keep_excluded: bool = False) -> DataFrame:
    """Rows of one family with its targets as ``hours_to`` and ``is_pre``."""
    rows = labelled if keep_excluded else labelled.where(~F.col(f"excluded_{family}"))
    other = [c for c in rows.columns if c.startswith(("hours_to_", "is_pre_", "excluded_"))]
    return rows.withColumns({"family": F.lit(family), "hours_to": F.col(f"hours_to_{family}"),
                             "is_pre": F.col(f"is_pre_{family}")}).drop(*other)


def long_labels(labelled: DataFrame, families: Sequence[config.Family] = config.FAMILIES,
                keep: Sequence[str] = ("entity_id", "ts")) -> DataFrame:
    """(keys, family, hours_to, is_pre, excluded), one row per reading and family."""
    entries = F.array(*[F.struct(F.lit(f.name).alias("family"),
                                 F.col(f"hours_to_{f.name}").alias("hours_to"),
                                 F.col(f"is_pre_{f.name}").alias("is_pre"),
                                 F.col(f"excluded_{f.name}").alias("excluded")) for f in families])
    return labelled.select(*keep, F.inline(entries))
