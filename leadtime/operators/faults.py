"""From a status log to faults: filter, map to families, dedup, group, cluster, catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadtime import config
from leadtime.functions.scalars import floor_ts
from leadtime.plans.lineage import join_sized, materialize
from leadtime.plans.series import hours_between, previous_row


#: Codes of a catalog that may stand as literals in a plan; a longer one is joined.
LITERAL_CODES = 2_000


def _short(catalog: DataFrame, *columns: str) -> list | None:
    """The rows of a catalog, None if it has more than LITERAL_CODES."""
    rows = catalog.select(*columns).limit(LITERAL_CODES + 1).collect()
    return rows if len(rows) <= LITERAL_CODES else None


def map_family(events: DataFrame, catalog: DataFrame, code: str = "code", other: str | None = None,
               out: str = "family") -> DataFrame:
    """Family of each code; codes outside the catalog get ``other`` (NULL by default).

    An edited list of codes is a literal map; a catalog of any size is a sized join.
    """
    rows = _short(catalog, "code", "family")
    if rows is None:
        one = catalog.groupBy(F.col("code").alias(code)).agg(F.min("family").alias("_family"))
        events = join_sized(events, one, code, "left")
        family = F.col("_family")
    else:
        pairs = [F.lit(v) for row in rows for v in row]
        family = F.try_element_at(F.create_map(*pairs) if pairs else F.create_map().cast("map<int,string>"), F.col(code))
    return events.withColumn(out, family if other is None else F.coalesce(family, F.lit(other))).drop("_family")


def critical_events(status: DataFrame, statuses: Sequence[str] = config.FAULT_STATUSES) -> DataFrame:
    return status.where(F.col("status").isin(*statuses))


def drop_codes(events: DataFrame, excluded: DataFrame, code: str = "code") -> DataFrame:
    """Rows whose code is not excluded. A row without a code stays, as it equals no listed code."""
    rows = _short(excluded, "code")
    if rows is None:
        listed = materialize(excluded.select(F.col("code").alias(code)).where(F.col(code).isNotNull()).distinct(), "excluded")
        return events.join(listed, code, "left_anti")
    codes = [r.code for r in rows]
    return events.where(F.col(code).isNull() | ~F.col(code).isin(codes)) if codes else events


def flag_targets(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """``is_failure_target`` and the start floored to 10 minutes."""
    known = map_family(events, catalog, out="_known")
    return known.withColumns({
        "is_failure_target": F.col("_known").isNotNull(), "ts": floor_ts("event_ts")}).drop("_known")


def first_per_bucket(events: DataFrame, keys: Sequence[str] = ("entity_id", "code"),
                     time: str = "event_ts", tie: str = "event_id", minutes: int = 10) -> DataFrame:
    """First event per key and clock bucket; ``ts`` is the bucket start.

    One aggregate with map-side reduction: a code that repeats all day sends one row per bucket.
    """
    bucketed = events.withColumn("ts", floor_ts(time, minutes))
    rest = [c for c in bucketed.columns if c not in (*keys, "ts")]
    return (bucketed.groupBy(*keys, "ts")
            .agg(F.min_by(F.struct(*rest), F.struct(time, tie)).alias("_e"))
            .select(*keys, "ts", *[f"_e.{c}" for c in rest]))


def extract_faults(status: DataFrame, families: DataFrame, excluded: DataFrame,
                   as_of: Column | None = None, minutes: int = 10) -> DataFrame:
    """Fault log: (entity_id, ts, family, code, message, status, event_ts, event_id)."""
    events = status if as_of is None else status.where(F.col("event_ts") <= as_of)
    events = drop_codes(critical_events(events), excluded)
    events = map_family(events, families).where(F.col("family").isNotNull())
    return first_per_bucket(events, minutes=minutes).select(
        "entity_id", "ts", "family", "code", "message", "status", "event_ts", "event_id")


def group_faults(events: DataFrame, by: Sequence[str] = ("entity_id", "ts", "family"),
                 time: str = "event_ts", tie: str = "event_id") -> DataFrame:
    """One row per instant and family: codes, messages in order of appearance, first status, count.

    The first reduction is per (instant, family, code, message), so the lists that are collected
    hold distinct catalog entries and not events.
    """
    seen = F.min(F.struct(time, tie))
    entries = events.groupBy(*by, "code", "message").agg(
        seen.alias("seen"), F.count(F.lit(1)).alias("n"),
        F.min_by("status", F.struct(time, tie)).alias("status"))
    messages = F.transform(F.array_sort(F.collect_list(F.struct("seen", "message"))), lambda e: e.message)
    return entries.groupBy(*by).agg(
        F.array_join(F.transform(F.array_sort(F.collect_set("code")), lambda c: c.cast("string")), ",")
        .alias("codes"),
        F.array_join(F.array_distinct(messages), " | ").alias("messages"),
        F.min_by("status", "seen").alias("status"), F.sum("n").alias("n_events"))


def fault_catalog(events: DataFrame, keys: Sequence[str] = ("code", "message"),
                  attributes: Sequence[str] = ("status",), time: str = "event_ts",
                  tie: str = "event_id") -> DataFrame:
    """Earliest attributes and the number of events per catalog key."""
    first = {a: F.min_by(a, F.struct(time, tie)).alias(a) for a in attributes}
    return events.groupBy(*keys).agg(*first.values(), F.count(F.lit(1)).alias("n_events"))


def reconcile(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row: events in the log, events in the catalog, and whether they agree."""
    sides = events.agg(F.count(F.lit(1)).alias("n_log")).unionByName(
        catalog.agg(F.sum("n_events").alias("n_catalog")), allowMissingColumns=True)
    return sides.agg(F.max("n_log").alias("n_log"), F.max("n_catalog").alias("n_catalog")).withColumn(
        "agrees", F.col("n_log") == F.col("n_catalog"))


def repeated_instants(events: DataFrame, by: Sequence[str] = ("entity_id", "ts")) -> DataFrame:
    """Instants with more than one event and the codes seen there with their counts (``716x2,717x1``).

    Counting per code first keeps the list as long as the catalog, not as the burst of events.
    """
    per_code = events.groupBy(*by, "code").agg(F.count(F.lit(1)).alias("n"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("code", "n"))),
                         lambda e: F.concat_ws("x", e.code.cast("string"), e.n.cast("string")))
    return (per_code.groupBy(*by)
            .agg(F.array_join(listed, ",").alias("codes"), F.sum("n").alias("n_events"))
            .where("n_events > 1"))


def cascades(grouped: DataFrame, by: Sequence[str] = ("entity_id", "ts")) -> DataFrame:
    """Instants at which more than one family failed."""
    return (grouped.groupBy(*by)
            .agg(F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"),
                 F.count(F.lit(1)).alias("n_families"))
            .where("n_families > 1"))


def cascade_summary(grouped: DataFrame) -> DataFrame:
    found = cascades(grouped)
    return found.agg(F.count(F.lit(1)).alias("n_instants"),
                     F.coalesce(F.sum(F.col("n_families") - 1), F.lit(0)).alias("extra_rows"))


def value_counts(df: DataFrame, column: str, k: int | None = None) -> DataFrame:
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts if k is None else counts.orderBy(F.desc("n"), column).limit(k)


def cluster_events(faults: DataFrame, gap_hours: float = config.CLUSTER_GAP_H,
                   by: Sequence[str] = ("entity_id", "family"), time: str = "ts") -> DataFrame:
    """First fault of every cluster: a fault more than ``gap_hours`` after the one before it.

    The gap is measured to the previous fault, not to the start of the cluster, and a gap of
    exactly ``gap_hours`` merges.
    """
    instants = faults.groupBy(*by, time).agg(F.count(F.lit(1)).alias("n_faults"))
    linked = previous_row(instants, by, time, [time])
    gap = hours_between(F.col(time), F.col(f"prev_{time}"))
    return linked.where(F.col(f"prev_{time}").isNull() | (gap > F.lit(float(gap_hours)))).select(*by, time)


def coverage(faults: DataFrame, telemetry: DataFrame, by: Sequence[str] = ("entity_id",),
             time: str = "ts", minutes: int = 10) -> DataFrame:
    """How many distinct fault instants exist in the telemetry."""
    wanted = faults.select(*by, floor_ts(time, minutes).alias("at")).distinct()
    there = telemetry.select(*by, floor_ts(time, minutes).alias("at")).distinct().withColumn("hit", F.lit(1))
    return (wanted.join(there, [*by, "at"], "left")
            .agg(F.count("hit").alias("n_covered"), F.count(F.lit(1)).alias("n_faults"))
            .withColumn("pct", F.try_divide(100.0 * F.col("n_covered"), F.col("n_faults"))))


def with_donor_faults(own: DataFrame, donor: DataFrame, targets: DataFrame) -> DataFrame:
    """Faults per target entity; a (target, family) without own faults borrows the donor's.

    ``targets`` maps ``entity_id`` to ``donor_id``.
    """
    mine = own.join(targets.select("entity_id"), "entity_id", "left_semi")
    known = mine.select("entity_id", "family").distinct()
    borrowed = (donor.withColumnRenamed("entity_id", "donor_id").join(targets, "donor_id")
                .join(known, ["entity_id", "family"], "left_anti"))
    return (mine.select("entity_id", "family", "ts", F.lit("own").alias("origin"))
            .unionByName(borrowed.select("entity_id", "family", "ts", F.lit("donor").alias("origin"))))
