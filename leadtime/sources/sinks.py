"""Writers. Nothing is ever written over the path it was read from."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadtime.operators.report import latest
from leadtime.sources.versions import commit_version, current_version, new_version  # noqa: F401


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a Parquet table."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Add rows without looking at what is there."""
    df.write.mode("append").parquet(path)


def write_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """CSV directory with a header; ``one_file`` is for reports of known, small size."""
    (df.repartition(1) if one_file else df).write.mode("overwrite").option("header", True).csv(path)


def upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str], keep: str = "last",
           order: Sequence[str] = (), deal: Callable[[DataFrame], DataFrame] = lambda both: both) -> DataFrame:
    """Union of both with one row per key: the newest (``last``) or the stored one (``first``).

    Returns the merged rows and writes nothing, which is also the dry run. ``order`` breaks ties
    between rows of one batch; without it the largest (or, for ``first``, smallest) row stays, so
    the choice never depends on the order of arrival. Copies are reduced before the shuffle, so a key with many copies
    sends one row per task and not its whole group. ``deal`` may partition the union by the keys beforehand, where the
    result is wanted so: the rows are then shuffled once, copies included.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    both = (existing.withColumn("_batch", F.lit(0))
            .unionByName(new.withColumn("_batch", F.lit(1)), allowMissingColumns=True))
    columns = [c for c in both.columns if c not in (*keys, "_batch")]
    sortable = [c for c in columns if c not in order and not isinstance(both.schema[c].dataType, T.MapType)]
    rank = F.struct("_batch", *order, *sortable)
    pick = F.max_by if keep == "last" else F.min_by
    picked = deal(both).groupBy(*keys).agg(pick(F.struct(F.lit(0).alias("_"), *columns), rank).alias("_row"))
    return picked.select(*[k if k in keys else F.col(f"_row.{k}").alias(k)
                           for k in both.columns if k != "_batch"])


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "first") -> DataFrame:
    """One row per key, the first or last in ``order``."""
    rest = [c for c in df.columns if c not in keys]
    pick = F.min_by if keep == "first" else F.max_by
    return (df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row"))
            .select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]))


def family_snapshot(stores: Mapping[str, DataFrame], run_date: Column, by: Sequence[str] = ("entity_id",)) -> DataFrame:
    """One row per entity with the newest row of every family's store, columns prefixed with the family; to be appended."""
    rows = None
    for name, store in stores.items():
        one = latest(store, by).select(*by, *[F.col(c).alias(f"{name}__{c}") for c in store.columns if c not in by])
        rows = one if rows is None else rows.join(one, list(by), "full")
    return rows.withColumn("date", run_date)


def to_float32(df: DataFrame, time: str = "ts", keep: Sequence[str] = ()) -> DataFrame:
    """Doubles and texts as float, texts that are no numbers as NULL; time and ``keep`` unchanged."""
    out = []
    for name, kind in df.dtypes:
        if name == time or name in keep or kind not in ("double", "string"):
            out.append(F.col(name))
        else:
            out.append(F.col(name).try_cast("float").alias(name))
    return df.select(*out)


def write_json_lines(df: DataFrame, path: str, column: str = "document") -> None:
    """One JSON document per line."""
    df.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def baseline_documents(baseline: DataFrame, months: int) -> DataFrame:
    """Rows (entity, sensor, mean, p90, n_rows) as one JSON-ready row per entity."""
    pairs = {c: F.map_from_entries(F.collect_list(F.struct("sensor", c))) for c in ("mean", "p90")}
    return baseline.groupBy("entity_id").agg(
        F.lit(months).alias("baseline_months"),
        F.date_format(F.max(F.current_timestamp()), "yyyy-MM-dd'T'HH:mm:ss").alias("computed_on"),
        F.max("n_rows").alias("n_rows"), pairs["mean"].alias("mean"), pairs["p90"].alias("p90"))
