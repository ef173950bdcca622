"""Nightly feature update: only rows after the high-water mark, with enough rows before them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadtime import config
from leadtime.operators.rolling import rolling_over
from leadtime.plans.lineage import join_null_safe, join_sized, materialize
from leadtime.plans.series import CHUNK_ROWS, fill_forward, number_rows


def new_rows(df: DataFrame, mark: DataFrame, by: Sequence[str] = ("entity_id",), time: str = "ts") -> DataFrame:
    """Rows after the stored time of their entity; all rows of an entity that is not stored yet.

    The smallest mark is read first and goes into the scan as a literal, so the night reads only what
    may be new. Rows up to it can be new for entities without a mark alone; a scan of the keys says
    whether there are any.
    """
    mark = materialize(mark, "mark")
    low = mark.agg(F.min("stored_until")).first()[0]
    if low is not None and df.select(*by).distinct().join(mark, list(by), "left_anti").isEmpty():
        df = df.where(F.col(time) > F.lit(low))
    joined = join_null_safe(df, mark, by, "left")
    return (joined.where(F.col("stored_until").isNull() | (F.col(time) > F.col("stored_until")))
            .drop("stored_until"))


def with_context(df: DataFrame, mark: DataFrame, rows: int = config.CONTEXT_ROWS,
                 by: Sequence[str] = ("entity_id",), time: str = "ts") -> DataFrame:
    """New rows (``is_new``) and the last ``rows`` rows before them, with their position.

    The position of the first new row of an entity is a one-row aggregate per entity.
    """
    by = list(by)
    numbered = join_sized(number_rows(df, by, time), mark, by, "left").withColumn(
        "is_new", F.col("stored_until").isNull() | (F.col(time) > F.col("stored_until")))
    firsts = numbered.where("is_new").groupBy(*by).agg(F.min("row_no").alias("_first"))
    return (join_sized(numbered, firsts, by).where(F.col("row_no") >= F.col("_first") - rows)
            .drop("_first", "stored_until"))


def last_known(df: DataFrame, sensors: Sequence[str], by: Sequence[str] = ("entity_id",),
               time: str = "ts") -> DataFrame:
    """Last non-missing value of every sensor per entity (map-side reduced)."""
    return df.groupBy(*by).agg(
        *[F.max_by(s, F.when(F.col(s).isNotNull(), F.col(time))).alias(s) for s in sensors])


def trailing_rows(df: DataFrame, n: int = config.CONTEXT_ROWS, by: Sequence[str] = ("entity_id",),
                  time: str = "ts") -> DataFrame:
    """The last ``n`` rows of every entity."""
    numbered = number_rows(df, by, time, total="_total")
    return numbered.where(F.col("row_no") > F.col("_total") - n).drop("row_no", "_total")




def update_features(new: DataFrame, context: DataFrame, sensors: Sequence[str], base: DataFrame, *,
                    windows: dict[str, int] = config.WINDOWS, engine: str = "halo",
                    by: Sequence[str] = ("entity_id",), time: str = "ts",
                    chunk_rows: int = CHUNK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Features of the new rows, and the context for the next update.

    ``context`` holds per entity the last rows of the filled series with their positions
    (``context_schema``); it is empty at first. Because values in it are filled and numbered, the
    increment equals the full recomputation, however long a sensor has been silent.
    """
    by, sensors = list(by), list(dict.fromkeys(sensors))
    reach = max(windows.values()) - 1
    stored = materialize(context.groupBy(*by).agg(
        F.max(time).alias("stored_until"), (F.min("row_no") - 1).alias("_skip")), "stored")
    is_new = F.col("stored_until").isNull() | (F.col(time) > F.col("stored_until"))
    narrow = new.select(*by, time, *[F.col(s).cast("double").alias(s) for s in sensors])
    fresh = narrow.join(stored, by, "left").where(is_new).select(*narrow.columns)
    filled = fill_forward(context.drop("row_no").unionByName(fresh), by, time, sensors, number="row_no")
    placed = materialize(
        filled.join(stored, by, "left")
        .withColumn("row_no", F.col("row_no") + F.coalesce("_skip", F.lit(0)))
        .select(*by, time, "row_no", *sensors, is_new.alias("_new")), "placed")
    added = rolling_over(placed, sensors, base, windows=windows, engine=engine, by=by, time=time,
                         chunk_rows=chunk_rows, wanted="_new")
    placed = placed.drop("_new")
    ends = placed.groupBy(*by).agg(F.max("row_no").alias("_end"))
    kept = join_sized(placed, ends, by).where(F.col("row_no") > F.col("_end") - reach).drop("_end")
    return added, kept


def context_schema(sensors: Sequence[str], by_types: str = "entity_id int", time: str = "ts") -> str:
    values = ", ".join(f"`{s}` double" for s in dict.fromkeys(sensors))
    return f"{by_types}, {time} timestamp, row_no bigint, {values}"
