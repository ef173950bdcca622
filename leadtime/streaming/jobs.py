"""Structured Streaming jobs.

Each job reads whatever is new (``trigger(availableNow=True)``), keeps its progress in a
checkpoint and writes Parquet. Jobs that need row frames or an exact as-of run the batch operators
on each micro-batch and write to ``batch_id=<n>`` folders: a batch that is replayed after a
failure replaces its own folder, so results are written once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadtime import config
from leadtime.functions.scalars import floor_ts
from leadtime.operators.nightly import context_schema, update_features
from leadtime.sources.files import read_or_empty
from leadtime.sources.versions import remove_folder


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is there and stop."""
    query = (stream.writeStream.format("parquet").option("path", path)
             .option("checkpointLocation", checkpoint).outputMode(mode)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    query = (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def dedup_events(events: DataFrame, keys: Sequence[str] = ("entity_id", "code"), time: str = "event_ts",
                 minutes: int = 10, delay: str = "1 hour") -> DataFrame:
    """One event per key and clock bucket; state is dropped once the watermark passes."""
    return (events.withColumn("ts", floor_ts(time, minutes)).withWatermark(time, delay)
            .dropDuplicatesWithinWatermark([*keys, "ts"]))


def timeline(scored: DataFrame, aggs: dict[str, Column], every: str = "6 hours", delay: str = "1 hour",
             by: Sequence[str] = ("entity_id",), time: str = "ts") -> DataFrame:
    """Tumbling bins, emitted when the watermark passes their end; later rows are dropped."""
    return (scored.withWatermark(time, delay).groupBy(*by, F.window(time, every)).agg(*[a.alias(n) for n, a in aggs.items()])
            .select(*by, F.col("window.start").alias("bin"), *aggs))


def sliding_statistics(readings: DataFrame, aggs: dict[str, Column], length: str = "1 hour",
                       step: str = "10 minutes", delay: str = "1 hour",
                       by: Sequence[str] = ("entity_id",), time: str = "ts") -> DataFrame:
    """Time-based sliding windows; equal to row frames only on a grid without gaps."""
    return (readings.withWatermark(time, delay).groupBy(*by, F.window(time, length, step)).agg(*[a.alias(n) for n, a in aggs.items()])
            .select(*by, F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"), *aggs))


def fault_sessions(faults: DataFrame, gap: str = "24 hours", delay: str = "1 hour",
                   by: Sequence[str] = ("entity_id", "family"), time: str = "ts") -> DataFrame:
    """Fault clusters; a gap of exactly ``gap`` merges, as session windows are closed by a longer one."""
    return (faults.withWatermark(time, delay).groupBy(*by, F.session_window(time, gap))
            .agg(F.count(F.lit(1)).alias("n_faults"), F.max(time).alias("last_ts"))
            .select(*by, F.col("session_window.start").alias("ts"), "last_ts", "n_faults"))


def feature_batches(store: str, sensors: Sequence[str], base: DataFrame,
                    windows: dict[str, int] = config.WINDOWS, engine: str = "halo"
                    ) -> Callable[[DataFrame, int], None]:
    """Handler that appends the rolling features of each micro-batch.

    ``store/features/batch_id=n`` gets the rows; ``store/context/batch_id=n`` the last rows of every
    entity, which is all the next batch reads. Two contexts are kept, as a batch may run again; older ones are
    removed. Readings behind the newest one of their entity are left out: ``increments.FeatureStore`` takes them in.
    """
    schema = context_schema(sensors)

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = f"{store}/context/batch_id={batch_id - 1}"
        # only the first batch may start empty: a lost context would restart filling and numbering unseen
        context = read_or_empty(spark, before, schema) if batch_id == 0 else spark.read.schema(schema).parquet(before)
        features, kept = update_features(batch, context, sensors, base, windows=windows, engine=engine)
        features.write.mode("overwrite").parquet(f"{store}/features/batch_id={batch_id}")
        kept.write.mode("overwrite").parquet(f"{store}/context/batch_id={batch_id}")
        remove_folder(spark, f"{store}/context/batch_id={batch_id - 2}")

    return handle
