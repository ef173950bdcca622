"""Hours since the last fault on a stream, with keyed state.

Key is (entity, family). The state of a key is small whatever the length of the series: the readings that
still wait, the faults inside the allowed lateness, and the latest fault before those. A reading waits
until the watermark has passed the end of its bucket, when no earlier fault can come any more; a timer
then gives it its answer. A key sets one timer for a micro-batch, at its earliest new reading, and one more after
answering while readings still wait: each call of the state from Python costs, so none is made per reading but
the one that stores it. So faults and readings may come late, in any order, and each reading is written
once with the value of the batch as-of. Rows that come later than the watermark allows are dropped by
Spark, as in every other stream here.

The state lives in RocksDB and in the query's checkpoint: a restarted query goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from leadtime import config
from leadtime.functions.scalars import floor_ts

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT = "family string, at_us long, hours_since double"
HOUR_US = 3_600_000_000


class SinceLast(StatefulProcessor):
    """Times are microseconds; rows have ``at_us`` and ``is_fault``."""

    def __init__(self, bucket_us: int, no_history_hours: float, key_fields: Sequence[str]) -> None:
        self.bucket_us, self.no_history_hours, self.key_fields = bucket_us, no_history_hours, list(key_fields)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", "at_us long")
        self.faults = handle.getMapState("faults", "at_us long", "here boolean")
        self.waiting = handle.getMapState("waiting", "at_us long", "here boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        faults, readings = set(), set()
        for row in rows:
            (faults if row["is_fault"] else readings).add(row["at_us"])
        for at in faults:
            self.faults.updateValue((at,), (True,))
        for at in readings:
            self.waiting.updateValue((at,), (True,))  # the same entry if it waits already
        if readings:
            self._wake(min(readings))
        return iter(())

    def _wake(self, at: int) -> None:
        """A timer for the end of the bucket at ``at``."""
        self.handle.registerTimer((at + self.bucket_us) // 1000)

    @staticmethod
    def _keep(state, kept: Sequence[int], gone: Sequence[int]) -> None:
        """Leaves ``kept`` of a map's entries, by the fewer calls."""
        if len(kept) < len(gone):
            state.clear()
            for at in kept:
                state.updateValue((at,), (True,))
        else:
            for at in gone:
                state.removeKey((at,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Answers all readings whose bucket the watermark has passed; a timer wakes the key for the next one."""
        passed = timerValues.getCurrentWatermarkInMs() * 1000 - self.bucket_us
        waiting = sorted(at for (at,) in self.waiting.keys())
        due = [at for at in waiting if at <= passed]
        if not due:  # another timer was first, and set the next one
            return
        faults = sorted(at for (at,) in self.faults.keys())
        last = self.latest.get()[0] if self.latest.exists() else None
        i = 0
        for at in due:
            while i < len(faults) and faults[i] <= at:
                last, i = faults[i] if last is None else max(last, faults[i]), i + 1
            yield Row(**dict(zip(self.key_fields, key)), at_us=at, hours_since=float((at - last) / HOUR_US) if last is not None else self.no_history_hours)
        self._keep(self.waiting, waiting[len(due):], due)
        if len(due) < len(waiting):
            self._wake(waiting[len(due)])
        old = [at for at in faults if at <= passed]  # no reading before them can come any more
        if old:
            kept = max([*old, *((self.latest.get()[0],) if self.latest.exists() else ())])
            self.latest.update((kept,))
            self._keep(self.faults, faults[len(old):], old)

    def close(self) -> None:
        pass


def hours_since_stream(events: DataFrame, families: Sequence[config.Family], *, entity: str = "entity_id", time: str = "event_ts",
                       family: str = "family", reading: Column | None = None, minutes: int = 10, delay: str = "1 hour",
                       no_history_hours: float = config.NO_HISTORY_HOURS) -> DataFrame:
    """(entity, ts, family, hours_since) for every distinct ``minutes`` bucket with a reading, in append mode.

    ``events`` is one stream of readings and faults, so that one watermark holds for both: a row whose
    ``family`` is one of the families is a fault, a row for which ``reading`` holds (every row by default) is a
    reading; a row may be both. Rows without entity or time move nothing but the watermark. Run it with
    ``keyed_state`` in force.
    """
    names = [f.name for f in families]
    kind = dict(events.dtypes)[entity]
    item = "array<struct<family: string, is_fault: boolean>>"
    none = F.array().cast(item)
    asked = F.array(*[F.struct(F.lit(n).alias("family"), F.lit(False).alias("is_fault")) for n in names]).cast(item)
    fault = F.array(F.struct(F.col(family).alias("family"), F.lit(True).alias("is_fault"))).cast(item)
    items = F.concat(asked if reading is None else F.when(reading, asked).otherwise(none),
                     F.when(F.col(family).isin(names), fault).otherwise(none))
    # the condition names the time, else it would go below the watermark and hold back its progress
    sound = F.when(F.col(time).isNotNull(), F.col(entity).isNotNull()).otherwise(False)
    rows = events.withWatermark(time, delay).where(sound).select(
        entity, time, F.unix_micros(floor_ts(time, minutes)).alias("at_us"), F.inline(items))
    found = rows.groupBy(entity, "family").transformWithState(
        statefulProcessor=SinceLast(minutes * 60_000_000, float(no_history_hours), [entity, "family"]),
        outputStructType=f"{entity} {kind}, {OUT}", outputMode="Append", timeMode="EventTime")
    return found.select(entity, F.timestamp_micros("at_us").alias("ts"), "family", "hours_since")


def keyed_state(spark) -> None:
    """Keyed state needs the RocksDB store; the setting is read when a query starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
