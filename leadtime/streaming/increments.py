"""Rolling features kept up to date while readings arrive late, twice or once more after a failure.

Three parts lie below ``root``:

* ``readings``: every reading once, in folders per increment and block of time;
* ``index``: a row per entity and block with its rows, its last time and the last known value of every sensor.
  From it alone follows how far the effect of a reading reaches, so a night opens only the blocks it needs;
* ``features``: a store of key ranges (``sources.ranged``) into which the rows of an increment are merged.

An increment makes rows *dirty*. For readings in order these are the new rows. A reading behind the newest one of its
entity changes the filled values up to the next known value of each sensor that it holds, and the frames that
reach into one of these rows. Dirty rows are computed again with the rows their frames need, and replace what
is stored. The features after any sequence of increments are those of one run over all readings.

Late readings of one entity in one increment share a range, from the earliest to the end of the latest one's effect.
A reading is known by entity and time: the first one stays, a later one with the same key is counted and left out, as is
one without a time. Of two in one increment the one with the larger values stays. A NULL entity is an entity
of its own. Index rows of many increments are folded into one table now and then; folders that no later batch can ask
for are removed. An increment that runs again replaces its own folders and merges the same rows.

``block``, ``increment`` and names that begin with ``_`` are no names for sensors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadtime import config
from leadtime.operators.rolling import rolling_over
from leadtime.plans.lineage import join_null_safe, join_sized, materialize
from leadtime.plans.series import BLOCK_DAYS, CHUNK_ROWS, block_of, fill_forward
from leadtime.sources import ranged
from leadtime.sources.files import read_or_empty
from leadtime.sources.sinks import distinct_on
from leadtime.sources.versions import current_version, data_path, last_version, claim, remove_folder

BLOCK = "block"
#: Index folders after which they are folded into one table.
FOLD = 8
#: A block behind all blocks.
OPEN = 1 << 62


class FeatureStore:
    """Readings, block index and features below ``root``; ``add`` is the handler of a micro-batch."""

    def __init__(self, root: str, sensors: Sequence[str], base: DataFrame, *, windows: dict[str, int] = config.WINDOWS,
                 engine: str = "halo", by: Sequence[str] = ("entity_id",), time: str = "ts", days: float = BLOCK_DAYS,
                 chunk_rows: int = CHUNK_ROWS, fold: int = FOLD, file_rows: int = ranged.FILE_ROWS) -> None:
        self.root, self.sensors, self.base = root.rstrip("/"), list(dict.fromkeys(sensors)), base
        self.windows, self.engine, self.by, self.time, self.days = windows, engine, list(by), time, days
        self.chunk_rows, self.fold, self.file_rows = chunk_rows, fold, file_rows
        self.reach = max(windows.values()) - 1

    def features(self, spark: SparkSession) -> DataFrame:
        return ranged.read(spark, f"{self.root}/features")

    def counts(self, spark: SparkSession) -> DataFrame:
        """Per increment: rows given, without a time, repeated, late, new, and feature rows written."""
        return spark.read.parquet(f"{self.root}/counts")

    def readings(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        parts = T.StructType([*schema.fields, T.StructField("increment", T.LongType()), T.StructField(BLOCK, T.LongType())])
        return read_or_empty(spark, f"{self.root}/readings", parts)

    def _index_schema(self, schema: T.StructType) -> T.StructType:
        known = T.StructType([T.StructField("at", schema[self.time].dataType), T.StructField("value", T.DoubleType())])
        return T.StructType([*[schema[c] for c in self.by], T.StructField(BLOCK, T.LongType()), T.StructField("_n", T.LongType()),
                             T.StructField("_last", schema[self.time].dataType), *[T.StructField(s, known) for s in self.sensors]])

    def _folded_until(self, spark: SparkSession) -> int:
        path = current_version(spark, f"{self.root}/folded")
        return -1 if path is None else int(path.rsplit("-", 1)[1])

    def index(self, spark: SparkSession, schema: T.StructType, before: int) -> DataFrame:
        """A row per entity and block over all increments below ``before``."""
        kind, path = self._index_schema(schema), current_version(spark, f"{self.root}/folded")
        parts = read_or_empty(spark, f"{self.root}/index", T.StructType([*kind.fields, T.StructField("increment", T.LongType())]))
        parts = parts.where((F.col("increment") > self._folded_until(spark)) & (F.col("increment") < before)).drop("increment")
        if path is not None:
            parts = parts.unionByName(spark.read.schema(kind).parquet(path))
        return parts.groupBy(*self.by, BLOCK).agg(F.sum("_n").alias("_n"), F.max("_last").alias("_last"), *[F.max(s).alias(s) for s in self.sensors])

    def add(self, batch: DataFrame, increment: int) -> None:
        """Takes one increment in; numbers grow from batch to batch."""
        spark = batch.sparkSession
        if increment <= self._folded_until(spark):
            raise ValueError(f"increment {increment} is older than the folded ones")
        keys = [*self.by, self.time]
        given = materialize(batch.select(*keys, *[F.col(s).cast("double").alias(s) for s in self.sensors]), "given")
        timed = distinct_on(given.where(F.col(self.time).isNotNull()), keys, self.sensors, "last")
        timed = materialize(timed.withColumn(BLOCK, block_of(self.time, self.days)), "timed")
        span = timed.agg(F.min(BLOCK).alias("low"), F.max(BLOCK).alias("high")).first()
        stored = self.readings(spark, given.schema).where(F.col("increment") < increment)
        stored = stored.where(F.col(BLOCK).between(F.lit(span["low"]), F.lit(span["high"])))
        fresh = materialize(join_null_safe(timed, stored.select(*keys), keys, "left_anti"), "fresh")
        (fresh.repartition(BLOCK, *self.by).sortWithinPartitions(*keys).write.mode("overwrite")
         .partitionBy(BLOCK).parquet(f"{self.root}/readings/increment={increment}"))
        known = [F.max(F.when(F.col(s).isNotNull(), F.struct(F.col(self.time).alias("at"), F.col(s).alias("value")))).alias(s) for s in self.sensors]
        (fresh.groupBy(*self.by, BLOCK).agg(F.count(F.lit(1)).alias("_n"), F.max(self.time).alias("_last"), *known)
         .write.mode("overwrite").parquet(f"{self.root}/index/increment={increment}"))

        touched = self._touched(fresh, self.index(spark, given.schema, increment))
        index = materialize(join_sized(self.index(spark, given.schema, increment + 1), touched, self.by), "index")
        bounds = materialize(self._bounds(index), "bounds")
        added = self._features(spark, given.schema, index, bounds, increment)
        self._store(spark, added, keys)
        late = touched.agg(F.coalesce(F.sum("_n_late"), F.lit(0)).alias("n_late"), F.coalesce(F.sum("_n_new"), F.lit(0)).alias("n_new"))
        counted = given.agg(F.count(F.lit(1)).alias("n_given"), F.count_if(F.col(self.time).isNull()).alias("n_without_time"))
        (counted.crossJoin(late).crossJoin(added.agg(F.count(F.lit(1)).alias("n_written")))  # one row each
         .withColumn("n_repeated", F.col("n_given") - F.col("n_without_time") - F.col("n_late") - F.col("n_new"))
         .write.mode("overwrite").parquet(f"{self.root}/counts/increment={increment}"))
        self._fold(spark, given.schema, increment)

    def _touched(self, fresh: DataFrame, before: DataFrame) -> DataFrame:
        """Per entity: the late and the new part of the increment, and the last late value of every sensor."""
        until = before.groupBy(*self.by).agg(F.max("_last").alias("_until"))
        marked = join_sized(fresh, until, self.by, "left")
        late = F.col(self.time) <= F.col("_until")
        at, is_late = F.col(self.time), F.coalesce(late, F.lit(False))
        hits = [F.max(F.when(is_late & F.col(s).isNotNull(), F.col(BLOCK))).alias(f"_hit_{s}") for s in self.sensors]
        return materialize(marked.groupBy(*self.by).agg(
            F.count_if(is_late).alias("_n_late"), F.count_if(~is_late).alias("_n_new"),
            F.min(F.when(is_late, at)).alias("_late_low"), F.max(F.when(is_late, F.col(BLOCK))).alias("_late_high"),
            F.min(F.when(~is_late, at)).alias("_new_low"), *hits), "touched")

    def _bounds(self, index: DataFrame) -> DataFrame:
        """Per entity the blocks to read and the dirty rows in them, from the index alone.

        The late part is dirty up to the end of block ``_late_to``: there every sensor it holds has had another
        value, and ``reach`` more rows have passed since. ``OPEN`` stands for the end of the series.
        """
        entity = Window.partitionBy(*self.by)  # a row per block
        order = entity.orderBy(BLOCK)
        upto = F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0))
        rows = index.withColumn("_upto", upto).withColumn("_before", F.col("_upto") - F.col("_n"))
        settled = [F.when(F.col(f"_hit_{s}").isNull(), F.col("_late_high")).otherwise(F.coalesce(
            F.min(F.when((F.col(BLOCK) > F.col(f"_hit_{s}")) & F.col(s).isNotNull(), F.col(BLOCK))).over(entity), F.lit(OPEN)))
            for s in self.sensors]
        rows = rows.withColumn("_settled", F.greatest(F.col("_late_high"), *settled))
        rows = rows.withColumn("_at_settled", F.max(F.when(F.col(BLOCK) <= F.col("_settled"), F.col("_upto"))).over(entity))
        passed = (F.col(BLOCK) > F.col("_settled")) & (F.col("_upto") - F.col("_at_settled") >= self.reach)
        out = {"_late_to": F.when(F.first("_late_low").isNotNull(), F.coalesce(F.min(F.when(passed, F.col(BLOCK))), F.lit(OPEN)))}
        for part in ("late", "new"):
            home = block_of(f"_{part}_low", self.days)
            rows = rows.withColumn(f"_{part}_home", F.max(F.when(F.col(BLOCK) == home, F.col("_before"))).over(entity))
            enough = (F.col(BLOCK) <= home) & (F.col(f"_{part}_home") - F.col("_before") >= self.reach)
            out[f"_{part}_from"] = F.when(F.first(f"_{part}_low").isNotNull(), F.coalesce(F.max(F.when(enough, F.col(BLOCK))), F.min(BLOCK)))
            out[f"_{part}_low"] = F.first(f"_{part}_low")
        return rows.groupBy(*self.by).agg(*[value.alias(name) for name, value in out.items()])

    def _read(self) -> Column:
        """Is a row's block among those that the entity's dirty rows need? NULL bounds are no range."""
        late = (F.col(BLOCK) >= F.col("_late_from")) & (F.col(BLOCK) <= F.col("_late_to"))
        return F.coalesce(late, F.lit(False)) | F.coalesce(F.col(BLOCK) >= F.col("_new_from"), F.lit(False))

    def _dirty(self) -> Column:
        at = F.col(self.time)
        late = (at >= F.col("_late_low")) & (block_of(self.time, self.days) <= F.col("_late_to"))
        return F.coalesce(late, F.lit(False)) | F.coalesce(at >= F.col("_new_low"), F.lit(False))

    def _features(self, spark: SparkSession, schema: T.StructType, index: DataFrame, bounds: DataFrame, increment: int) -> DataFrame:
        """The dirty rows, computed from the blocks that hold them and what their frames reach into."""
        keys = [*self.by, self.time]
        least = bounds.agg(F.min(F.least("_late_from", "_new_from"))).first()[0]
        rows = self.readings(spark, schema).where((F.col("increment") <= increment) & (F.col(BLOCK) >= F.lit(least)))
        rows = join_null_safe(rows, bounds, self.by).where(self._read()).select(*keys, *self.sensors)
        earlier = Window.partitionBy(*self.by).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)  # a row per block
        seeds = index.select(*self.by, BLOCK, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_skip"),
                             *[F.last(F.col(s)["value"], ignorenulls=True).over(earlier).alias(s) for s in self.sensors])
        seeds = join_null_safe(seeds, bounds, self.by).where(self._read()).select(*self.by, F.col(BLOCK).alias("_block"), "_skip", *self.sensors)
        filled = fill_forward(rows, self.by, self.time, self.sensors, days=self.days, number="row_no", seeds=seeds)
        filled = materialize(join_null_safe(filled, bounds, self.by).select(*filled.columns, self._dirty().alias("_dirty")), "filled")
        return materialize(rolling_over(filled, self.sensors, self.base, windows=self.windows, engine=self.engine, by=self.by,
                                        time=self.time, chunk_rows=self.chunk_rows, wanted="_dirty"), "added")

    def _store(self, spark: SparkSession, added: DataFrame, keys: Sequence[str]) -> None:
        root = f"{self.root}/features"
        if added.isEmpty():
            return
        if current_version(spark, root) is None:
            ranged.create(added, root, keys, self.file_rows, written=True)
        else:
            ranged.merge(added, root, keys, file_rows=self.file_rows, written=True)

    def _fold(self, spark: SparkSession, schema: T.StructType, increment: int) -> None:
        """Index rows of earlier increments in one table; this one's stay apart, as it may run again."""
        root, until = f"{self.root}/folded", self._folded_until(spark)
        parts = spark.read.schema("increment bigint").parquet(f"{self.root}/index").select("increment").distinct()
        numbers = sorted(r.increment for r in parts.collect() if r.increment < increment)  # a row per folder
        if len([n for n in numbers if n > until]) >= self.fold:
            version, former = last_version(spark, root)
            path = f"{data_path(root)}-{increment - 1}"
            self.index(spark, schema, increment).write.parquet(path)
            if not claim(spark, root, version + 1, path):
                raise RuntimeError(f"{self.root}: another job writes to this store")
            if former is not None:
                remove_folder(spark, former)
            until = increment - 1
        for n in numbers:
            if n <= until:
                remove_folder(spark, f"{self.root}/index/increment={n}")
