"""A long history of readings with a block index, from which the nightly job finds what it needs without a scan.

Readings lie in folders per block of time. The index is a table with a row per entity, block and increment: the
rows added, the first and the last time. From the index alone come the known entities, the newest
time of each, the block from which its last rows begin and the position of that block's first row; the
history itself is read from the least of these blocks on, which the scan gets as a literal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadtime import config
from leadtime.plans.lineage import join_null_safe, join_sized, materialize
from leadtime.plans.series import BLOCK_DAYS, block_of, number_rows

BLOCK = "block"


class History:
    """The readings below ``root`` and their index."""

    def __init__(self, spark: SparkSession, root: str, by: Sequence[str] = ("entity_id",), time: str = "ts", days: float = BLOCK_DAYS) -> None:
        self.spark, self.root, self.by, self.time, self.days = spark, root.rstrip("/"), list(by), time, days

    def append(self, rows: DataFrame, increment: int) -> None:
        """Adds the readings of one increment. An increment that runs again replaces its own files."""
        blocked = materialize(rows.withColumn(BLOCK, block_of(self.time, self.days)), "increment")
        (blocked.repartition(BLOCK, *self.by).sortWithinPartitions(*self.by, self.time)
         .write.mode("overwrite").partitionBy(BLOCK).parquet(f"{self.root}/rows/increment={increment}"))
        (blocked.groupBy(*self.by, BLOCK).agg(F.count(F.lit(1)).alias("n"), F.min(self.time).alias("first_ts"), F.max(self.time).alias("last_ts"))
         .write.mode("overwrite").parquet(f"{self.root}/index/increment={increment}"))

    def rows(self) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.root}/rows").parquet(f"{self.root}/rows").drop("increment")

    def index(self) -> DataFrame:
        """A row per entity and block."""
        return self.spark.read.parquet(f"{self.root}/index").groupBy(*self.by, BLOCK).agg(
            F.sum("n").alias("n"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))

    def known(self) -> DataFrame:
        """Entities and the newest time of each, from the index."""
        return self.index().groupBy(*self.by).agg(F.max("last_ts").alias("stored_until"), F.sum("n").alias("n_rows"))

    def _from(self, bounds: DataFrame) -> DataFrame:
        """Readings from each entity's ``_block`` on; the least block and time of all are literals in the scan."""
        least = bounds.agg(F.min("_block").alias("block"), F.min("_first").alias("first")).first()
        rows = self.rows()
        if least["block"] is None:
            return join_null_safe(rows.where(F.lit(False)), bounds, self.by)
        rows = rows.where((F.col(BLOCK) >= F.lit(least["block"])) & (F.col(self.time) >= F.lit(least["first"])))
        return join_sized(rows, bounds, self.by).where(F.col(BLOCK) >= F.col("_block"))

    def trailing(self, n: int = config.CONTEXT_ROWS, until: DataFrame | None = None) -> DataFrame:
        """The last ``n`` readings of every entity with their positions (``row_no``).

        ``until`` (keys, ``stored_until``) takes the last ``n`` up to that time and all later readings,
        which are marked ``is_new``; an entity that is not listed there is new as a whole.
        """
        index = materialize(self.index(), "index")
        newest = Window.partitionBy(*self.by).orderBy(F.desc(BLOCK))  # a row per block
        earlier = Window.partitionBy(*self.by).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
        index = index.withColumn("_rows_before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        if until is None:
            marked = index.withColumn("stored_until", F.col("last_ts"))
        else:
            marked = join_sized(index, until, self.by, "left")
        # blocks that end after the mark count nothing; the one the mark lies in is passed as well
        whole = F.when(F.col("last_ts") <= F.col("stored_until"), F.col("n")).otherwise(0)
        later = F.coalesce(F.sum(whole).over(newest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        bounds = marked.withColumn("_later", later).where(F.col("_later") < n).groupBy(*self.by).agg(
            F.min(BLOCK).alias("_block"), F.min("first_ts").alias("_first"), F.min("_rows_before").alias("_rows_before"))
        rows = number_rows(self._from(materialize(bounds, "bounds")), self.by, self.time, days=self.days)
        rows = rows.withColumn("row_no", F.col("row_no") + F.col("_rows_before")).drop("_block", "_first", "_rows_before", BLOCK)
        if until is None:
            ends = materialize(self.known().select(*self.by, "n_rows"), "ends")
            return join_sized(rows, ends, self.by).where(F.col("row_no") > F.col("n_rows") - n).drop("n_rows")
        marked = join_sized(rows, until, self.by, "left")
        marked = marked.withColumn("is_new", F.col("stored_until").isNull() | (F.col(self.time) > F.col("stored_until"))).drop("stored_until")
        marked = materialize(marked, "context")
        firsts = marked.where("is_new").groupBy(*self.by).agg(F.min("row_no").alias("_first"))
        return join_sized(marked, firsts, self.by).where(F.col("row_no") >= F.col("_first") - n).drop("_first")

    def after(self, mark: DataFrame) -> DataFrame:
        """Readings after the stored time of their entity, all of an entity without one.

        The index tells which blocks hold any, so neither keys nor readings of the whole history are read.
        """
        index = join_sized(self.index(), mark, self.by, "left").where(
            F.col("stored_until").isNull() | (F.col("last_ts") > F.col("stored_until")))
        bounds = index.groupBy(*self.by).agg(F.min(BLOCK).alias("_block"), F.min("first_ts").alias("_first"), F.max("stored_until").alias("stored_until"))
        rows = self._from(materialize(bounds, "bounds"))
        return rows.where(F.col("stored_until").isNull() | (F.col(self.time) > F.col("stored_until"))).drop("_block", "_first", "stored_until", BLOCK)
