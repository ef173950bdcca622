"""A keyed store whose merges read and write only the files that a batch touches.

The rows lie in files that cover ranges of the key one after the other. A version of the store is a
manifest, a small table with a row per file: its least and greatest key and its rows. A file owns the keys
from its least one up to the least key of the next file (the first one also what lies before). A batch finds
the owners of its keys, these files alone are read, merged and written anew, each in its own range, and the
next manifest names them beside all the others, which stay as they are. Versions are committed by
``versions.commit_merged``: a writer that was late reads the new manifest and merges again.

NULL keys come first, as in Spark's ascending order. The driver holds a row per file, as it does for any
listing of files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadtime.plans.lineage import join_null_safe, materialize
from leadtime.sources.sinks import upsert
from leadtime.sources.versions import commit_merged, current_version, data_path

#: Rows of a file when it is written.
FILE_ROWS = 1_000_000
#: Rows that are worth a task; it writes as many files as they make.
TASK_ROWS = 250_000
OWNER = "_owner"


def _key(keys: Sequence[str]) -> Column:
    return F.struct(*keys)


def _manifest_of(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """(file, low, high, n_rows) of the files just written below ``path``."""
    rows = spark.read.parquet(path)
    return rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(_key(keys)).alias("low"), F.max(_key(keys)).alias("high"), F.count(F.lit(1)).alias("n_rows"))


def _ranges(rows: DataFrame, keys: Sequence[str], n: int, file_rows: int) -> DataFrame:
    """About ``n`` rows dealt into tasks by ranges of the key: one shuffle, which grouping by the key needs as well."""
    return rows.repartitionByRange(-(-n // max(file_rows, TASK_ROWS)), OWNER, *keys)


def _write(dealt: DataFrame, path: str, keys: Sequence[str], n: int, file_rows: int) -> None:
    """Files of at most ``file_rows`` rows, each inside one owner's range and covering a range of its own.

    A task has a range of the key in order and ends a file when it is full, so small files don't mean small tasks.
    """
    files = -(-n // file_rows)
    (dealt.sortWithinPartitions(OWNER, *keys)
     .write.option("maxRecordsPerFile", -(-n // files)).partitionBy(OWNER).parquet(path))


def owners(lows: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The batch with ``_owner``: the position of the file that owns each row's key.

    ``lows`` has ``low`` and ``position``. Files and keys are laid into ranges of the key together; what
    begins before a range arrives as one row per range, so neither side is collected.
    """
    marks = lows.select(*[F.col(f"low.{k}").alias(k) for k in keys], F.col("position").alias("_mark"))
    both = marks.withColumn("_real", F.lit(0)).unionByName(batch.withColumns({"_real": F.lit(1), "_mark": F.lit(None).cast("int")}), allowMissingColumns=True)
    dealt = materialize(both.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()), "ranges")
    seeds = dealt.groupBy("_range").agg(F.max("_mark").alias("_last"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    seeds = seeds.select("_range", F.max("_last").over(before).alias("_last"))
    upto = Window.partitionBy("_range").orderBy(*keys, "_real").rowsBetween(Window.unboundedPreceding, 0)
    found = join_null_safe(dealt, seeds, ["_range"]).withColumn(OWNER, F.coalesce(F.max("_mark").over(upto), "_last", F.lit(0)))
    return found.where("_real = 1").select(*batch.columns, OWNER)


def create(df: DataFrame, root: str, keys: Sequence[str], file_rows: int = FILE_ROWS, written: bool = False) -> str:
    """The first version; ``df`` has one row per key, and is written first unless it is already. Returns the manifest's path."""
    spark = df.sparkSession

    def first(before: str | None) -> str:
        if before is not None:
            raise ValueError(f"{root} exists")
        data, manifest = data_path(root), data_path(root)
        rows = (df if written else materialize(df, "merged")).withColumn(OWNER, F.lit(0))
        n = max(1, rows.count())
        _write(_ranges(rows, keys, n, file_rows), data, keys, n, file_rows)
        _manifest_of(spark, data, keys).coalesce(1).write.parquet(manifest)
        return manifest

    return commit_merged(spark, root, first)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """(file, low, high, n_rows) of the current version."""
    path = current_version(spark, root)
    if path is None:
        raise FileNotFoundError(f"no store below {root}")
    return spark.read.parquet(path)


def _read_files(spark: SparkSession, files: Sequence[str], keys: Sequence[str]) -> DataFrame:
    rows = spark.read.option("recursiveFileLookup", True).parquet(*files)  # the folder names are no columns
    return rows


def read(spark: SparkSession, root: str, low: Sequence | None = None, high: Sequence | None = None) -> DataFrame:
    """The rows of the current version; files that lie wholly outside ``low`` to ``high`` are not opened."""
    listed = manifest(spark, root)
    key = listed.schema["low"].dataType.fieldNames()
    wanted, inside = listed, F.lit(True)
    if low is not None:
        edge = F.struct(*[F.lit(v).cast(listed.schema["low"].dataType[n].dataType).alias(n) for n, v in zip(key, low)])
        wanted, inside = wanted.where(F.col("high") >= edge), inside & (F.struct(*key) >= edge)
    if high is not None:
        edge = F.struct(*[F.lit(v).cast(listed.schema["low"].dataType[n].dataType).alias(n) for n, v in zip(key, high)])
        wanted, inside = wanted.where(F.col("low") <= edge), inside & (F.struct(*key) <= edge)
    names = [r.file for r in wanted.select("file").collect()]  # a row per file
    if not names:
        return _read_files(spark, [listed.first().file], key).where(F.lit(False))
    return _read_files(spark, names, key).where(inside)


def merge(new: DataFrame, root: str, keys: Sequence[str], keep: str = "last", order: Sequence[str] = (),
          file_rows: int = FILE_ROWS, written: bool = False) -> str:
    """``sinks.upsert`` of a batch into the store; returns the new manifest's path.

    The batch is written first, as it is read several times, unless it is ``written`` already.
    """
    spark, batch = new.sparkSession, new if written else materialize(new, "batch")

    def step(before: str | None) -> str:
        if before is None:
            raise FileNotFoundError(f"no store below {root}")
        listed = spark.read.parquet(before)
        place = Window.orderBy("low")  # a row per file
        lows = materialize(listed.withColumn("position", F.row_number().over(place) - 1), "lows")
        placed = materialize(owners(lows, batch.select(*keys).distinct(), keys), "owners")  # the keys alone
        hit = lows.join(placed.select(F.col(OWNER).alias("position")).distinct(), "position")
        # neighbours that are all read are one range, so that merging doesn't cut the files smaller each time
        island = F.col("position") - F.row_number().over(Window.orderBy("position"))  # a row per file
        touched = materialize(hit.withColumn(OWNER, F.min("position").over(Window.partitionBy(island))), "touched")
        names = [r.file for r in touched.select("file").collect()]  # a row per file that is read
        path = data_path(root)
        if not names:  # an empty batch changes nothing
            return before
        marks = touched.select(F.col("file").alias("_file"), OWNER)
        placed = placed.withColumnRenamed(OWNER, "position").join(touched.select("position", OWNER), "position").drop("position")
        rows = _read_files(spark, names, keys).select("*", F.col("_metadata.file_path").alias("_file")).join(marks, "_file").drop("_file")
        data = data_path(root)
        n = batch.count() + touched.agg(F.sum("n_rows")).first()[0]  # no fewer than are left
        merged = upsert(rows, join_null_safe(batch, placed, keys), [*keys, OWNER], keep, order, lambda both: _ranges(both, keys, n, file_rows))
        _write(merged, data, keys, n, file_rows)
        kept = listed.join(touched.select("file"), "file", "left_anti")
        kept.unionByName(_manifest_of(spark, data, keys)).coalesce(1).write.parquet(path)
        return path

    return commit_merged(spark, root, step)
