"""Mixing sources to target weights, exact to the word.

Each document gets a hash-random key. Within its source the documents are sorted by that key, and the running sum of
their sizes says where the source's budget is cut; a budget beyond the source's size repeats whole epochs first. The
running sum is distributed: keys are dealt into buckets that hold about the same number of rows whatever the source's
share, rows are summed inside a bucket and bucket totals among each other.

Nulls: a null source is a source of its own and comes last; a null text has size 0. Empty input gives an empty result,
documents without words take nothing. Rows with equal keys (repeated ids) are ordered by id, then size; equal rows in
any order give the same rows. Columns beside those asked for are ignored.
"""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadtime.plans.lineage import materialize

#: Rows that a bucket of the running sum should hold.
BUCKET_ROWS = 512
WORD = r"[^ \t-\r]+"


@F.pandas_udf(T.LongType())
def _words(texts: pd.Series) -> pd.Series:
    return pc.fill_null(pc.count_substring_regex(pa.array(texts, pa.large_string(), from_pandas=True), WORD), 0).cast(pa.int64()).to_pandas()


def word_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source and the number of words of each text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), _words(F.col("text").cast("string")).alias("size"))


def targets(totals: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """source, n_rows, source_size -> also lane (a number for the source), target (double) and budget (long).

    Weights repeat over the sources in order of code points, null last. Targets share the total by weight; one beyond
    ``cap`` times its source's size is cut there and the excess shared again by weight. That ends at one water level:
    walking the sources by size over weight, all below the level are cut, all above get weight times level. The table
    has a row per source, so single-task windows over it stay small.
    """
    order = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (order % len(weights) + 1).cast("int")).cast("long")
    rows = totals.withColumn("weight", weight).withColumn("most", F.lit(cap) * F.col("source_size"))
    level = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source")
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = (rows.withColumn("total", F.sum("source_size").over(whole))
            .withColumn("spent", F.sum("most").over(level.rowsBetween(Window.unboundedPreceding, -1)))
            .withColumn("spent", F.coalesce("spent", F.lit(0)))
            .withColumn("weights_left", F.sum("weight").over(level.rowsBetween(0, Window.unboundedFollowing)))
            .withColumn("cut", F.col("most") * F.col("weights_left") < F.col("weight") * (F.col("total") - F.col("spent")))
            .withColumn("at", F.row_number().over(level)))
    first = F.min(F.when(~F.col("cut"), F.struct("at", (F.col("total") - F.col("spent")).alias("rest"), F.col("weights_left").alias("among")))).over(whole)
    rows = rows.withColumn("level", first)
    under = F.col("at") < F.col("level.at")
    share = F.col("weight") * F.col("level.rest")
    return rows.select(F.col("at").alias("lane"), "source", "n_rows", "source_size",
                       F.when(under, F.col("most").cast("double")).otherwise(share.cast("double") / F.col("level.among").cast("double")).alias("target"),
                       F.when(under, F.col("most")).otherwise(F.expr("(weight * level.rest) div level.among")).alias("budget"))


def _goals(sizes: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    totals = sizes.groupBy("source").agg(F.count("*").alias("n_rows"), F.sum("size").alias("source_size"))
    return materialize(targets(totals, weights, cap).withColumnRenamed("source", "of"), "targets")


def _placed(rows: DataFrame, goals: DataFrame, seed: str, bucket_rows: int) -> DataFrame:
    """Rows with their source's goal, random key and bucket."""
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":" + seed)).cast("binary"))
    rows = rows.join(goals, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn("key", key)
    spread = F.ceil(F.col("n_rows") / F.lit(bucket_rows))
    return rows.withColumn("bucket", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * spread / F.lit(float(2**32))))


def _bases(placed: DataFrame) -> DataFrame:
    """Words of a source in front of each of its buckets."""
    totals = placed.groupBy("lane", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("lane").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("lane", "bucket", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("base"))


def _taken(placed: DataFrame, bases: DataFrame, *ties: Column) -> DataFrame:
    """Rows with epochs (whole repeats) and part (words of the last, cut one)."""
    inside = Window.partitionBy("lane", "bucket").orderBy("key", "doc_id", "size", *ties).rowsBetween(Window.unboundedPreceding, -1)
    rows = placed.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(bases, ["lane", "bucket"])
    filled = F.col("source_size") > 0
    start = F.col("base") + F.col("inner")
    rest = F.expr("budget % source_size")
    return (rows.withColumn("epochs", F.when(filled, F.expr("budget div source_size")).otherwise(F.lit(0)).cast("long"))
            .withColumn("part", F.when(filled, F.greatest(F.lit(0), F.least(F.col("size"), rest - start))).otherwise(F.lit(0)).cast("long")))


def mix(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, seed: str = "mix", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, source, size -> doc_id, size, source_size, target, taken: the words that the mix takes of each document.

    ``sizes`` is read several times; pass a written table. The words taken of a source sum up to its target, cut to
    whole words.
    """
    placed = _placed(sizes, _goals(sizes, weights, cap), seed, bucket_rows)
    rows = _taken(placed, _bases(placed))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, seed: str = "mix", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The mix itself, with the columns of ``docs``: each row as often as the mix repeats it, and the rows at which a
    budget ends once more with their first words only (``n_chars``, if there is one, follows the text).

    The texts are shuffled once, by (source, bucket); goals and bucket totals come from a narrow table.
    """
    sizes = materialize(word_sizes(docs), "sizes")
    goals = _goals(sizes, weights, cap)
    bases = materialize(_bases(_placed(sizes, goals, seed, bucket_rows)), "bases")
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    whole = whole.withColumn("size", _words(F.col("row.text").cast("string")))
    rows = _taken(_placed(whole, goals, seed, bucket_rows), bases, F.xxhash64("row.text"))
    rows = rows.where("epochs > 0 AND size > 0 OR part > 0")
    copies = F.sequence(F.lit(1).cast("long"), F.col("epochs") + F.when(F.col("part") > 0, F.lit(1)).otherwise(F.lit(0)))
    rows = rows.withColumn("copy", F.explode(copies))
    cut = F.array_join(F.slice(F.regexp_extract_all("row.text", F.lit(r"([ \t-\r]*[^ \t-\r]+)"), F.lit(1)), F.lit(1), F.col("part").cast("int")), "")
    ends = (F.col("copy") > F.col("epochs")) & (F.col("part") < F.col("size"))
    rows = rows.withColumn("new_text", F.when(ends, cut).otherwise(F.col("row.text")))
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns} | {"text": F.col("new_text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(ends, F.length("new_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return rows.select(*(column.alias(c) for c, column in columns.items()))
