"""Ordered work on long series without one task per entity.

``Window.partitionBy(entity)`` puts a whole series into one task, which fails when one
entity owns a large part of the data. The functions here cut every series into pieces of
bounded size, and hand each piece the little it must know about its neighbours:

* *time blocks* (``block_of``): fixed spans of time; what a block needs from earlier or
  later blocks is first reduced to one row per block, accumulated over the blocks of the
  series (a handful of rows per year), and put into the block as a *seed* row;
* *row chunks* (``with_halo``): a fixed number of rows, with the neighbouring rows a
  sliding frame reaches into copied along.

A NULL time is a block of its own in front of its series; a NULL key is a series of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadtime.plans.lineage import join_null_safe

DAY_US = 86_400_000_000
HOUR_US = 3_600_000_000
BLOCK_DAYS = 1  # 144 rows at one reading per 10 minutes; pass less for faster readings
CHUNK_ROWS = 16_384


def micros(time: str | Column) -> Column:
    return F.unix_micros(F.col(time) if isinstance(time, str) else time)


def hours_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(float(HOUR_US))


def block_of(time: str | Column, days: float = BLOCK_DAYS) -> Column:
    return F.floor(micros(time) / F.lit(int(days * DAY_US)))


def number_rows(df: DataFrame, by: Sequence[str], time: str, *, tie: Sequence[str] = (),
                days: float = BLOCK_DAYS, out: str = "row_no",
                total: str | None = None) -> DataFrame:
    """1-based position of each row in its series, as ``row_number`` over the whole series.

    The position is the number of rows in earlier blocks plus the position in the block.
    """
    by = list(by)
    blocked = df.withColumn("_block", block_of(time, days))
    series = Window.partitionBy(*by).orderBy("_block")
    sizes = (blocked.groupBy(*by, "_block").agg(F.count(F.lit(1)).alias("_n"))
             .withColumn("_skip", F.coalesce(
                 F.sum("_n").over(series.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    if total:
        sizes = sizes.withColumn(total, F.sum("_n").over(Window.partitionBy(*by)))
    in_block = Window.partitionBy(*by, "_block").orderBy(time, *tie)
    return (join_null_safe(blocked, sizes.drop("_n"), [*by, "_block"])
            .withColumn(out, F.col("_skip") + F.row_number().over(in_block))
            .drop("_block", "_skip"))


def previous_row(df: DataFrame, by: Sequence[str], time: str, columns: Sequence[str], *,
                 tie: Sequence[str] = (), days: float = BLOCK_DAYS,
                 prefix: str = "prev_") -> DataFrame:
    """``lag(column, 1)`` over the whole series: each block gets the last row of the block before."""
    by, columns = list(by), list(columns)
    blocked = df.withColumn("_block", block_of(time, days))
    last = F.max_by(F.struct(*columns), F.struct(time, *tie)).alias("_last")
    series = Window.partitionBy(*by).orderBy("_block")
    seeds = (blocked.groupBy(*by, "_block").agg(last)
             .withColumn("_last", F.lag("_last").over(series))
             .where(F.col("_last").isNotNull())
             .select(*by, "_block", F.lit(0).alias("_real"), *[f"_last.{c}" for c in columns]))
    # a column that is also the order key is carried beside it: the seed sorts first
    both = (blocked.select("*", F.lit(1).alias("_real"), *[F.col(c).alias(f"_c_{c}") for c in columns])
            .unionByName(seeds.select(*by, "_block", "_real",
                                      *[F.col(c).alias(f"_c_{c}") for c in columns]),
                         allowMissingColumns=True))
    order = Window.partitionBy(*by, "_block").orderBy("_real", time, *tie)
    for c in columns:
        both = both.withColumn(f"{prefix}{c}", F.lag(f"_c_{c}").over(order))
    return both.where("_real = 1").drop("_real", "_block", *[f"_c_{c}" for c in columns])


def fill_forward(df: DataFrame, by: Sequence[str], time: str, columns: Sequence[str], *,
                 days: float = BLOCK_DAYS, leading: float | None = 0.0,
                 number: str | None = None, seeds: DataFrame | None = None) -> DataFrame:
    """Last known value of each column; rows before the first known one get ``leading``.

    ``number`` also adds the row position, from the same shuffle. Every block starts with one
    seed row that holds the last known values and the row count of the blocks before it. Who knows
    these already passes them (keys, ``_block``, ``_skip``, columns); ``df`` may then be some blocks only.
    """
    by, columns = list(by), list(columns)
    blocked = df.withColumn("_block", block_of(time, days))
    earlier = (Window.partitionBy(*by).orderBy("_block")
               .rowsBetween(Window.unboundedPreceding, -1))
    if seeds is None:
        seeds = (blocked.groupBy(*by, "_block")
                 .agg(F.count(F.lit(1)).alias("_n"),
                      *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(time))).alias(c) for c in columns])
                 .select(*by, "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_skip"),
                         *[F.last(c, ignorenulls=True).over(earlier).alias(c) for c in columns]))
    seeds = seeds.withColumn("_real", F.lit(0))
    both = blocked.withColumn("_real", F.lit(1)).unionByName(seeds, allowMissingColumns=True)
    order = Window.partitionBy(*by, "_block").orderBy("_real", time)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = {c: F.last(c, ignorenulls=True).over(upto) for c in columns}
    if leading is not None:
        out = {c: F.coalesce(v, F.lit(leading)) for c, v in out.items()}
    keep = list(df.columns)
    if number:
        out[number] = F.max("_skip").over(upto) + F.row_number().over(order) - 1
        keep.append(number)
    rest = [c for c in both.columns if c not in out]
    return (both.select(*rest, *[v.alias(c) for c, v in out.items()])
            .where("_real = 1").select(*keep))


def with_halo(df: DataFrame, row_no: str = "row_no", *, before: int = 0, after: int = 0,
              chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Give every row its ``chunk``; copy the rows a frame reaches into to the next/previous chunk.

    Copies carry ``own = false`` and are dropped after the frame has been evaluated. A chunk
    holds at most ``chunk_rows + before + after`` rows.
    """
    chunk_rows = max(chunk_rows, before, after, 1)
    chunk = F.floor((F.col(row_no) - 1) / F.lit(chunk_rows))
    pos = F.pmod(F.col(row_no) - 1, F.lit(chunk_rows))
    homes = [F.struct(chunk.alias("chunk"), F.lit(True).alias("own"))]
    if before:
        homes.append(F.when(pos >= chunk_rows - before,
                            F.struct((chunk + 1).alias("chunk"), F.lit(False).alias("own"))))
    if after:
        homes.append(F.when(pos < after,
                            F.struct((chunk - 1).alias("chunk"), F.lit(False).alias("own"))))
    if len(homes) == 1:
        return df.withColumn("chunk", chunk).withColumn("own", F.lit(True))
    return (df.withColumn("_home", F.explode(F.array_compact(F.array(*homes))))
            .select(*df.columns, "_home.chunk", "_home.own"))


def interval_join(points: DataFrame, intervals: DataFrame, by: Sequence[str], time: str,
                  start: str, end: str, *, hours: float, include_end: bool = False,
                  how: str = "inner") -> DataFrame:
    """Pairs with ``start <= time < end`` (or ``<= end``), as an equi-join on slices of time.

    ``how="left"`` also keeps the points that lie in no interval.

    ``hours`` is the usual interval length: an interval is listed in each slice it touches
    (two or three), a point lies in exactly one, so both sides shuffle on (keys, slice).
    """
    by = list(by)
    step = F.lit(max(1, int(hours * HOUR_US)))
    lo, hi = F.floor(micros(start) / step), F.floor(micros(end) / step)
    left = points.withColumn("_slice", F.floor(micros(time) / step))
    right = (intervals.withColumn("_slice", F.explode(F.sequence(lo, hi)))
             .withColumnsRenamed({c: f"_r_{c}" for c in [*by, "_slice"]}))
    inside = (F.col(time) <= F.col(end)) if include_end else (F.col(time) < F.col(end))
    inside &= F.col(time) >= F.col(start)
    for c in [*by, "_slice"]:
        inside &= F.col(c) == F.col(f"_r_{c}")
    return left.join(right, inside, how).drop("_slice", *[f"_r_{c}" for c in [*by, "_slice"]])
