"""Rolling statistics over the last w rows of each series.

Two engines with the same result:

* ``native``: window functions. Means, deviations and exceedances of long frames come from running aggregates
  of segments as long as the frame, at a cost that does not depend on it; an exact percentile sorts each frame again.
* ``halo``: pandas rolling inside each chunk of rows (``applyInArrow``), for long frames.

Both work on chunks of bounded size with the rows before the chunk copied in, so a single long
series spreads over as many tasks as it has chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadtime import config
from leadtime.plans.lineage import join_null_safe, join_sized, materialize
from leadtime.plans.series import CHUNK_ROWS, fill_forward, number_rows, with_halo
from leadtime.operators.baseline import baseline_wide, series_p90

STATS = ("mean", "std", "p95", "exceed")
NATIVE_P95_ROWS = 144
#: Longer frames are joined from two running aggregates; up to this many rows a frame is added up row by row.
NATIVE_FRAME_ROWS = 48
#: Frames of up to this many rows are sorted for a percentile in the halo engine.
SORTED_FRAME_ROWS = 48


def min_rows(w: int) -> int:
    return max(1, w // 3)


def feature_names(sensors: Sequence[str], windows: dict[str, int] = config.WINDOWS,
                  stats: Sequence[str] = STATS) -> list[str]:
    """``{sensor}__{stat}_{window}`` and ``{sensor}__baseline_ratio``, 17 per sensor."""
    names = []
    for s in sensors:
        names += [f"{s}__{stat}_{win}" for win in windows for stat in STATS if stat in stats]
        names.append(f"{s}__baseline_ratio")
    return names


def rolling_features(df: DataFrame, sensors: Sequence[str], base: DataFrame, *,
                     windows: dict[str, int] = config.WINDOWS, engine: str = "halo",
                     by: Sequence[str] = ("entity_id",), time: str = "ts",
                     chunk_rows: int = CHUNK_ROWS, stats: Sequence[str] = STATS, fallback: bool = False) -> DataFrame:
    """Keys plus the rolling features of every sensor; only those of ``stats`` are computed.

    Gaps are filled forward first (0 before the first reading). A sensor without a baseline mean
    is divided by 1; a baseline mean of about 0 leaves the ratio NULL. Without a baseline p90 the
    exceedance is NULL, as nothing here looks ahead; with ``fallback`` its threshold is the p90 of the
    whole filled series (``series_p90``), computed for the entities that need it alone. Sensors shared
    by several families are computed once.
    """
    by, sensors = list(by), list(dict.fromkeys(sensors))
    narrow = df.select(*by, time, *[F.col(s).cast("double").alias(s) for s in sensors])
    spans = df.groupBy(*by).agg(F.lit(1).cast("long").alias("first"), F.count(F.lit(1)).alias("last"))
    if fallback and "exceed" in stats:
        spans = materialize(spans, "spans")
        base = with_series_p90(narrow, sensors, base, spans, by, time)
    rows = fill_forward(narrow, by, time, sensors, number="row_no")
    return rolling_over(rows, sensors, base, windows=windows, engine=engine, by=by, time=time,
                        chunk_rows=chunk_rows, spans=spans, stats=stats)


def with_series_p90(narrow: DataFrame, sensors: Sequence[str], base: DataFrame, entities: DataFrame,
                    by: Sequence[str], time: str) -> DataFrame:
    """The baseline with the whole-series p90 where an entity and sensor have none."""
    base = materialize(base.select(*by, "sensor", "mean", "p90"), "baseline")
    wanted = entities.select(*by, F.explode(F.array(*[F.lit(s) for s in sensors])).alias("sensor"))
    there = base.where(F.col("p90").isNotNull()).select(*by, "sensor")
    lacking = materialize(join_null_safe(wanted, there, [*by, "sensor"], "left_anti"), "lacking")
    if lacking.isEmpty():
        return base
    found = series_p90(join_sized(narrow, lacking.select(*by).distinct(), by), sensors, by, time)
    found = join_null_safe(found, lacking, [*by, "sensor"], "left_semi").withColumn("mean", F.lit(None).cast("double"))
    return base.unionByName(found.select(*by, "sensor", "mean", "p90"))


def rolling_over(rows: DataFrame, sensors: Sequence[str], base: DataFrame, *,
                 windows: dict[str, int] = config.WINDOWS, engine: str = "halo",
                 by: Sequence[str] = ("entity_id",), time: str = "ts",
                 chunk_rows: int = CHUNK_ROWS, spans: DataFrame | None = None,
                 stats: Sequence[str] = STATS, wanted: str | None = None) -> DataFrame:
    """The same for rows that are filled and numbered (``row_no``) already.

    ``spans`` has the first and last position of every entity; it is counted if not given. ``wanted`` names a flag of
    the rows that get features; the others are there for the frames.
    """
    by, sensors = list(by), list(dict.fromkeys(sensors))
    limits = baseline_wide(base, sensors, by)
    reach = max(windows.values()) - 1
    chunk_rows = max(chunk_rows, reach)
    pieces = with_halo(rows, before=reach, chunk_rows=chunk_rows)
    if wanted:
        pieces = pieces.withColumn("own", F.col("own") & F.coalesce(F.col(wanted), F.lit(False)))
    if engine == "native":
        if "p95" in stats and max(windows.values()) > NATIVE_P95_ROWS:
            raise ValueError(f"a built-in percentile sorts every frame again: use the halo engine beyond {NATIVE_P95_ROWS} rows")
        return _native(join_sized(pieces, limits, by, "left"), sensors, windows, by, time, stats)
    if spans is None:
        spans = rows.groupBy(*by).agg(F.min("row_no").alias("first"), F.max("row_no").alias("last"))
    # the limits travel once per chunk and not with every row
    chunks = F.sequence(F.floor((F.col("first") - 1) / chunk_rows), F.floor((F.col("last") - 1) / chunk_rows))
    per_chunk = spans.select(*by, F.explode(chunks).alias("chunk")).join(limits, by, "left")
    return _halo(pieces.select(*by, time, "row_no", "chunk", "own", *sensors), per_chunk, sensors, windows,
                 by, time, stats)


def _divisor(mean: Column) -> Column:
    """|baseline mean|, 1 when there is none, NULL when it is about 0."""
    size = F.abs(F.coalesce(mean, F.lit(1.0)))
    return F.when(size > 1e-6, size)


def _native(pieces, sensors, windows, by, time, stats):
    order = Window.partitionBy(*by, "chunk").orderBy("row_no")
    longest = max(windows, key=windows.get)
    # places in the piece; a NULL sensor reading counts as a row, as it does in a frame
    rows = pieces.withColumn("_pos", F.row_number().over(order))
    wide = sorted({w for w in windows.values() if w > NATIVE_FRAME_ROWS})
    totals, over = {}, {}
    for s in sensors:
        over[s] = F.when(F.col(f"{s}__bl_p90").isNotNull(), F.when(F.col(s) > F.col(f"{s}__bl_p90"), 1.0).otherwise(0.0))
        if "exceed" in stats and wide:
            totals[f"{s}__over"] = F.sum(over[s]).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = _segments(rows.withColumns(totals) if totals else rows, sensors, [w for w in wide if {"mean", "std"} & {*stats} or w == windows[longest]],
                     by, "std" in stats)
    back = sorted({f"{s}__over" for s in sensors if totals} | {c for c in rows.columns if c.startswith("_tail_")})
    rows = rows.withColumns({f"{c}_{w}": F.lag(c, w if c in totals else w - 1).over(order) for c in back for w in wide
                             if c in totals or c.startswith(f"_tail_{w}_")}) if back else rows
    out = []
    for s in sensors:
        for win, w in windows.items():
            frame = order.rowsBetween(-(w - 1), 0)
            ready = F.col("row_no") >= min_rows(w)
            if w in wide:
                made = {"mean": lambda s=s, w=w: _joined(s, w)[0], "std": lambda s=s, w=w: _joined(s, w)[1],
                        "exceed": lambda s=s, w=w: (F.col(f"{s}__over") - F.coalesce(f"{s}__over_{w}", F.lit(0.0))) / F.least("_pos", F.lit(w))}
            else:
                made = {"mean": lambda s=s, f=frame: F.avg(s).over(f), "std": lambda s=s, f=frame: F.stddev_samp(s).over(f),
                        "exceed": lambda s=s, f=frame: F.avg(over[s]).over(f)}
            made["p95"] = lambda s=s, f=frame: F.percentile(s, 0.95).over(f)
            for stat in (x for x in STATS if x in stats):
                value = F.when(ready, made[stat]())
                out.append((F.coalesce(value, F.lit(0.0)) if stat == "std" else value).alias(f"{s}__{stat}_{win}"))
        w = windows[longest]
        mean = F.when(F.col("row_no") >= min_rows(w), _joined(s, w)[0] if w in wide else F.avg(s).over(order.rowsBetween(-(w - 1), 0)))
        out.append((mean / _divisor(F.col(f"{s}__bl_mean"))).alias(f"{s}__baseline_ratio"))
    return (rows.select(*by, time, "row_no", "own", *out).where("own").drop("own", "row_no"))


def _segments(rows, sensors, frames, by, spread):
    """Running aggregates of every sensor from both ends of each segment of ``w`` rows, for every long frame ``w``.

    A frame of ``w`` rows is the tail of one segment (``_tail_w_s`` at its first row) and the head of the next
    (``_head_w_s`` at its last), so a row costs the same for any ``w``, and nothing outside the frame enters its value.
    """
    for w in frames:
        part = Window.partitionBy(*by, "chunk", "_segment")
        rows = rows.withColumn("_segment", F.floor((F.col("_pos") - 1) / w))
        for name, order in (("head", part.orderBy("_pos")), ("tail", part.orderBy(F.desc("_pos")))):
            frame = order.rowsBetween(Window.unboundedPreceding, 0)
            rows = rows.withColumns({f"_{name}_{w}_{s}": F.struct(
                F.count(s).over(frame).cast("double").alias("n"), F.avg(s).over(frame).alias("mean"),
                *([F.var_pop(s).over(frame).alias("var")] if spread else [])) for s in sensors})
    return rows.drop("_segment")


def _joined(s, w):
    """Mean and sample deviation of the last ``w`` rows, from the head and the tail (see ``_segments``)."""
    head, tail = f"_head_{w}_{s}", f"_tail_{w}_{s}_{w}"
    # the first rows have no tail, and at the end of a segment the head is the frame
    two = F.col(tail).isNotNull() & (F.col("_pos") % w != 0) & (F.col(f"{tail}.n") > 0)
    a, b = F.col(f"{tail}.n"), F.col(f"{head}.n")
    n, apart = a + b, F.col(f"{head}.mean") - F.col(f"{tail}.mean")
    mean = F.when(two, F.when(b > 0, F.col(f"{tail}.mean") * (a / n) + F.col(f"{head}.mean") * (b / n)).otherwise(F.col(f"{tail}.mean"))
                  ).otherwise(F.col(f"{head}.mean"))
    squares = F.when(two, F.when(b > 0, F.col(f"{tail}.var") * a + F.col(f"{head}.var") * b + apart * apart * (a * b / n))
                     .otherwise(F.col(f"{tail}.var") * a)).otherwise(F.col(f"{head}.var") * b)
    rows = F.when(two, n).otherwise(b)
    return mean, F.when(rows > 1, F.sqrt(squares / (rows - 1)))


def _halo(pieces, limits, sensors, windows, by, time, stats):
    names = feature_names(sensors, windows, stats)
    keys, spans = [*by, time], dict(windows)
    longest = max(spans, key=spans.get)
    schema = T.StructType([pieces.schema[c] for c in keys]
                          + [T.StructField(n, T.DoubleType()) for n in names])

    def percentile(values, w, q):
        """Of the last ``w`` values; full frames of a few rows are sorted, in less than half the time of a lookup."""
        import numpy as np
        import pandas as pd

        def looked_up(part):
            return pd.Series(part).rolling(w, min_periods=1).quantile(q).to_numpy()

        if not 1 < w <= min(SORTED_FRAME_ROWS, len(values)) or not np.isfinite(values).all():
            return looked_up(values)
        frames = np.sort(np.lib.stride_tricks.sliding_window_view(values, w), axis=1)
        at = q * (w - 1)
        low = min(int(at), w - 2)
        return np.concatenate([looked_up(values[:w - 1]), frames[:, low] + (frames[:, low + 1] - frames[:, low]) * (at - low)])

    def chunk_features(table, limit):
        import numpy as np
        import pandas as pd
        import pyarrow as pa

        table = table.sort_by("row_no")
        own = table["own"].to_numpy()
        kept = table.filter(table["own"])
        row_no = kept["row_no"].to_numpy()
        out = [kept[c].combine_chunks() for c in keys]
        if not len(row_no):
            return pa.table(out + [pa.array([], pa.float64())] * len(names), names=[*keys, *names])
        position = np.flatnonzero(own) + 1
        first, stop = position[0] - 1, position[-1]
        for s in sensors:
            values = table[s].to_numpy()
            p90, bl_mean = limit[f"{s}__bl_p90"][0].as_py(), limit[f"{s}__bl_mean"][0].as_py()
            if p90 is not None:
                over = np.concatenate([[0], np.cumsum(values > p90)])
            for win, w in spans.items():
                ready = row_no >= max(1, w // 3)
                low = max(first - w + 1, 0)  # no frame of this length begins before
                reached, mine = values[low:stop], own[low:stop]
                frame = pd.Series(reached).rolling(w, min_periods=1)
                made = {}
                if "mean" in stats or win == longest:
                    mean = made["mean"] = np.where(ready, frame.mean().to_numpy()[mine], np.nan)
                if "std" in stats:
                    made["std"] = np.where(ready, np.nan_to_num(frame.std().to_numpy()[mine]), 0.0)
                if "p95" in stats:
                    made["p95"] = np.where(ready, percentile(reached, w, 0.95)[mine], np.nan)
                if "exceed" in stats:
                    share = np.full(len(row_no), np.nan)
                    if p90 is not None:
                        start = np.maximum(position - w, 0)
                        share = (over[position] - over[start]) / (position - start)
                        share[~ready] = np.nan
                    made["exceed"] = share
                out += [pa.array(made[x], from_pandas=True) for x in STATS if x in stats]
                if win == longest:
                    size = 1.0 if bl_mean is None else abs(bl_mean)
                    ratio = mean / size if size > 1e-6 else np.full(len(mean), np.nan)
            out.append(pa.array(ratio, from_pandas=True))
        return pa.table(out, names=[*keys, *names])

    group = [*by, "chunk"]
    values = [c for c in limits.columns if c not in group]
    # both sides come from the same readings: renamed keys keep their columns apart
    limits = limits.select(*[F.col(c).alias(f"_of_{c}") for c in group], *values)
    return (pieces.groupBy(*group).cogroup(limits.groupBy(*[f"_of_{c}" for c in group]))
            .applyInArrow(chunk_features, schema))


def family_view(features: DataFrame, family: str, sensors: Sequence[str],
                windows: dict[str, int] = config.WINDOWS, by: Sequence[str] = ("entity_id",),
                time: str = "ts") -> DataFrame:
    """The columns of one family out of features computed once for all families."""
    context = [c for c in (f"hours_since_last_{family}", f"hours_since_last_{family}_log")
               if c in features.columns]
    return features.select(*by, time, *feature_names(sensors, windows), *context)


def smooth_centered(df: DataFrame, column: str, n: int, by: Sequence[str] = ("entity_id",),
                    time: str = "ts", out: str = "smoothed", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Centred moving average of ``n`` rows, edges mirrored (the edge row counts twice).

    The rows a frame needs beyond the ends of a series are mirrored copies with positions
    0, -1, ... and total + 1, ...; they are never output. A series shorter than half the frame is
    mirrored again and again: it repeats with a period of twice its rows.
    """
    left, right = n // 2, n - n // 2 - 1
    rows = number_rows(df, by, time, total="_total").withColumn("_real", F.lit(True))
    period, end = 2 * F.col("_total"), F.col("_total") + right

    def positions(at: Column) -> Column:
        """Places from 1 - left to total + right that show the row at ``at``."""
        first = at - period * F.floor((at - 1 + left) / period)
        return F.when(first <= end, F.sequence(first, end, period)).otherwise(F.array().cast("array<bigint>"))

    row = F.col("row_no")
    places = F.transform(F.concat(positions(row), positions(period + 1 - row)),
                         lambda at: F.struct(at.alias("at"), (at == row).alias("real")))
    mirrored = (rows.withColumn("_p", F.explode(places))
                .withColumns({"row_no": F.col("_p.at"), "_real": F.col("_p.real")}).drop("_p"))
    pieces = with_halo(mirrored, before=left, after=right, chunk_rows=chunk_rows)
    frame = Window.partitionBy(*by, "chunk").orderBy("row_no").rowsBetween(-left, right)
    return (pieces.withColumn(out, F.avg(column).over(frame)).where("own and _real")
            .select(*df.columns, out))
