"""What the two substring operators share: exact removal of repeated windows around content-defined anchors.

A window is ``width`` consecutive items (bytes or words) of one text. A *cutter* gives each window an anchor that depends
on the window's items alone and names it by items inside the window, so equal windows have equally named anchors.
Consecutive windows with one anchor form a run; the items that a run spans are its hull. Then

* runs with equal names and hulls are one class: a class with two runs repeats in every window;
* only windows of classes that share a name with another class can repeat beyond that. Once per class, these are first
  compared in blocks, by the items that all windows of a block have in common (a block is a range of distances from the
  anchor, so equal windows lie in blocks of the same number), and then one by one where that core is shared.

Each step is a grouping or join on keys that are reduced before the shuffle; copies of a text meet as one class and are
never paired. A window counts as repeated when its sequence starts anywhere else, in the same text or another one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadtime.llm.common import segment_rows, slices
from leadtime.plans.lineage import materialize

#: Bytes of text that a cutter looks at together, and bits of the filter that says which documents are worth a shuffle.
CUT_BYTES, FILTER_BITS = 1 << 20, 1 << 25

RUNS = "id long, start long, n int, shift int, name long, hull long"
CORES = "id long, start long, n int, first int, name long, hull long, block int, print long"


def _runs(cutter, names_only: bool):
    def work(batches):
        for batch in batches:
            for part, data, offsets in slices(batch, "text", CUT_BYTES):
                ids = part.column("id").to_numpy()
                for row, start, n, shift, name, hull in cutter.runs(data, offsets):
                    columns = [pa.array(name.view(np.int64))]
                    if not names_only:
                        columns = [pa.array(ids[row]), pa.array(start.astype(np.int64)), pa.array(n.astype(np.int32)), pa.array(shift.astype(np.int32)),
                                   *columns, pa.array(hull.view(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, names=["name"] if names_only else ["id", "start", "n", "shift", "name", "hull"])
    return work


def names_of(texts: DataFrame, cutter) -> DataFrame:
    """The anchor name of every run of ``texts`` (id, text)."""
    return texts.mapInArrow(_runs(cutter, True), "name long")


def runs_of(texts: DataFrame, cutter) -> DataFrame:
    return texts.mapInArrow(_runs(cutter, False), RUNS)


def _listed(part: pa.RecordBatch, column: str, fields: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Row and fields of the structs in a list column."""
    wanted = part.column(column)
    rows = np.repeat(np.arange(part.num_rows), np.diff(np.asarray(wanted.offsets)))
    flat = wanted.flatten()
    return rows, [flat.field(i).to_numpy(zero_copy_only=False) for i in range(fields)]


def _cores(cutter):
    def work(batches):
        for batch in batches:
            for part, data, offsets in slices(batch, "text", CUT_BYTES):
                rows, (start, n, shift, name, hull) = _listed(part, "runs", 5)
                size, ids = cutter.block, part.column("id").to_numpy()
                low, high = (shift - n + 1) // size, shift // size  # blocks of the distances from anchor to window start
                owner, turn = segment_rows(high - low + 1)
                block = low[owner] + turn
                first = shift[owner] - np.minimum(shift[owner], block * size + size - 1)
                last = shift[owner] - np.maximum((shift - n + 1)[owner], block * size)
                anchor = start[owner] + shift[owner]
                print_ = cutter.prints(data, offsets, rows[owner], anchor - block * size, cutter.width - size + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[rows[owner]]), pa.array(start[owner] + first), pa.array((last - first + 1).astype(np.int32)), pa.array(first.astype(np.int32)),
                     pa.array(name[owner]), pa.array(hull[owner]), pa.array(block.astype(np.int32)), pa.array(print_.view(np.int64))],
                    names=["id", "start", "n", "first", "name", "hull", "block", "print"])
    return work


def _windows(cutter):
    def work(batches):
        for batch in batches:
            for part, data, offsets in slices(batch, "text", CUT_BYTES):
                rows, (start, n, first, name, hull) = _listed(part, "runs", 5)
                owner, place = segment_rows(n)
                print_ = cutter.prints(data, offsets, rows[owner], start[owner] + place, cutter.width)
                yield pa.RecordBatch.from_arrays([pa.array(name[owner]), pa.array(hull[owner]), pa.array((first[owner] + place).astype(np.int32)), pa.array(print_.view(np.int64))],
                                                 names=["name", "hull", "place", "print"])
    return work


def _remove(cutter):
    def work(batches):
        for batch in batches:
            for part, data, offsets in slices(batch, "text", CUT_BYTES):
                rows, (start, n) = _listed(part, "spans", 2)
                size, removed, pieces, kept = cutter.cut(data, offsets, rows, start, n)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(pieces, pa.int64()),
                                                  pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                                                  pa.array(kept if cutter.texts else [None] * len(kept), pa.binary())],
                                                 names=["id", "n_items", "n_removed", "n_spans", "kept_sha256", "kept"])
    return work


class Marked:
    """A filter of fixed size over ids: false for most ids that aren't in ``rows``, never for one that is.

    It only saves shuffling texts that nobody asks for; whatever it lets through is decided by the join behind it. The
    driver gets at most FILTER_BITS / 64 words.
    """

    def __init__(self, rows: DataFrame, column: str) -> None:
        cell = F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))
        words = rows.select(cell.alias("cell")).groupBy(F.shiftright("cell", 6).alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(cell & 63 as int))")).alias("bits")).toArrow()
        table = np.zeros(FILTER_BITS // 64, np.uint64)
        table[words.column("word").to_numpy().astype(np.int64)] = words.column("bits").to_numpy().view(np.uint64)
        self.table = rows.sparkSession.sparkContext.broadcast(table)

    def holds(self, column: str):
        held = self.table

        @F.pandas_udf("boolean")
        def look(cells: pd.Series) -> pd.Series:
            at = cells.to_numpy(np.int64)
            return pd.Series((held.value[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)) == 1)

        return look(F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)))


def repeated_windows(texts: DataFrame, cutter, names: DataFrame) -> DataFrame:
    """id, spans (start and number of consecutive repeated windows) for the texts that have any.

    ``names``: the distinct anchor names that occur twice or more.
    """
    met = materialize(runs_of(texts, cutter).join(names, "name", "left_semi"), "runs")
    classes = materialize(met.groupBy("name", "hull").agg(F.count("*").alias("copies"), F.min(F.struct("id", "start", "n", "shift")).alias("first")), "classes")
    mixed = classes.groupBy("name").agg(F.count("*").alias("classes"), F.min("copies").alias("least")).where("classes > 1 AND least = 1").select("name")
    asked = classes.join(mixed, "name", "left_semi").select("first.id", F.struct("first.start", "first.n", "first.shift", "name", "hull").alias("run"))
    cores = materialize(_beside(texts, asked).mapInArrow(_cores(cutter), CORES), "cores")
    shared = cores.groupBy("name", "block", "print").agg(F.min("hull").alias("a"), F.max("hull").alias("b")).where("a <> b").select("name", "block", "print")
    asked = cores.join(shared, ["name", "block", "print"], "left_semi").select("id", F.struct("start", "n", "first", "name", "hull").alias("run"))
    windows = materialize(_beside(texts, asked).mapInArrow(_windows(cutter), "name long, hull long, place int, print long"), "windows")
    twice = windows.groupBy("name", "print").agg(F.min("hull").alias("a"), F.max("hull").alias("b")).where("a <> b").select("name", "print")
    single = windows.join(twice, ["name", "print"], "left_semi").groupBy("name", "hull").agg(F.collect_set("place").alias("places"))
    whole = classes.where("copies > 1").select("name", "hull", F.lit(None).cast("array<int>").alias("places"))
    known = whole.union(single.join(classes.where("copies = 1").select("name", "hull"), ["name", "hull"], "left_semi").select("name", "hull", "places"))
    found = met.join(known, ["name", "hull"])
    all_of = F.array(F.struct(F.col("start"), F.col("n").cast("long").alias("n")))
    some_of = F.transform("places", lambda p: F.struct((F.col("start") + p).alias("start"), F.lit(1).cast("long").alias("n")))
    spans = F.when(F.col("places").isNull(), all_of).otherwise(some_of)
    return materialize(found.select("id", spans.alias("spans")).groupBy("id").agg(F.flatten(F.collect_list("spans")).alias("spans")), "spans")


def _beside(texts: DataFrame, asked: DataFrame) -> DataFrame:
    """id, runs, text of the texts that are asked for something."""
    asked = materialize(asked.groupBy("id").agg(F.collect_list("run").alias("runs")), "asked")
    return texts.where(Marked(asked, "id").holds("id")).join(asked, "id").select("id", "runs", "text")


def remove(texts: DataFrame, cutter, spans: DataFrame) -> DataFrame:
    """id, n_items, n_removed, n_spans, kept_sha256, kept for every text. Only texts with spans are shuffled."""
    mark = Marked(spans, "id")
    flagged = texts.withColumn("marked", F.when(F.col("id").isNull(), F.lit(False)).otherwise(mark.holds("id")))
    none = F.array().cast("array<struct<start:long,n:long>>")
    plain = flagged.where("NOT marked").select("id", "text", none.alias("spans"))
    joined = flagged.where("marked").select("id", "text").join(spans, "id", "left").select("id", "text", F.coalesce("spans", none).alias("spans"))
    return plain.union(joined).mapInArrow(_remove(cutter), "id long, n_items long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def covered(bounds: np.ndarray, rows: np.ndarray, start: np.ndarray, n: np.ndarray, width: int) -> np.ndarray:
    """Flags of the items of all rows that lie in a repeated window; bounds: n + 1 bounds of the rows."""
    turns = np.zeros(int(bounds[-1]) + 1, np.int32)
    np.add.at(turns, bounds[rows] + start, 1)
    np.add.at(turns, bounds[rows] + start + n + width - 1, -1)
    return np.cumsum(turns, dtype=np.int32)[:-1] > 0


def span_counts(flags: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flagged items and maximal flagged stretches of each row."""
    head = flags.copy()
    head[1:] &= ~flags[:-1]
    inside = bounds[:-1][bounds[:-1] < bounds[1:]]
    head[inside] = flags[inside]
    total = np.concatenate([[0], np.cumsum(flags)])
    heads = np.concatenate([[0], np.cumsum(head)])
    return total[bounds[1:]] - total[bounds[:-1]], heads[bounds[1:]] - heads[bounds[:-1]]


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and text; a null text counts as empty."""
    return docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
