"""Suffix-array dedup of long byte strings, through a logarithmic family of sparse suffix arrays.

The text positions that are indexed are sampled by content: every window of ``width`` bytes has the position of its
least fingerprint of PREFIX bytes (the leftmost of equals) as anchor. A batch's suffix array holds, in order, the
suffixes at its anchors, each by the fingerprint of its first PREFIX bytes; comparing fingerprints instead of bytes
keeps equal prefixes together, which is all that a search for long matches asks of the order. It is a table bucketed
and sorted by that key.

A new batch is merge-scanned against each level of the family: a sort-merge join of bucketed tables, without shuffling
the level. Two levels of equal size merge into one of twice the size, so a batch meets only logarithmically many levels
and each entry is rewritten logarithmically often. What the scans meet are common prefixes of at least PREFIX bytes;
``repeats`` extends them to whole windows, on the input, and removes each byte that a repeated window covers.

Nulls: a null text is empty; rows with a null id are reported unchanged and match nothing. Rows that share an id are
told apart only by their texts: give ids that are unique. Empty texts and tables give empty results; texts of any
length pass (long ones are cut in overlapping pieces). Other columns are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadtime.llm.common import Fingerprints
from leadtime.llm.repeats import CUT_BYTES, covered, names_of, remove, repeated_windows, span_counts, texts_of
from leadtime.plans.lineage import fresh_path, materialize

#: Bytes of a window, of an indexed prefix, batches that the corpus is indexed in.
WIDTH, PREFIX, BATCHES = 400, 192, 4
_PLACE = np.uint64((1 << 24) - 1)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    n = len(values)
    if n < width:
        return values[:0]
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


class ByteCutter:
    """Anchors and windows over the bytes of texts."""

    def __init__(self, width: int = WIDTH, prefix: int = PREFIX, texts: bool = False) -> None:
        self.width, self.prefix, self.texts = width, prefix, texts
        self.block = max(1, width // 12)

    def runs(self, data: np.ndarray, offsets: np.ndarray):
        """Row, start in the row, number of windows, distance to the anchor, name and hull of each run, in pieces."""
        step = max(CUT_BYTES * 2, 4 * self.width)
        if len(data) <= step:
            yield self._runs(data, offsets, 0)
            return
        for at in range(0, max(1, len(data) - self.width + 1), step):  # a text beyond the slice size stands alone
            piece = data[at:at + step + self.width - 1]
            row, start, *rest = self._runs(piece, np.array([0, len(piece)]), at)
            yield row, start, *rest

    def _runs(self, data, offsets, shift):
        width, n = self.width, len(data)
        spare = np.maximum(np.diff(offsets) - width + 1, 0)
        if not spare.any():
            none = np.zeros(0, np.int64)
            return none, none, none, none, none.view(np.uint64), none.view(np.uint64)
        prints = Fingerprints(data)
        at = np.arange(n - self.prefix + 1)
        grams = prints.of(at, at + self.prefix)
        least = sliding_least((grams & ~_PLACE) | at.astype(np.uint64), width - self.prefix + 1)
        row = np.repeat(np.arange(len(spare)), spare)
        begin = np.cumsum(spare) - spare
        window = np.arange(len(row)) - begin[row] + offsets[:-1][row]
        anchor = (least[window] & _PLACE).astype(np.int64)
        head = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])])
        count = np.diff(np.r_[head, len(row)])
        first = window[head]
        return row[head], first - offsets[:-1][row[head]] + shift, count, anchor[head] - first, grams[anchor[head]], prints.of(first, first + count + width - 1)

    def prints(self, data, offsets, rows, starts, length: int) -> np.ndarray:
        """Fingerprints of the strings of this length (a window's at most) that start there, in pieces of bounded size."""
        first, step = offsets[:-1][rows] + starts, max(CUT_BYTES * 2, 4 * self.width)
        out = np.zeros(len(first), np.uint64)
        for at in range(0, len(data), step):
            here = np.flatnonzero((first >= at) & (first < at + step))
            if len(here):
                place = first[here] - at
                out[here] = Fingerprints(data[at:at + step + self.width - 1]).of(place, place + length)
        return out

    def cut(self, data, offsets, rows, start, n):
        gone = covered(offsets, rows, start, n, self.width)
        removed, spans = span_counts(gone, offsets)
        kept = [(data[a:b][~gone[a:b]] if r else data[a:b]).tobytes() for a, b, r in zip(offsets[:-1], offsets[1:], removed)]
        return np.diff(offsets), removed, spans, kept


class SuffixFamily:
    """Levels of suffix arrays; level k holds 2**k batches. ``met`` are the prefixes that occurred twice or more."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.levels: dict[int, DataFrame] = {}
        self.met: list[DataFrame] = []
        self.tables: list[str] = []

    def _store(self, rows: DataFrame) -> DataFrame:
        """name, copies as a table bucketed and sorted by name."""
        table = f"suffixes_{uuid.uuid4().hex}"
        (rows.repartition(self.buckets, "name").write.bucketBy(self.buckets, "name").sortBy("name").format("parquet")
         .option("path", fresh_path(self.spark, "suffixes")).saveAsTable(table))
        self.tables.append(table)
        return self.spark.table(table)

    def add(self, names: DataFrame) -> None:
        """Index a batch: its suffix array, the scan against every level, then the merges."""
        array = self._store(names.groupBy("name").agg(F.count("*").alias("copies")))
        self.met.append(array.where("copies > 1").select("name"))
        for level in self.levels.values():
            self.met.append(array.join(level.hint("merge"), "name").select("name"))
        size = 0
        while size in self.levels:
            other = self.levels.pop(size).withColumnRenamed("copies", "more")
            both = array.hint("merge").join(other, "name", "full").select("name", (F.coalesce("copies", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("copies"))
            array, size = self._store(both), size + 1
        self.levels[size] = array

    def repeated(self) -> DataFrame:
        """Distinct names that any scan met."""
        out = self.met[0]
        for more in self.met[1:]:
            out = out.union(more)
        return materialize(out.distinct(), "met")

    def close(self) -> None:
        """Forget the table names; the files stay below the shared folder."""
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")


def find_repeats(texts: DataFrame, cutter: ByteCutter, batches: int = BATCHES) -> DataFrame:
    """Repeated windows of all texts, which enter the family in ``batches`` by a hash of the id."""
    family = SuffixFamily(texts.sparkSession)
    batch = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(batches))
    for b in range(batches):
        family.add(names_of(texts.where((batch == b) & F.col("id").isNotNull()), cutter))
    names = family.repeated()
    family.close()
    return repeated_windows(texts.where("id IS NOT NULL"), cutter, names)


def suffix_dedup(docs: DataFrame, width: int = WIDTH, batches: int = BATCHES, texts: bool = True) -> DataFrame:
    """id, n_items (bytes), n_removed, n_spans, kept_sha256, kept (the remaining bytes where ``texts``; a cut inside a
    character leaves bytes that aren't text)."""
    cutter = ByteCutter(width, max(1, min(PREFIX, width // 2)), texts)
    rows = texts_of(docs)
    return remove(rows, cutter, find_repeats(rows, cutter, batches))
