"""Exact dedup through a cuckoo-filter index of live digests.

The index lies in shards by digest. A shard holds a cuckoo filter (buckets of four 16-bit fingerprints) and the stored
keys in the order of their first bucket. A digest whose fingerprint is found is a possible hit and is compared with the
stored keys of its bucket; only equal digests are the same. When an insertion can't find a place, the filter is rebuilt
with twice the buckets from the stored keys. Every call writes a new version of the index below the shared folder, so
a lost executor or a retried task never sees a half-changed shard.

Nulls: a null text counts as empty; rows with a null digest can't be in the index and are refused. Empty input gives an
empty index. Repeated rows count once each. Columns beside those asked for are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadtime.llm.common import SPACES, mix64
from leadtime.plans.lineage import fresh_path, materialize

SLOTS = 4
#: Share of the slots that a fresh filter may fill, and rounds of moving before it counts as full.
LOAD, MOVES = 0.85, 200
#: Digests that a shard should hold at most; insertions go through the filter in slices of this many rows.
SHARD_ROWS, SLICE_ROWS = 40_000, 8_192

_KEYS = pa.schema([("shard", pa.int32()), ("kind", pa.string()), ("digest", pa.binary()), ("keep_id", pa.int64()),
                   ("n_points", pa.int64()), ("group_size", pa.int64()), ("n_buckets", pa.int64()), ("slots", pa.binary())])
KEYS = "shard int, kind string, digest binary, keep_id long, n_points long, group_size long, n_buckets long, slots binary"


class CuckooFilter:
    """A cuckoo filter over 64-bit hashes, worked on a whole array at a time."""

    def __init__(self, n_buckets: int, slots: np.ndarray | None = None) -> None:
        self.n = int(n_buckets)
        self.slots = np.zeros((self.n, SLOTS), np.uint16) if slots is None else slots.reshape(self.n, SLOTS).copy()

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        return cls(1 << max(2, int(np.ceil(np.log2(max(1, keys) / (SLOTS * LOAD))))))

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint (never 0), first and second bucket."""
        prints = (hashes >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        first = (hashes & np.uint64(self.n - 1)).astype(np.int64)
        return prints, first, self.other(first, prints)

    def other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return bucket ^ (mix64(prints.astype(np.uint64)) & np.uint64(self.n - 1)).astype(np.int64)

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        prints, a, b = self.places(hashes)
        return ((self.slots[a] == prints[:, None]) | (self.slots[b] == prints[:, None])).any(axis=1)

    def _put(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """Fill free slots; returns which items found none. Items of one bucket take its free slots in turn."""
        order = np.argsort(bucket, kind="stable")
        b = bucket[order]
        starts = np.flatnonzero(np.r_[True, b[1:] != b[:-1]]) if len(b) else np.zeros(0, np.int64)
        turn = np.arange(len(b)) - np.repeat(starts, np.diff(np.r_[starts, len(b)]))
        free = self.slots[b] == 0
        fits = turn < free.sum(axis=1)
        slot = np.argmax((np.cumsum(free, axis=1) == (turn + 1)[:, None]) & free, axis=1)
        self.slots[b[fits], slot[fits]] = prints[order][fits]
        left = np.ones(len(b), bool)
        left[order] = ~fits
        return left

    def insert(self, hashes: np.ndarray) -> bool:
        """False when some item found no place: the filter is then full and must be rebuilt."""
        prints, a, b = self.places(hashes)
        left = self._put(a, prints)
        prints, bucket = prints[left], b[left]
        for move in range(MOVES):
            left = self._put(bucket, prints)
            prints, bucket = prints[left], bucket[left]
            if not len(prints):
                return True
            _, one = np.unique(bucket, return_index=True)  # one eviction in a bucket and round
            slot = (mix64(prints[one].astype(np.uint64) + np.uint64(move)) % np.uint64(SLOTS)).astype(np.int64)
            out = self.slots[bucket[one], slot].copy()
            self.slots[bucket[one], slot] = prints[one]
            home = bucket[one].copy()
            prints[one] = out
            bucket[one] = self.other(home, out)
        return False

    def delete(self, hashes: np.ndarray) -> None:
        """Clear one equal fingerprint for each hash; call it for stored keys only."""
        for print_, a, b in zip(*self.places(hashes)):
            for bucket in (a, b):
                found = np.flatnonzero(self.slots[bucket] == print_)
                if len(found):
                    self.slots[bucket, found[0]] = 0
                    break


def _hashes(digests: np.ndarray) -> np.ndarray:
    """64-bit hashes of 32-byte digests, from other bytes than those that choose the shard."""
    return mix64(np.ascontiguousarray(digests).view(np.uint8).reshape(-1, 32)[:, 8:16].copy().view(np.uint64).ravel())


class _Shard:
    """Stored keys of one shard, bucketed by first bucket, and their filter."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, filter_: CuckooFilter | None) -> None:
        self.keys, self.values = keys, values  # S32 and (keep_id, n_points, group_size)
        self.filter = filter_ or CuckooFilter.sized(len(keys))
        self.resized = 0
        if filter_ is None and len(keys):
            self._rebuild()
        self._bucket()

    def _bucket(self) -> None:
        first = self.filter.places(_hashes(self.keys))[1] if len(self.keys) else np.zeros(0, np.int64)
        order = np.lexsort((self.keys, first))
        self.keys, self.values, first = self.keys[order], self.values[order], first[order]
        self.starts = np.searchsorted(first, np.arange(self.filter.n + 1))

    def _rebuild(self) -> None:
        while not self.filter.insert(_hashes(self.keys)):
            self.resized += 1
            self.filter = CuckooFilter(self.filter.n * 2)

    def find(self, digests: np.ndarray) -> np.ndarray:
        """Position of each stored digest, -1 for those that the filter or the bucket doesn't hold."""
        at = np.full(len(digests), -1, np.int64)
        if not len(self.keys) or not len(digests):
            return at
        hashes = _hashes(digests)
        maybe = np.flatnonzero(self.filter.may_hold(hashes))
        first = self.filter.places(hashes[maybe])[1]
        lo, hi = self.starts[first], self.starts[first + 1]
        for step in range(int((hi - lo).max(initial=0))):  # a bucket holds a few keys
            here = np.minimum(lo + step, len(self.keys) - 1)
            same = (lo + step < hi) & (self.keys[here] == digests[maybe])
            at[maybe[same]] = here[same]
        return at

    def add(self, digests: np.ndarray, values: np.ndarray) -> None:
        """Insert distinct digests: hits join the stored key, the rest become new keys."""
        at = self.find(digests)
        hit = at >= 0
        if hit.any():
            old, new = self.values[at[hit]], values[hit]
            better = (new[:, 1] > old[:, 1]) | ((new[:, 1] == old[:, 1]) & (new[:, 0] < old[:, 0]))
            old[better, :2] = new[better, :2]
            old[:, 2] += new[:, 2]
            self.values[at[hit]] = old
        if (~hit).any():
            fresh = digests[~hit]
            full = not self.filter.insert(_hashes(fresh))
            self.keys, self.values = np.concatenate([self.keys, fresh]), np.concatenate([self.values, values[~hit]])
            if full:
                self.resized += 1
                self.filter = CuckooFilter(self.filter.n * 2)
                self._rebuild()
            self._bucket()

    def remove(self, digests: np.ndarray) -> None:
        at = self.find(np.unique(digests))
        at = at[at >= 0]
        self.filter.delete(_hashes(self.keys[at]))
        stay = np.ones(len(self.keys), bool)
        stay[at] = False
        self.keys, self.values = self.keys[stay], self.values[stay]
        self._bucket()

    @classmethod
    def load(cls, rows: pa.Table) -> _Shard:
        kinds = np.asarray(rows.column("kind").to_pylist(), dtype=object)
        keys = rows.filter(pa.array(kinds == "key")) if len(kinds) else rows
        tables = rows.filter(pa.array(kinds == "filter")) if len(kinds) else rows
        kept = None
        if tables.num_rows:
            kept = CuckooFilter(tables.column("n_buckets")[0].as_py(), np.frombuffer(tables.column("slots")[0].as_py(), np.uint16))
        return cls(_digests(keys), _values(keys), kept)

    def dump(self, shard: int) -> pa.Table:
        n = len(self.keys)
        none = lambda kind: pa.nulls(n, kind)
        raw = pa.array([bytes(k).ljust(32, b"\0") for k in self.keys], pa.binary())
        keys = pa.table([pa.array(np.full(n, shard, np.int32)), pa.array(["key"] * n), raw, *(pa.array(self.values[:, i]) for i in range(3)),
                         none(pa.int64()), none(pa.binary())], schema=_KEYS)
        table = pa.table([[shard], ["filter"], [None], [None], [None], [None], [self.filter.n], [self.filter.slots.tobytes()]], schema=_KEYS)
        return pa.concat_tables([keys, table])


def _digests(rows: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(rows.column("digest").to_pylist()), "S32")


def _values(rows: pa.Table) -> np.ndarray:
    return np.stack([np.asarray(rows.column(c).to_numpy(), np.int64) for c in ("keep_id", "n_points", "group_size")], axis=1)


def _combined(digests: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One row for each digest: the best document and the number of rows."""
    order = np.lexsort((values[:, 0], -values[:, 1], digests))
    digests, values = digests[order], values[order]
    starts = np.flatnonzero(np.r_[True, digests[1:] != digests[:-1]]) if len(digests) else np.zeros(0, np.int64)
    best = values[starts].copy()
    if len(starts):
        best[:, 2] = np.add.reduceat(values[:, 2], starts)
    return digests[starts], best


def _precombine(batches):
    """Before the shuffle: at most one row for a digest and batch, so a hot digest stays small."""
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        digests, values = _combined(_digests(rows), _values(rows))
        yield pa.RecordBatch.from_arrays(
            [pa.array([bytes(k).ljust(32, b"\0") for k in digests], pa.binary()), *(pa.array(values[:, i]) for i in range(3))],
            names=["digest", "keep_id", "n_points", "group_size"])


def _insert(key, old: pa.Table, new: pa.Table) -> pa.Table:
    shard = _Shard.load(old)
    digests, values = _digests(new), _values(new)
    for at in range(0, len(digests), SLICE_ROWS):
        shard.add(*_combined(digests[at:at + SLICE_ROWS], values[at:at + SLICE_ROWS]))
    return shard.dump(key[0].as_py())


def _delete(key, old: pa.Table, gone: pa.Table) -> pa.Table:
    shard = _Shard.load(old)
    shard.remove(_digests(gone))
    return shard.dump(key[0].as_py())


def _look_up(key, old: pa.Table, asked: pa.Table) -> pa.Table:
    shard = _Shard.load(old)
    digests = np.unique(_digests(asked))
    at = shard.find(digests)
    digests, values = digests[at >= 0], shard.values[at[at >= 0]]
    return pa.table([pa.array([bytes(k).ljust(32, b"\0") for k in digests], pa.binary()), *(pa.array(values[:, i]) for i in range(3))],
                    names=["digest", "keep_id", "n_points", "group_size"])


class CuckooIndex:
    """A versioned index of live digests (32 bytes). Shards bound what a task holds; their number is fixed at creation."""

    def __init__(self, spark: SparkSession, shards: int, path: str | None = None) -> None:
        self.spark, self.shards, self.path = spark, shards, path

    @classmethod
    def create(cls, spark: SparkSession, expected: int) -> CuckooIndex:
        """An empty index for about so many digests; it stays right, with larger shards, beyond."""
        return cls(spark, max(1, -(-expected // SHARD_ROWS)))

    def keys(self) -> DataFrame:
        """The stored keys: digest, keep_id, n_points, group_size."""
        return self._rows().where("kind = 'key'").select("digest", "keep_id", "n_points", "group_size")

    def _rows(self) -> DataFrame:
        if self.path is None:
            return self.spark.createDataFrame([], KEYS)
        return self.spark.read.schema(KEYS).parquet(self.path)

    def _shard(self, digest: str = "digest") -> Column:
        return F.pmod(F.conv(F.hex(F.substring(digest, 1, 7)), 16, 10).cast("long"), F.lit(self.shards)).cast("int")

    def _together(self, rows: DataFrame, work, schema: str) -> DataFrame:
        new = rows.withColumn("shard", self._shard())
        return self._rows().groupBy("shard").cogroup(new.groupBy("shard")).applyInArrow(work, schema)

    def _commit(self, rows: DataFrame) -> CuckooIndex:
        path = fresh_path(self.spark, "cuckoo")
        rows.write.parquet(path)
        return CuckooIndex(self.spark, self.shards, path)

    def insert(self, rows: DataFrame) -> CuckooIndex:
        """rows: digest, keep_id, n_points, group_size (1 for a document). Returns the next version."""
        rows = rows.select("digest", "keep_id", "n_points", "group_size").where("digest IS NOT NULL")
        rows = rows.mapInArrow(_precombine, "digest binary, keep_id long, n_points long, group_size long")
        return self._commit(self._together(rows, _insert, KEYS))

    def delete(self, digests: DataFrame) -> CuckooIndex:
        """Take these digests out, whatever their count; unknown ones change nothing."""
        return self._commit(self._together(digests.select("digest").where("digest IS NOT NULL").distinct(), _delete, KEYS))

    def look_up(self, digests: DataFrame) -> DataFrame:
        """The stored rows of those digests that the index holds."""
        asked = digests.select("digest").where("digest IS NOT NULL").distinct()
        return self._together(asked, _look_up, "digest binary, keep_id long, n_points long, group_size long")


def digest(text: Column) -> Column:
    """SHA-256 (32 bytes) of the text without white space, in UTF-8; null counts as empty."""
    return F.unhex(F.sha2(F.translate(F.coalesce(text, F.lit("")), SPACES, "").cast("binary"), 256))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of texts that are equal without white space the one with the most code points stays, then the smallest id. A null
    id sorts behind all others; of rows that share the staying id, each counts as kept.
    """
    spark = docs.sparkSession
    marked = materialize(docs.select(F.col(id_col).alias("doc_id"), digest(F.col(text_col)).alias("digest"),
                                     F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_points")), "digests")
    rows = marked.select("digest", F.coalesce("doc_id", F.lit(2**63 - 1)).alias("keep_id"), "n_points", F.lit(1).cast("long").alias("group_size"))
    index = CuckooIndex.create(spark, marked.count()).insert(rows)
    keys = index.keys().select("digest", F.when(F.col("keep_id") < 2**63 - 1, F.col("keep_id")).alias("keep_id"), "group_size")
    return marked.join(keys, "digest").select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                                              F.lower(F.hex("digest")).alias("text_sha256"))
