"""Benchmark decontamination through suffix arrays of the training texts.

Each task cuts its documents into shards of about SLICE_BYTES of text and sorts the word suffixes of a shard (prefix
doubling to DEPTH words, or to a window if that is longer). Every suffix window of the benchmark is then binary-searched in every shard: the interval it
meets in the suffix array are the places where the document holds it word for word. Neighbouring places on one diagonal
join to the longest verbatim matches.

The benchmark is the stated query set. It is read in blocks of at most BLOCK_BYTES of text, each collected and broadcast
by itself, so neither the driver nor a task ever holds more of it than a block (one item longer than that is a block of
its own). Words are compared by 64-bit fingerprints.

A word is a maximal run of letters, digits and non-ASCII characters after lower-casing A-Z. A window is ``window`` words
of an item; an item of fewer words, but not none, is one window. Nulls: a null text has no words; a null item_id is an
item of its own named ``null``. Items with equal ids are one item. Empty tables give an empty result or no matches.
Repeated documents are judged each for itself; very long ones are a shard of their own. Columns beside doc_id and text
(item_id and text) are ignored here and kept by ``remove_contaminated``.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadtime.llm.common import Fingerprints, byte_table, segment_rows, slices, text_buffer, word_spans

WINDOW, DEPTH, BLOCK_BYTES = 13, 16, 4 << 20
#: A document is contaminated if at least one of this many of its words is hit.
SHARE = 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = ~byte_table(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
MATCH = "doc_id long, item_id string, doc_word long, item_word long, n_words long"
SCORE = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
_NO_ITEMS = hashlib.sha256(b"").hexdigest()


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all words of all rows, and the n + 1 bounds of the rows among them."""
    low = _LOWER[data]
    starts, ends, _ = word_spans(_IS_WORD[low], offsets)
    return Fingerprints(low).of(starts, ends), np.searchsorted(starts, offsets)


class SuffixArray:
    """Word suffixes of a shard in order, compared over ``depth`` words at least; a mark stands behind each document."""

    def __init__(self, prints: np.ndarray, bounds: np.ndarray, depth: int = DEPTH) -> None:
        self.vocabulary, rank = np.unique(prints, return_inverse=True)
        n = len(bounds) - 1
        doc, place = segment_rows(np.diff(bounds))
        self.at = bounds[:-1][doc] + place + doc  # each document is one longer by its mark
        self.sequence = np.zeros(len(prints) + n + 2 * depth, np.int64)
        self.sequence[self.at] = rank + 1
        self.doc_at = bounds + np.arange(n + 1)
        order, step = self.sequence, 1
        while step < depth:
            ahead = np.zeros_like(order)
            ahead[:-step] = order[step:]
            key = order * (int(order.max(initial=0)) + 1) + ahead
            by = np.argsort(key)
            fresh = np.zeros(len(key), np.int64)
            fresh[by[1:]] = np.cumsum(key[by[1:]] != key[by[:-1]])
            order, step = fresh, 2 * step
        self.suffixes = self.at[np.argsort(order[self.at], kind="stable")]

    def search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """queries (q, m) of ranks, m up to the depth: the interval of suffixes that begin with each."""
        q, m = queries.shape
        steps = math.ceil(math.log2(len(self.suffixes) + 1)) + 1

        def bound(above: bool) -> np.ndarray:
            lo, hi, column, rows = np.zeros(q, np.int64), np.full(q, len(self.suffixes)), np.arange(m), np.arange(q)
            for _ in range(steps):
                mid = np.minimum((lo + hi) // 2, len(self.suffixes) - 1)
                here = self.sequence[self.suffixes[mid][:, None] + column]
                first = np.argmax(here != queries, axis=1)
                a, b = here[rows, first], queries[rows, first]
                right = ((a <= b) if above else (a < b)) & (lo < hi)
                lo, hi = np.where(right, mid + 1, lo), np.where(right | (lo >= hi), hi, mid)
            return lo

        return bound(False), bound(True)


class Block:
    """Windows of some benchmark items: distinct ones by length, and where they stand."""

    def __init__(self, items: list[tuple[str, str]], window: int) -> None:
        data, offsets = text_buffer(pa.array([t for _, t in items], pa.large_string()))
        prints, bounds = words(data, offsets)
        self.names = [i for i, _ in items]
        self.vocabulary, ranks = np.unique(prints, return_inverse=True)
        count = np.diff(bounds)
        size = np.minimum(count, window)
        self.groups = []
        for m in np.unique(size[size > 0]):
            own = np.flatnonzero(size == m)
            who, place = segment_rows(count[own] - m + 1)
            table = ranks[(bounds[own][who] + place)[:, None] + np.arange(m)]
            distinct, inverse = np.unique(table, axis=0, return_inverse=True)
            by = np.argsort(inverse, kind="stable")
            self.groups.append((int(m), distinct.astype(np.int32), np.searchsorted(inverse[by], np.arange(len(distinct) + 1)),
                                own[who][by].astype(np.int64), place[by].astype(np.int64)))

    def places(self, array: SuffixArray):
        """(window length, suffix positions, item, word in the item) of all occurrences in a shard."""
        if not len(array.suffixes) or not len(self.vocabulary):
            return
        near = np.minimum(np.searchsorted(array.vocabulary, self.vocabulary), len(array.vocabulary) - 1)
        rank = np.where(array.vocabulary[near] == self.vocabulary, near + 1, 0)
        for m, table, starts, item, place in self.groups:
            asked = rank[table]
            known = np.flatnonzero((asked > 0).all(axis=1))
            if not len(known):
                continue
            lo, hi = array.search(asked[known])
            which, turn = segment_rows(hi - lo)
            at, window = array.suffixes[lo[which] + turn], known[which]
            copies, turn = segment_rows((starts[1:] - starts[:-1])[window])
            source = starts[window][copies] + turn
            yield m, at[copies], item[source], place[source]


def _blocks(benchmark: DataFrame, window: int):
    """The benchmark in broadcast blocks."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(2 * total / BLOCK_BYTES)) if total > BLOCK_BYTES else 1
    for i in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        rows = sorted({(r["item_id"], r["text"]) for r in part.collect()})
        yield spark.sparkContext.broadcast(Block(rows, window))


def _examine(shard: SuffixArray, n: int, blocks, window: int):
    """Hit flags over the shard's sequence, (document, item name) pairs, and matches by block."""
    covered = np.zeros(len(shard.sequence) + 1, np.int64)
    found: dict[int, set[str]] = {}
    matches = []
    for held in blocks:
        block = held.value
        for m, at, item, place in block.places(shard):
            np.add.at(covered, at, 1)
            np.add.at(covered, at + m, -1)
            doc = np.searchsorted(shard.doc_at, at, "right") - 1
            pairs = np.unique(doc * len(block.names) + item)
            for d, i in zip(pairs // len(block.names), pairs % len(block.names)):
                found.setdefault(int(d), set()).add(block.names[i])
            matches.append((block, m, at, item, place, doc))
    return np.cumsum(covered)[:-1] > 0, found, matches


def _longest(shard: SuffixArray, matches):
    """Joined places: windows of one item that follow each other in document and item."""
    for block, m, at, item, place, doc in matches:
        by = np.lexsort((at, at - place, item))
        at, item, place, doc = at[by], item[by], place[by], doc[by]
        head = np.flatnonzero(np.r_[True, (item[1:] != item[:-1]) | (at[1:] - place[1:] != at[:-1] - place[:-1]) | (at[1:] != at[:-1] + 1)]) if len(at) else np.zeros(0, np.int64)
        size = m + np.diff(np.r_[head, len(at)]) - 1
        for h, s in zip(head, size):
            yield int(doc[h]), block.names[item[h]], int(at[h] - shard.doc_at[doc[h]]), int(place[h]), int(s)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Longest verbatim matches: doc_id, item_id, first word in document and item (from 0), number of words."""
    blocks = list(_blocks(benchmark, window))

    def work(batches):
        for batch in batches:
            for part, data, offsets in slices(batch, "text"):
                shard = SuffixArray(*words(data, offsets), max(DEPTH, window))
                ids = part.column("doc_id").to_pylist()
                rows = [(ids[d], *rest) for d, *rest in _longest(shard, _examine(shard, len(ids), blocks, window)[2])]
                names = ["doc_id", "item_id", "doc_word", "item_word", "n_words"]
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return _texts(docs).mapInArrow(work, MATCH)


def scores(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    blocks = list(_blocks(benchmark, window))

    def work(batches):
        for batch in batches:
            for part, data, offsets in slices(batch, "text"):
                prints, bounds = words(data, offsets)
                shard = SuffixArray(prints, bounds, max(DEPTH, window))
                n = len(offsets) - 1
                hit, found, _ = _examine(shard, n, blocks, window)
                sums = np.concatenate([[0], np.cumsum(hit[shard.at])])
                n_hit, n_words = sums[bounds[1:]] - sums[bounds[:-1]], np.diff(bounds)
                items = [hashlib.sha256(",".join(sorted(found[d])).encode()).hexdigest() if d in found else _NO_ITEMS for d in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n_words.astype(np.int64)), pa.array(n_hit.astype(np.int64)),
                     pa.array([len(found.get(d, ())) for d in range(n)], pa.int64()), pa.array(items),
                     pa.array((n_hit > 0) & (share * n_hit >= n_words))],
                    names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return _texts(docs).mapInArrow(work, SCORE)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE) -> DataFrame:
    """``docs`` without contaminated documents, all columns kept; no shuffle, rows are judged where they are read."""
    blocks = list(_blocks(benchmark, window))

    def work(batches):
        for batch in batches:
            for part, data, offsets in slices(batch, "text"):
                prints, bounds = words(data, offsets)
                shard = SuffixArray(prints, bounds, max(DEPTH, window))
                hit, _, _ = _examine(shard, len(offsets) - 1, blocks, window)
                sums = np.concatenate([[0], np.cumsum(hit[shard.at])])
                n_hit = sums[bounds[1:]] - sums[bounds[:-1]]
                yield part.filter(pa.array(~((n_hit > 0) & (share * n_hit >= np.diff(bounds)))))

    return docs.mapInArrow(work, docs.schema)
