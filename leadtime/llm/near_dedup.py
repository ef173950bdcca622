"""MinHash near-dedup by a multi-index Hamming join of signatures.

1. Every document becomes its set of distinct word shingles (64-bit fingerprints). Documents with equal sets are one
   representative from here on, so exact copies never meet as pairs.
2. A representative's signature has CHUNKS x CHUNK symbols, each the lowest BITS bits of a mixed minimum hash. The
   distance of two signatures is the number of unequal symbols.
3. Pigeonhole: at a distance of at most ERRORS * CHUNKS + CHUNKS - 1 some chunk has at most ERRORS unequal symbols. All
   ways to leave ERRORS symbols out of a chunk are enumerated as index keys, so each such pair meets under a key; pairs
   at a Jaccard similarity of 0.8 that are farther apart meet as well with a probability of all but about 1e-7.
4. Under a key, signatures at most FAR apart are linked; a task gives back a spanning forest, never all pairs. Keys
   with many members are split into pairs of blocks, each its own task. The components of these links hold every true
   link.
5. Inside a component the links are confirmed on the full sets: shared shingles are counted exactly by products of
   0/1 matrices, block by block. Again large components are split into pairs of blocks and only forests are returned.
   The components of the confirmed links are the result.

Words are split at [\\x20\\x09-\\x0D] after lower-casing A-Z. Nulls: a null or empty text, or one without words, has no
shingles and is linked with nothing; a null id is a component of its own (null). Rows that share an id are one document.
A text with fewer words than a shingle is one shingle. Empty tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadtime.llm.common import IS_SPACE, Fingerprints, mix64, segment_rows, slices, word_spans
from leadtime.llm.graph import components, local_components
from leadtime.plans.lineage import materialize

#: Chunks of a signature, symbols of a chunk, symbols that may differ in one, bits of a symbol, farthest linked distance.
CHUNKS, CHUNK, ERRORS, BITS, FAR = 12, 5, 1, 16, 33
SYMBOLS = CHUNKS * CHUNK
#: Members of a key, and of a component, that one task compares with as many others.
KEY_BLOCK, SET_BLOCK = 4_096, 1_024
#: Up to this many members all pairs of a group are compared at once, beyond it pivot by pivot.
SMALL = 24

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_FACTORS = mix64(np.arange(1, SYMBOLS + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all rows, sorted inside each row, and the n + 1 bounds of the rows."""
    n = len(offsets) - 1
    low = _LOWER[data]
    starts, ends, row = word_spans(~IS_SPACE[low], offsets)
    prints = Fingerprints(Fingerprints(low).of(starts, ends), seed=2)
    bounds = np.searchsorted(row, np.arange(n + 1))
    count = np.diff(bounds)
    size = np.minimum(count, shingle)
    made = np.where(count > 0, count - size + 1, 0)
    owner, place = segment_rows(made)
    first = bounds[:-1][owner] + place
    hashes = prints.of(first, first + size[owner])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], np.searchsorted(owner[new], np.arange(n + 1))


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(rows, SYMBOLS) symbols; rows without shingles are 0."""
    out = np.zeros((len(bounds) - 1, SYMBOLS), np.uint16)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        for j, factor in enumerate(_FACTORS):
            out[some, j] = (mix64(np.minimum.reduceat(hashes * factor, bounds[some])) & np.uint64((1 << BITS) - 1)).astype(np.uint16)
    return out


def index_keys(symbols: np.ndarray) -> np.ndarray:
    """(rows, keys): one key for each chunk and each choice of ERRORS symbols that it leaves out."""
    keys = []
    for c in range(CHUNKS):
        for drop in combinations(range(CHUNK), ERRORS):
            key = np.full(len(symbols), c * 64 + len(keys) % 64, np.uint64)
            for j in range(CHUNK):
                if j not in drop:
                    key = mix64(key ^ symbols[:, c * CHUNK + j].astype(np.uint64))
            keys.append(key.view(np.int64))
    return np.stack(keys, axis=1)


def _binary(table: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(table)
    width = raw.shape[1] * raw.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(raw), [None, pa.py_buffer(raw)]).cast(pa.binary())


def _sketch(shingle: int):
    def work(batches):
        for batch in batches:
            for part, data, offsets in slices(batch, "text"):
                hashes, bounds = shingle_sets(data, offsets, shingle)
                count = np.diff(bounds)
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(hashes ^ np.uint64(seed)))]) for seed in (11, 29)]
                a, b = ((s[bounds[1:]] - s[bounds[:-1]]).view(np.int64) for s in sums)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(count.astype(np.int64)), pa.array(a), pa.array(b),
                                                  _binary(signatures(hashes, bounds))], names=["doc_id", "n_shingles", "set_a", "set_b", "symbols"])
    return work


def _keys(batches):
    for batch in batches:
        if batch.num_rows:
            table = index_keys(_symbols(batch.column("symbols")))
            ids = np.repeat(batch.column("id").to_numpy(), table.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(table.ravel()), pa.array(ids)], names=["key", "id"])


def _symbols(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, SYMBOLS)


def _groups(batches, columns: tuple[str, ...]):
    """Arrow tables of whole groups from rows sorted by ``columns``; a group that goes on is held back."""
    held: list[pa.RecordBatch] = []

    def ids_of(batch: pa.RecordBatch) -> np.ndarray:
        return np.stack([batch.column(c).to_numpy() for c in columns], axis=1)

    for batch in batches:
        if not batch.num_rows:
            continue
        ids = ids_of(batch)
        if held and (ids[0] != ids_of(held[-1].slice(held[-1].num_rows - 1))[0]).any():
            yield pa.Table.from_batches(held)
            held = []
        cuts = np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1
        last = int(cuts[-1]) if len(cuts) else 0
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def _starts(ids: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]).any(axis=1)])


def near_links(symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Smallest row reachable from each row inside its group, over signatures at most FAR apart."""
    label = np.arange(len(symbols))
    small = sizes <= SMALL
    for size in np.unique(sizes[small]):
        heads = starts[small & (sizes == size)]
        if size > 1:
            i, j = np.triu_indices(size, 1)
            for part in range(0, len(heads), max(1, 200_000 // len(i))):
                here = heads[part:part + max(1, 200_000 // len(i))]
                a, b = (here[:, None] + i).ravel(), (here[:, None] + j).ravel()
                near = (symbols[a] != symbols[b]).sum(axis=1) <= FAR
                found = local_components(len(symbols), a[near], b[near])
                label = np.minimum(label, found)
    for head, size in zip(starts[~small], sizes[~small]):
        own, mine = symbols[head:head + size], np.arange(size)
        left = np.ones(size, bool)
        pivot = 0
        while True:  # members outside the first component become pivots in turn
            left[pivot] = False
            near = (own != own[pivot]).sum(axis=1) <= FAR
            reached = np.unique(mine[near])
            mine[np.isin(mine, reached)] = reached[0]
            ahead = np.flatnonzero(left & (mine != mine[0]))
            if not len(ahead):
                break
            pivot = int(ahead[0])
        label[head:head + size] = head + mine
    return label


def _link_near(batches):
    for table in _groups(batches, ("key", "part")):
        ids = table.column("id").to_numpy()
        starts = _starts(np.stack([table.column(c).to_numpy() for c in ("key", "part")], axis=1))
        sizes = np.diff(np.r_[starts, len(ids)])
        label = near_links(_symbols(table.column("symbols")), starts, sizes)
        linked = label != np.arange(len(ids))
        pairs = np.unique(np.stack([ids[linked], ids[label[linked]]], axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _jaccard_links(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Smallest member reachable from each over links with 100 * |A and B| >= percent * |A or B|, counted exactly."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    if n == 2:
        shared = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        near = bool(sizes.all()) and 100 * shared >= percent * (int(sizes.sum()) - shared)
        return np.array([0, 0 if near else 1])
    _, inverse, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), sizes)
    common = often > 1
    column = np.cumsum(common)[inverse] - 1
    owner, column = owner[common[inverse]], column[common[inverse]]
    shared = np.zeros((n, n), np.float32)
    by = np.argsort(column, kind="stable")
    owner, column = owner[by], column[by]
    wide = 1 << 11
    for low in range(0, int(common.sum()), wide):
        a, b = np.searchsorted(column, (low, low + wide))
        flags = np.zeros((n, wide), np.float32)
        flags[owner[a:b], column[a:b] - low] = 1
        shared += flags @ flags.T
    both = shared.astype(np.int64)
    near = (100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)) & (both > 0)
    a, b = np.nonzero(np.triu(near, 1))
    return local_components(n, a, b)


def _link_sets(percent: int):
    def work(batches):
        for table in _groups(batches, ("component", "part")):
            ids = table.column("id").to_numpy()
            starts = _starts(np.stack([table.column(c).to_numpy() for c in ("component", "part")], axis=1))
            raw = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
            out = []
            for head, end in zip(starts, np.r_[starts[1:], len(ids)]):
                if end - head > 1:
                    label = head + _jaccard_links(raw[head:end], percent)
                    here = np.arange(head, end)
                    out.append(np.stack([ids[here[label != here]], ids[label[label != here]]], axis=1))
            pairs = np.concatenate(out) if out else np.zeros((0, 2), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])
    return work


def _with_shingles(shingle: int):
    def work(batches):
        for batch in batches:
            for part, data, offsets in slices(batch, "text"):
                hashes, bounds = shingle_sets(data, offsets, shingle)
                raw = [hashes[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays([part.column("component"), part.column("members"), part.column("id"), pa.array(raw, pa.binary())],
                                                 names=["component", "members", "id", "shingles"])
    return work


def _split(rows: DataFrame, size: str, block: int) -> DataFrame:
    """A row for each pair of blocks that a member takes part in: column ``part``, 0 alone for groups of two blocks' size."""
    blocks = F.when(F.col(size) <= 2 * block, F.lit(1)).otherwise(F.ceil(F.col(size) / F.lit(block))).cast("long")
    rows = rows.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("id", F.lit(3)), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    rows = rows.withColumn("other", other)
    return rows.withColumn("part", F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")).drop("blocks", "own", "other")


def near_components(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = materialize(texts.mapInArrow(_sketch(shingle), "doc_id long, n_shingles long, set_a long, set_b long, symbols binary"), "sketches")
    filled = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    alike = materialize(filled.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("id"), F.first("symbols").alias("symbols")), "sets")
    chosen = alike.select("id", "symbols")
    keys = chosen.mapInArrow(_keys, "key long, id long")
    # counted before the shuffle, so that a key with many members is never brought together before it is split
    often = materialize(keys.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"), "keys")
    met = keys.join(often, "key")
    met = _split(met, "members", KEY_BLOCK).select("key", "part", "id").join(chosen, "id")
    near = met.repartition(parts, "key", "part").sortWithinPartitions("key", "part").mapInArrow(_link_near, "a long, b long")
    coarse = materialize(components(near), "coarse")
    sizes = coarse.groupBy("component").agg(F.count("*").alias("members"))
    members = materialize(coarse.join(sizes, "component"), "members")
    sets = (members.join(texts.withColumnRenamed("doc_id", "id"), "id").select("component", "members", "id", "text")
            .mapInArrow(_with_shingles(shingle), "component long, members long, id long, shingles binary"))
    sets = _split(sets, "members", SET_BLOCK).select("component", "part", "id", "shingles")
    links = sets.repartition(parts, "component", "part").sortWithinPartitions("component", "part").mapInArrow(_link_sets(percent), "a long, b long")
    final = components(links)
    named = rows.select("doc_id", "n_shingles", "set_a", "set_b").join(alike.drop("symbols"), ["set_a", "set_b", "n_shingles"], "left")
    named = named.withColumn("node", F.when(F.col("n_shingles") > 0, F.col("id")))
    named = named.drop("id").join(final.select(F.col("id").alias("node"), "component"), "node", "left")
    component = F.coalesce("component", "node", "doc_id")
    return named.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
                        F.when(F.col("doc_id").isNotNull(), F.col("doc_id") == component).otherwise(F.lit(True)).alias("kept"))


def drop_near_copies(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component (that of the smallest id), all columns kept."""
    gone = near_components(docs, shingle, percent).where("NOT kept").select("doc_id").distinct()
    return docs.join(materialize(gone, "near-copies"), "doc_id", "left_anti").select(*docs.columns)
