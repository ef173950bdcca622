"""Audit of how far the sources of a language differ in their words, by in-mapper stripes.

A task folds the whole documents it reads into stripes: a hash table from (language, term) to the number of documents
and the occurrences per source. Above STRIPE_CELLS entries it writes the stripes out and starts anew, so its memory is
bounded; Spark shuffles the stripes by (language, term), and tasks merge the sorted stripes of a key into one. A merged
stripe holds all there is to know of its term. Buckets of merged stripes, cut by their number of entries, then meet the
groups of their language, and give the divergences directly: partial sums of every pair of sources, and the terms a
source uses more than its language.

Terms are runs of the letters a-z and of all characters beyond ASCII, A-Z lower-cased. A language keeps its terms of at
least ``least_documents`` documents. Group and language give a kept term p = 1 + floor(10^9 (count + 1) / (N + V)), N
being the occurrences of all kept terms there and V their number, and a pair p, q has the value
floor((p - q)^2 / q). All of it is integer arithmetic; sums stay below 2^63 while a language has fewer than 10^9 terms.

Nulls: a null text, language or source is the empty string. Empty texts and texts without a term make their group occur.
Every row counts as a document, repeated ones too. Empty tables give an empty result. Columns beside text, language and
source are ignored. Bounds: a document's terms lie in one task; the groups of one language meet in each of its buckets
(the result has a row for every pair of them); a term's stripes are at most one per task and spill.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadtime.llm.common import slices, word_spans
from leadtime.plans.lineage import join_null_safe, materialize

LEAST_DOCUMENTS, TOP, ONE = 3, 200, 1_000_000_000
#: Entries (term and source) that a task's stripes may hold before they are written out.
STRIPE_CELLS = 1 << 20
#: Entries of a bucket of merged stripes, and cells of the matrices made of them at a time.
BUCKET_CELLS, BLOCK_CELLS = 1 << 15, 1 << 20
STRIPE = "lang string, term string, df long, sources array<string>, counts array<long>"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_TERM = np.zeros(256, bool)
_IN_TERM[np.r_[65:91, 97:123, 128:256]] = True


class Stripes:
    """Term to (document frequency, occurrences per source), for each language."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.terms: dict[bytes, int] = {}
        self.groups: dict[tuple[str, str], int] = {}
        self.langs: dict[str, int] = {}
        self.cells = {name: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for name in ("counts", "documents")}
        self.pending: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {"counts": [], "documents": []}
        self.waiting = 0

    @property
    def size(self) -> int:
        return len(self.cells["counts"][0])

    def add(self, langs: list[str], sources: list[str], data: np.ndarray, offsets: np.ndarray) -> None:
        """Folds whole documents in."""
        starts, ends, rows = word_spans(_IN_TERM[data], offsets)
        if not len(starts):
            return
        packed = _LOWER[data[_IN_TERM[data]]]
        cuts = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
        coded = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(packed)]).dictionary_encode()
        own = np.array([self.terms.setdefault(t, len(self.terms)) for t in coded.dictionary.to_pylist()], np.int64)
        terms = own[coded.indices.to_numpy()]
        lang = np.array([self.langs.setdefault(x, len(self.langs)) for x in langs], np.int64)
        group = np.array([self.groups.setdefault(x, len(self.groups)) for x in zip(langs, sources)], np.int64)
        keys, counts = np.unique(rows << 32 | terms, return_counts=True)  # a term of a document
        rows, terms = keys >> 32, keys & 0xFFFFFFFF
        self._put("counts", group[rows] << 32 | terms, counts)
        self._put("documents", lang[rows] << 32 | terms, np.ones(len(keys), np.int64))
        self.waiting += len(keys)
        if self.waiting >= STRIPE_CELLS:
            self.settle()

    def _put(self, name: str, keys: np.ndarray, values: np.ndarray) -> None:
        self.pending[name].append(_added(keys, values))

    def settle(self) -> None:
        for name, parts in self.pending.items():
            self.cells[name] = _added(*(np.concatenate(x) for x in zip(self.cells[name], *parts)))
            parts.clear()
        self.waiting = 0

    def rows(self):
        """The stripes as record batches."""
        self.settle()
        keys, counts = self.cells["counts"]
        if not len(keys):
            return
        names = list(self.groups)
        lang_of = np.array([self.langs[lang] for lang, _ in names], np.int64)
        sources = pa.array([source for _, source in names], pa.string())
        group, term = keys >> 32, keys & 0xFFFFFFFF
        stripe = lang_of[group] << 32 | term
        order = np.argsort(stripe, kind="stable")
        stripe, group, counts = stripe[order], group[order], counts[order]
        ends = np.append(np.flatnonzero(stripe[1:] != stripe[:-1]) + 1, len(stripe))
        heads, df = self.cells["documents"]  # in the same order: both are sorted by language and term
        words, langs = pa.array(list(self.terms), pa.binary()), pa.array(list(self.langs), pa.string())
        step = 1 << 16
        for i in range(0, len(heads), step):
            last = ends[i:i + step]
            low = 0 if i == 0 else ends[i - 1]
            cuts = pa.array(np.r_[low, last] - low, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [langs.take(pa.array(heads[i:i + step] >> 32)), words.take(pa.array(heads[i:i + step] & 0xFFFFFFFF)).cast(pa.string()), pa.array(df[i:i + step]),
                 pa.ListArray.from_arrays(cuts, sources.take(pa.array(group[low:last[-1]]))), pa.ListArray.from_arrays(cuts, pa.array(counts[low:last[-1]]))],
                names=["lang", "term", "df", "sources", "counts"])


def _added(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])[:len(keys)]
    return keys[heads], np.add.reduceat(values, heads) if len(heads) else values


def _fold(batches):
    held = Stripes()
    for batch in batches:
        for rows, data, offsets in slices(batch, "text"):
            held.add(rows.column("lang").to_pylist(), rows.column("source").to_pylist(), data, offsets)
            if held.size >= STRIPE_CELLS:
                yield from held.rows()
                held.clear()
    yield from held.rows()


def _merged(part: pa.RecordBatch) -> pa.RecordBatch:
    """One stripe for each run of rows with the same language and term."""
    n = part.num_rows
    changed = np.zeros(n, bool)
    for name in ("lang", "term"):
        codes = part.column(name).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        changed[1:] |= codes[1:] != codes[:-1]
    heads = np.flatnonzero(np.r_[True, changed[1:]])
    run = np.cumsum(changed)
    sources = part.column("sources").flatten().dictionary_encode()
    names = sources.dictionary
    width = max(1, len(names))
    keys = np.repeat(run, part.column("sources").value_lengths().to_numpy(zero_copy_only=False)) * width + sources.indices.to_numpy(zero_copy_only=False)
    keys, counts = _added(keys, part.column("counts").flatten().to_numpy())
    cuts = pa.array(np.searchsorted(keys, np.arange(len(heads) + 1) * width).astype(np.int32))
    at = pa.array(heads)
    return pa.RecordBatch.from_arrays(
        [part.column("lang").take(at), part.column("term").take(at), pa.array(np.add.reduceat(part.column("df").to_numpy(), heads)),
         pa.ListArray.from_arrays(cuts, names.take(pa.array(keys % width))), pa.ListArray.from_arrays(cuts, pa.array(counts))],
        names=["lang", "term", "df", "sources", "counts"])


def _merge(batches):
    """Sorted partial stripes to one stripe for each key; the last one of a batch may go on in the next."""
    held = None
    for part in batches:
        if not part.num_rows:
            continue
        if held is not None:
            part = pa.Table.from_batches([held, part.cast(held.schema)]).combine_chunks().to_batches()[0]
        part = _merged(part)
        if part.num_rows > 1:
            yield part.slice(0, part.num_rows - 1)
        held = part.slice(part.num_rows - 1)
    if held is not None:
        yield held


def stripes(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One stripe for each language and term: df, sources and the occurrences in each."""
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in (("text", text_col), ("lang", lang_col), ("source", source_col))])
    partial = rows.mapInArrow(_fold, STRIPE).repartition(parts, "lang", "term").sortWithinPartitions("lang", "term")
    return partial.mapInArrow(_merge, STRIPE)


def _values(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    gap = p - q
    return gap * gap // q


_PART = "lang string, source string, part string, item string, value long"


def _emit(least: int, top: int):
    """Divergences that the stripes of one bucket give; ``group`` has the one row of their language."""
    def work(bucket: pa.Table, group: pa.Table) -> pa.Table:
        lang, v = group.column("lang")[0].as_py(), group.column("n_terms")[0].as_py()
        names, totals = group.column("names")[0].as_py(), np.array(group.column("totals")[0].as_py(), np.int64)
        number, n = {s: i for i, s in enumerate(names)}, len(names)
        sums = np.zeros((n, n), np.int64)
        tops: list[list[tuple[int, str]]] = [[] for _ in names]
        step = max(1, BLOCK_CELLS // n)
        for at in range(0, bucket.num_rows, step):
            part = bucket.slice(at, step)
            terms, sources, numbers = (part.column(c).to_pylist() for c in ("term", "sources", "counts"))
            counts = np.zeros((len(terms), n), np.int64)
            owner = np.repeat(np.arange(len(terms)), [len(x) for x in sources])
            counts[owner, [number[s] for x in sources for s in x]] = [c for x in numbers for c in x]
            p = 1 + ONE * (counts + 1) // (totals + v)
            whole = 1 + ONE * (counts.sum(axis=1) + 1) // (totals.sum() + v)
            for g in range(n):
                sums[g] += _values(p[:, g:g + 1], p).sum(axis=0)
                more = np.flatnonzero((counts[:, g] > 0) & (p[:, g] > whole))
                if len(more):
                    value = _values(p[more, g], whole[more])
                    if len(more) > top:  # all that may be among the first, ties included
                        edge = np.partition(value, len(value) - top)[len(value) - top]
                        more, value = more[value >= edge], value[value >= edge]
                    found = tops[g] + [(-int(x), terms[i]) for i, x in zip(more, value)]
                    tops[g] = sorted(found, key=lambda x: (x[0], x[1].encode()))[:top]
        rows = [(names[g], "pair", names[h], int(sums[g, h])) for g in range(n) for h in range(n) if g != h]
        rows += [(names[g], "term", term, -x) for g in range(n) for x, term in tops[g]]
        source, kind, item, value = zip(*rows) if rows else ((),) * 4
        return pa.table({"lang": pa.array([lang] * len(rows), pa.string()), "source": pa.array(source, pa.string()), "part": pa.array(kind, pa.string()),
                         "item": pa.array(item, pa.string()), "value": pa.array(value, pa.int64())})
    return work


def divergences(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top: int = TOP, text_col: str = "text", lang_col: str = "lang",
                source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: every pair of sources of a language, and the first terms of each source."""
    empty = F.lit("")
    groups = docs.select(F.coalesce(F.col(lang_col).cast("string"), empty).alias("lang"), F.coalesce(F.col(source_col).cast("string"), empty).alias("source")).distinct()
    kept = materialize(stripes(docs, text_col, lang_col, source_col).where(F.col("df") >= least_documents), "stripes")
    entries = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x"))
    totals = entries.groupBy("lang", F.col("x.sources").alias("source")).agg(F.sum("x.counts").alias("total"), F.count("*").alias("cells"))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("n_terms"))
    langs = join_null_safe(groups, totals, ["lang", "source"], "left").groupBy("lang").agg(
        F.array_sort(F.collect_list(F.struct("source", F.coalesce("total", F.lit(0)).alias("total")))).alias("groups"), F.sum("cells").alias("cells"))
    langs = materialize(join_null_safe(langs, sizes, ["lang"], "left").select(
        "lang", F.coalesce("n_terms", F.lit(0)).alias("n_terms"), F.col("groups.source").alias("names"), F.col("groups.total").alias("totals"),
        F.ceil(F.coalesce("cells", F.lit(1)) / BUCKET_CELLS).cast("int").alias("n_buckets")), "langs")
    # a row per language: below the limit of broadcasts it is one, above it adaptive execution splits a frequent language
    dealt = kept.join(langs.select("lang", "n_buckets"), "lang").select(
        "lang", F.pmod(F.xxhash64("term"), F.col("n_buckets")).cast("int").alias("bucket"), "term", "sources", "counts")
    for_each = langs.select("lang", F.explode(F.sequence(F.lit(0), F.col("n_buckets") - 1)).alias("bucket"), "n_terms", "names", "totals")
    parts = dealt.groupBy("lang", "bucket").cogroup(for_each.groupBy("lang", "bucket")).applyInArrow(_emit(least_documents, top), _PART)
    parts = materialize(parts, "parts")
    pairs = parts.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [x.withColumn("rank", F.row_number().over(order)) for x in (pairs, parts.where("part = 'term'"))]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= top)).select("lang", "source", "part", "item", "value", "rank")
