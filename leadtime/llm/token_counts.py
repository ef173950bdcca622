"""Token counts of whole texts; huge ones are encoded in overlapping chunks that are spliced again.

A text of at most CHUNK code points is one chunk and is counted at once. A longer one is cut at every CHUNK-th code
point; neighbouring chunks overlap by ``width`` code points on both sides of the cut and are encoded apart, each with the
offsets of its tokens, in tasks of their own. Two neighbours are spliced at a position in their overlap where

* both have an edge between tokens, and
* the tokenizer is proven to be indifferent to what lies on the other side: an ASCII character that is no white space
  stands before it and a space (for a ``.json`` file also a tab or line end) after it, and no normaliser, pre-tokeniser, added token or vocabulary
  entry of the file reaches across such a place (``Codec.proven`` looks at the file for that).

Where two neighbours have no such position in common, the text between the nearest spliced positions is cut again, with
an overlap four times as wide and chunks of at least four overlaps, until everything is spliced; in the end a stretch
without any such position is one chunk. A file for which nothing is proven has every text encoded whole.

Tokens are those of the library by default: ``tokenizers`` for a ``.json`` file, ``sentencepiece`` for a ``.model``
file, without begin, end or other added special tokens; text that looks like a special token counts as the library
counts it; nothing is truncated or padded.

Nulls: a null text is empty and has no tokens; a null id stays null. Rows are counted one by one, so repeated rows and ids
give a row each. Empty tables give an empty result. Columns beside id and text are ignored. A task holds one text whole
while it cuts it; a window holds the seams of one text.
"""

from __future__ import annotations

import json
import os
from functools import cached_property, lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadtime.llm.common import slices
from leadtime.llm.token_ids import ENCODE_BYTES, PIECED, PieceEncoder, _tokenizer
from leadtime.plans.lineage import materialize

#: Code points of a chunk, and of the first overlap on each side of a cut.
CHUNK, WIDTH = 1 << 15, 256
#: Times an overlap is wider in the next round, and overlaps in the shortest chunk.
WIDER, LEAST = 4, 4
#: Chunks that are encoded in one call.
TOGETHER = 32
#: Normaliser and pre-tokeniser of the files that split words without looking across white space.
SPLITTING = (PIECED, (None, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}))

_EDGES = "array<struct<at: long, before: long>>"
_CHUNKS = "key string, first long, k int, start long, stop long, n_chunks int, text string, low long, high long, width long"
_FOUND = f"key string, first long, k int, start long, stop long, n_chunks int, n long, head {_EDGES}, tail {_EDGES}"


@lru_cache(maxsize=2)
def _processor(file: str):
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=file if os.path.isabs(file) else public_tokenizers.path(file))


class Codec:
    """The library that reads a tokenizer file."""

    def __init__(self, file: str) -> None:
        self.pieces = not file.endswith(".json")
        self.library = _processor(file) if self.pieces else _tokenizer(file)
        self.file = file

    @cached_property
    def words(self) -> PieceEncoder | None:
        """Encodes each distinct word once, where the file allows that."""
        made = None if self.pieces else PieceEncoder(self.file)
        return made if made is not None and made.pieced else None

    @property
    def blanks(self) -> tuple[int, ...]:
        """White space that stands behind a boundary: the vocabulary of a ``.model`` file tells of the space alone."""
        return (32,) if self.pieces else (32, 9, 10)

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Number of tokens of each row of text."""
        if self.words is not None:
            return self.words.encode(data, offsets)[1] - 1  # without the end id
        raw = data.tobytes()
        texts = [raw[a:b].decode() for a, b in zip(offsets, offsets[1:])]
        if self.pieces:
            found = self.library.encode(texts, num_threads=1)
        else:
            found = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(map(len, found), np.int64, len(found))

    def spans(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """First and last code point (exclusive) of every token of each text."""
        if self.pieces:
            return [self._piece_spans(t) for t in texts]
        pairs = [e.offsets for e in self.library.encode_batch(texts, add_special_tokens=False)]
        return [tuple(np.array(p, np.int64).reshape(-1, 2).T) for p in pairs]

    def _piece_spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The library gives places in the bytes of the text."""
        data = np.frombuffer(text.encode(), np.uint8)
        point = np.append(np.cumsum((data & 0xC0) != 0x80) - 1, len(text))
        pieces = self.library.encode(text, return_type="proto").pieces
        return point[[p.begin for p in pieces]], point[[p.end for p in pieces]]

    def proven(self) -> bool:
        """Does nothing in the file reach from an ASCII character over a following white space?"""
        if self.pieces:
            names = (self.library.id_to_piece(i) for i in range(self.library.get_piece_size()))
            return not any(name[i] == "▁" and name[i - 1] != "▁" for name in names for i in range(1, len(name)))
        parts = (self.library.normalizer, self.library.pre_tokenizer)
        known = tuple(None if part is None else json.loads(part.__getstate__()) for part in parts)
        added = self.library.get_added_tokens_decoder().values()
        return known in SPLITTING and not any(x.lstrip or x.rstrip or x.single_word or any(c.isspace() for c in x.content) for x in added)


@lru_cache(maxsize=2)
def _is_proven(file: str) -> bool:
    return Codec(file).proven()


def boundaries(text: str, starts: np.ndarray, ends: np.ndarray, low: int, high: int, blanks: tuple[int, ...] = (32, 9, 10)) -> tuple[np.ndarray, np.ndarray]:
    """Positions from ``low`` to ``high`` at which the text may be spliced, and the number of tokens before each."""
    low, high = max(low, 1), min(high, len(text) - 1)
    if low > high:
        none = np.zeros(0, np.int64)
        return none, none
    codes = np.frombuffer(text[low - 1:high + 1].encode("utf-32-le", "surrogatepass"), np.uint32)
    left, right = codes[:-1], codes[1:]
    at = np.flatnonzero((left > 32) & (left < 127) & np.isin(right, blanks)) + low
    before = np.searchsorted(starts, at, "left")
    edge = (before == 0) | (np.r_[0, ends][before] <= at) if len(ends) else np.ones(len(at), bool)
    return at[edge], before[edge]


def _cut(step: int, width: int):
    """Chunks of the segments of every text."""
    def work(batches):
        for batch in batches:
            for key, text, segments in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "segments"))):
                rows = []
                for x in segments:
                    first, end = x["start"], x["stop"]
                    n = max(1, -(-(end - first - 2 * width) // step))
                    for k in range(n):
                        low, high = first + k * step, first + (k + 1) * step if k < n - 1 else end
                        a, b = max(0, low - width), high + width if k < n - 1 else high
                        rows.append((key, first, k, a, end, n, text[a:b], low, high, width))
                        if sum(len(r[6]) for r in rows) >= 1 << 22:
                            yield _batch(rows, _CHUNKS)
                            rows = []
                if rows:
                    yield _batch(rows, _CHUNKS)
    return work


_ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), _EDGES: pa.list_(pa.struct([("at", pa.int64()), ("before", pa.int64())]))}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(x.split(" ", 1) for x in schema.replace(_EDGES, "edges").split(", ")))
    kinds = [_ARROW[_EDGES if k == "edges" else k] for k in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=list(names))


def _encode(file: str):
    """The tokens of every chunk, and where it can be spliced near its cuts."""
    def edges(text, starts, ends, base, cut, width, blanks):
        at, before = boundaries(text, starts, ends, cut - width - base, cut + width - base, blanks)
        return [{"at": a + base, "before": b} for a, b in zip(at.tolist(), before.tolist())]

    def work(batches):
        codec = Codec(file)
        for batch in batches:
            for i in range(0, batch.num_rows, TOGETHER):
                rows, out = batch.slice(i, TOGETHER).to_pylist(), []
                for r, (starts, ends) in zip(rows, codec.spans([r["text"] for r in rows])):
                    out.append((r["key"], r["first"], r["k"], r["start"], r["stop"], r["n_chunks"], len(starts),
                                edges(r["text"], starts, ends, r["start"], r["low"], r["width"], codec.blanks) if r["low"] > 0 else [],
                                edges(r["text"], starts, ends, r["start"], r["high"], r["width"], codec.blanks) if r["k"] < r["n_chunks"] - 1 else []))
                yield _batch(out, _FOUND)
    return work


def _count(file: str):
    def work(batches):
        codec = Codec(file)  # for this task alone: workers that wait keep no memory
        for batch in batches:
            for rows, data, offsets in slices(batch, "text", ENCODE_BYTES):
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("n_bytes"), pa.array(codec.counts(data, offsets))],
                                                 names=["doc_id", "n_bytes", "n_tokens"])
    return work


def _common(left: Column, right: Column) -> Column:
    """A position that both sides offer, from the middle of those; null if there is none."""
    both = F.array_sort(F.array_intersect(F.transform(left, lambda x: x["at"]), F.transform(right, lambda x: x["at"])))
    return F.when(F.size(both) > 0, F.element_at(both, (F.size(both) / 2).cast("int") + 1))


def _before(edges: Column, at: Column) -> Column:
    return F.try_element_at(F.filter(edges, lambda x: x["at"] == at), F.lit(1))["before"]


def splice(found: DataFrame) -> DataFrame:
    """Runs of chunks between spliced positions: key, start, stop, n_chunks and their tokens.

    A run of one chunk is settled; in a run of more the cuts could not be spliced.
    """
    order = Window.partitionBy("key", "first").orderBy("k")
    settled = F.when((F.col("k") == 0) & (F.col("first") > 0), F.col("first"))  # where an earlier round has spliced
    rows = found.withColumns({"from": F.coalesce(settled, _common(F.lag("tail").over(order), F.col("head"))), "to": _common(F.col("tail"), F.lead("head").over(order))})
    rows = rows.withColumn("own", F.coalesce(_before(F.col("tail"), F.col("to")), F.col("n")) - F.coalesce(_before(F.col("head"), F.col("from")), F.lit(0)))
    rows = rows.withColumn("run", F.count_if(F.col("from").isNotNull()).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("key", "first", "run").agg(
        F.coalesce(F.max("from"), F.first("first")).alias("start"), F.coalesce(F.max("to"), F.max("stop")).alias("stop"),
        F.count("*").alias("n_chunks"), F.sum("own").alias("n_tokens")).drop("first", "run")


def _huge(texts: DataFrame, file: str, chunk: int, width: int) -> DataFrame:
    """key, n_tokens for every text of the written table ``texts`` (key, text, n_chars)."""
    spark = texts.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_chars").cast("long").alias("stop")))
    open_, step, settled = texts.select("key", "text", whole.alias("segments")), chunk, []
    while True:
        chunks = open_.mapInArrow(_cut(max(step, LEAST * width), width), _CHUNKS).repartition(parts, "key", "start")
        runs = materialize(splice(materialize(chunks.mapInArrow(_encode(file), _FOUND), "chunks")), "runs")
        settled.append(runs.where("n_chunks = 1").select("key", "n_tokens"))
        rest = runs.where("n_chunks > 1")
        if rest.isEmpty():
            break
        segments = materialize(rest.groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("segments")), "open")
        open_, width = texts.select("key", "text").join(segments, "key"), width * WIDER
    return reduce(DataFrame.unionByName, settled).groupBy("key").agg(F.sum("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", limit: int = 2048, id_col: str = "doc_id", text_col: str = "text",
                 chunk: int = CHUNK, width: int = WIDTH) -> DataFrame:
    """doc_id, n_bytes, n_tokens and ``over_limit`` (more than ``limit`` tokens) of every row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"), F.length(text).alias("n_chars"))
    kind = dict(rows.dtypes)["doc_id"]
    near = rows if not _is_proven(tokenizer) else rows.where(F.col("n_chars") <= chunk)
    out = near.drop("n_chars").mapInArrow(_count(tokenizer), f"doc_id {kind}, n_bytes long, n_tokens long")
    if _is_proven(tokenizer):
        huge = materialize(rows.where(F.col("n_chars") > chunk).withColumn("key", F.expr("uuid()")), "huge")
        counted = huge.select("key", "doc_id", "n_bytes").join(materialize(_huge(huge, tokenizer, chunk, width), "counted"), "key")
        out = out.unionByName(counted.select("doc_id", "n_bytes", "n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
