"""Token ids of every document, written in a grammar-compressed binary format and read back.

Texts are encoded by a public tokenizer file. A text is first cut into pieces that the tokenizer can't join: at ASCII
white space, between a letter and a following punctuation mark, and between a punctuation mark other than an apostrophe
and a following ASCII letter. Each distinct piece is encoded once for a worker (the encodings are those of the
tokenizers library); a text that holds a special token's text is encoded whole, and so is every text if the file doesn't
normalise and split as PIECED says.

Shard file (little-endian): magic ``RPID1\\0\\0\\0``; u32 documents, u32 rules, u32 first nonterminal, u64 symbols; then
i64 doc ids, u64 first symbol of each document and the end, u64 first id of each document and the end, u32 pairs of the
rules, u32 expansion length of each rule, u32 symbols. The symbols are a Re-Pair grammar of the ids: rounds replace
frequent pairs by nonterminals, never across a document's end, until none is left that saves its rule. A document is read by its symbol range; with the
expansion lengths any range of ids inside it is found without expanding what precedes it.

Documents lie in ascending id order over the files, in range partitions. A task writes a file under a name of its own
and only names in the committed manifest are read.

Nulls: a null text counts as empty and has the end id alone; a null id sorts first. Rows with equal ids are ordered by
text, so their order is the same in every run. Empty tables give no file and an empty result. Very long texts are
encoded alone, in pieces. Columns beside id and text are ignored.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadtime.llm.common import IS_SPACE, byte_table, slices
from leadtime.plans.lineage import fresh_path, materialize

MAGIC = b"RPID1\0\0\0"
END_ID = 1
#: Ids in a shard, least count of a pair that becomes a rule: a rule costs 12 bytes and saves 4 at each place.
SHARD_IDS, LEAST = 1 << 20, 4
#: Distinct pieces that a worker remembers (some 200 bytes each), and plain words that it encodes in one call.
REMEMBERED, JOINED = 800_000, 500
#: Bytes of text that are encoded together, and at once for the shards: a piece is looked up once for each such step.
ENCODE_BYTES, STEP_BYTES = 1 << 21, 1 << 23
MANIFEST = "shard string, doc_id long, place long, n_tokens long"


# --- text to ids -----------------------------------------------------------------------------------------------------

_LOWER = bytes(range(256)).lower()
_SPACE, _LETTER, _MARK = 1, 2, 4
#: Kind of each lower-cased byte: white space, a-z, a punctuation mark other than an apostrophe.
_KIND = (IS_SPACE * _SPACE + byte_table(bytes(range(97, 123))) * _LETTER + byte_table(bytes(
    x for x in range(33, 127) if not chr(x).isalnum() and chr(x) != "'")) * _MARK).astype(np.uint8).tobytes()
#: Normaliser and pre-tokeniser of the files for which the pieces hold: lower-casing, white space dropped, words apart.
PIECED = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
)
#: Lower-case words of a-z and U+00E0..U+00FF, which are one token run for tokenizers with word ends.
_PLAIN = re.compile(rb"(?:[a-z]|\xC3[\xA0-\xB6\xB8-\xBF])+").fullmatch
#: Characters that stand for the bytes of such words behind a ByteLevel pre-tokeniser: Latin-1 but for two bytes.
_STANDS_FOR = (("\xA0", "\u0142"), ("\xAD", "\u0143"))


@lru_cache(maxsize=2)
def _tokenizer(file: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(file if os.path.isabs(file) else public_tokenizers.path(file))


def _values(words: pa.BinaryArray) -> list[bytes]:
    """The words cut out of their buffer, which takes a third of the time of ``to_pylist``."""
    ends, data = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].tolist(), words.buffers()[2].to_pybytes()
    return [data[a:b] for a, b in zip(ends, ends[1:])]


class PieceEncoder:
    """Encodes texts through a memory of pieces."""

    def __init__(self, file: str) -> None:
        self.tokenizer = _tokenizer(file)
        self.word_ends = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), bool)
        self.word_ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        parts = (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer)
        self.pieced = all(part is not None and json.loads(part.__getstate__()) == known for part, known in zip(parts, PIECED))
        # before the model a plain word's bytes get their characters and nothing else, unless the file has such a word as a token of its own
        self.direct = self.pieced and not any(x.strip().isalnum() for x in self.special)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids: list[np.ndarray] = []
        self.flat, self.starts, self.size = np.zeros(1 << 16, np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32), np.zeros(1 << 14, np.int64), 0

    def _encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these pieces end to end, and the number of each."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int64, int(lengths.sum())), lengths

    def _encode_ascii(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for plain words: their bytes go to the library's model as the characters that its pre-tokeniser makes of them."""
        model = self.tokenizer.model
        texts = b" ".join(words).decode("latin-1")
        for byte, char in _STANDS_FOR:
            texts = texts.replace(byte, char)
        found = [[token.id for token in model.tokenize(t)] for t in texts.split(" ")] if words else []
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int64, int(lengths.sum())), lengths

    def _encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for plain words, many in a call; the ids that end a word tell them apart."""
        texts = [b" ".join(words[i:i + JOINED]).decode() for i in range(0, len(words), JOINED)]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(found), np.int64, sum(map(len, found)))
        ends = np.flatnonzero(self.word_ends[ids]) + 1
        if len(ends) != len(words):
            return self._encode_pieces(words)
        return ids, np.diff(np.r_[0, ends])

    def _learn(self, pieces: list[bytes]) -> None:
        plain, other = [], []
        for p in pieces:  # all in lower case
            (plain if p.isalpha() or _PLAIN(p) else other).append(p)
        pieces = plain + other
        parts = [self._encode_ascii(plain) if self.direct else self._encode_words(plain), self._encode_pieces(other)]
        ids, lengths = (np.concatenate([x[i] for x in parts]) for i in range(2))
        total, n = len(ids), len(self.known)
        while self.size + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(pieces) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.flat[self.size:self.size + total] = ids
        self.starts[n + 1:n + 1 + len(pieces)] = self.size + np.cumsum(lengths)
        self.size += total
        self.known.update(zip(pieces, range(n, n + len(pieces))))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, end id included, and the number of ids of each row."""
        n = len(offsets) - 1
        raw = data.tobytes()
        if not self.pieced:
            whole = list(range(n))
        else:
            whole = [i for i in range(n) if any(s.encode() in raw[offsets[i]:offsets[i + 1]] for s in self.special)] if any(s.encode() in raw for s in self.special) else []
        owner, which = self._pieces(raw, offsets, whole)
        lengths = self.starts[which + 1] - self.starts[which]
        per_row = np.bincount(owner, lengths, n).astype(np.int64) if len(owner) else np.zeros(n, np.int64)
        spoken = {i: np.asarray(self.tokenizer.encode(raw[offsets[i]:offsets[i + 1]].decode(), add_special_tokens=False).ids, np.uint32) for i in whole}
        for i, ids in spoken.items():
            per_row[i] = len(ids)
        counts = per_row + 1
        ends = np.cumsum(counts)
        out = np.empty(int(ends[-1]) if n else 0, np.uint32)
        out[ends - 1] = END_ID
        if len(which):
            before = np.cumsum(lengths) - lengths  # place among the ids of pieces
            source = np.repeat(self.starts[which] - before, lengths)
            source += np.arange(len(source))
            pieced = np.ones(len(out), bool)
            pieced[ends - 1] = False
            for i in whole:
                pieced[ends[i] - counts[i]:ends[i]] = False
            out[pieced] = self.flat[source]
        for i, ids in spoken.items():
            out[ends[i] - counts[i]:ends[i] - 1] = ids
        return out, counts

    def _pieces(self, raw, offsets, whole) -> tuple[np.ndarray, np.ndarray]:
        lower = bytearray(raw).translate(_LOWER)
        kind = np.frombuffer(lower.translate(_KIND), np.uint8)
        low, letter, mark = np.frombuffer(lower, np.uint8), (kind & _LETTER) != 0, (kind & _MARK) != 0
        keep = (kind & _SPACE) == 0
        for i in whole:
            keep[offsets[i]:offsets[i + 1]] = False
        # two-byte letters U+00C0..U+00FF, without the signs U+00D7 and U+00F7
        ended = letter.copy()
        if len(low) > 1:
            accent = (low[:-1] == 0xC3) & (low[1:] != 0x97) & (low[1:] != 0xB7)
            low[1:][accent & (low[1:] < 0x9F)] += 0x20
            ended[1:] |= accent
        first = np.zeros(len(low) + 1, bool)
        first[offsets[:-1]] = True
        head = keep.copy()
        head[1:] &= ~keep[:-1] | first[1:len(low)] | (ended[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
        starts = np.flatnonzero(head)
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        packed = low[keep]
        cuts = np.append(np.cumsum(keep, dtype=np.int32)[starts] - 1, len(packed)).astype(np.int32)
        words = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(packed)])
        coded = words.dictionary_encode()
        distinct = _values(coded.dictionary)
        found = list(map(self.known.get, distinct))
        new = [w for w, k in zip(distinct, found) if k is None]
        if new:
            if len(self.known) + len(new) > REMEMBERED and self.known:
                self._forget()
                new = distinct
            self._learn(new)
            found = map(self.known.__getitem__, distinct)
        ids = np.fromiter(found, np.int64, len(distinct))
        return np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets))), ids[coded.indices.to_numpy()]


@lru_cache(maxsize=1)
def _encoder(file: str, folder: str) -> PieceEncoder:
    """The encoder of a worker for one folder of shards: what a task has learned serves the worker's later tasks, not another run."""
    return PieceEncoder(file)


# --- Re-Pair ---------------------------------------------------------------------------------------------------------

def _frequent(left: np.ndarray, right: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs with at least LEAST places in ascending order, their counts, and the number of each place's pair (-1: a rare one).

    Symbols lie below ``top``. A pair and its place sort as one number where 64 bits hold them.
    """
    n, wide, low = len(left), top.bit_length(), len(left).bit_length()
    key = left.astype(np.uint64)
    if 2 * wide + low <= 64:
        for bits, part in ((wide, right), (low, np.arange(n, dtype=np.uint64))):  # in place, as fresh memory costs more than the steps
            key <<= np.uint64(bits)
            key |= part
        key.sort()
        place = (key & np.uint64((1 << low) - 1)).view(np.int64)
        key >>= np.uint64(low)
    else:
        key, wide = (key << np.uint64(32)) | right, 32
        place = np.argsort(key, kind="stable")
        key = key[place]
    heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])[:n]
    counts = np.diff(np.r_[heads, n])
    often = counts >= LEAST
    which = np.empty(n, np.int64)
    which[place] = np.repeat(np.where(often, np.cumsum(often) - 1, -1), counts)
    key = key[heads[often]]
    return np.stack([key >> np.uint64(wide), key & np.uint64((1 << wide) - 1)], axis=1).astype(np.uint32), counts[often], which


def repair(ids: np.ndarray, bounds: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, their bounds per document, rules (pairs) and expansion lengths.

    A round counts all pairs exactly. Where pairs overlap the more frequent one is replaced, and of a symbol's run every
    second pair from the left. The most frequent pair always becomes a rule, so rounds end when no pair has LEAST places.
    A pair below LEAST stays below it while its symbols stand, so later rounds look at the other places only.
    """
    symbols, bounds = ids.astype(np.uint32), bounds.astype(np.int64)
    rules, lengths = np.zeros((0, 2), np.uint32), np.zeros(0, np.uint32)
    last = np.zeros(len(symbols), bool)  # of its document
    last[bounds[1:][np.diff(bounds) > 0] - 1] = True
    open_ = ~last
    while True:
        n, at = len(symbols), np.flatnonzero(open_)
        left, right = symbols[at], symbols[at + 1]
        twins = np.flatnonzero(left == right)
        run = np.flatnonzero(np.r_[True, np.diff(at[twins]) != 1])[:len(twins)]
        turn = np.arange(len(twins)) - np.repeat(run, np.diff(np.r_[run, len(twins)]))  # place in a run of one symbol
        second = twins[turn % 2 == 1]
        if len(second):
            at, left, right = (np.delete(x, second) for x in (at, left, right))
        pairs, counts, which = _frequent(left, right, first + len(rules))
        if not len(pairs):
            return symbols, bounds, rules, lengths
        by_count = np.argsort(counts, kind="stable")
        order = np.zeros(len(pairs) + 1, np.int32)  # the last one is that of rare pairs
        order[by_count] = np.arange(1, len(pairs) + 1)
        order = order[which]
        open_[at] = order > 0
        weight = np.zeros(n + 2, np.int32)  # with a place before the first symbol and one behind the last
        weight[at + 1] = order
        at = np.flatnonzero((weight[1:-1] > weight[:-2]) & (weight[1:-1] > weight[2:]))
        which = by_count[weight[at + 1] - 1]
        best = np.flatnonzero(np.bincount(which, minlength=len(pairs)) >= LEAST)
        number = np.full(len(pairs), -1, np.int64)
        number[best] = np.arange(len(best))
        chosen = number[which]
        kept = np.flatnonzero(chosen >= 0)
        at, chosen = at[kept], chosen[kept]
        base = first + len(rules)
        new = pairs[best]
        known = np.concatenate([np.ones(first, np.uint32), lengths])
        lengths = np.concatenate([lengths, known[new[:, 0]] + known[new[:, 1]]])
        rules = np.concatenate([rules, new])
        symbols[at] = (base + chosen).astype(np.uint32)
        last[at] = last[at + 1]
        open_[at] = True
        open_[at[at > 0] - 1] = True
        open_ &= ~last
        stay = np.ones(n, bool)
        stay[at + 1] = False
        stay = np.flatnonzero(stay)
        symbols, last, open_, bounds = symbols[stay], last[stay], open_[stay], bounds - np.searchsorted(at + 1, bounds)


class Expansions:
    """The ids of every symbol end to end, so that any symbols expand by one gather."""

    def __init__(self, rules: np.ndarray, lengths: np.ndarray, first: int) -> None:
        self.sizes = np.concatenate([np.ones(first, np.int64), lengths.astype(np.int64)])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.empty(int(self.sizes.sum()), np.uint32)
        self.flat[:first] = np.arange(first)
        top, done = np.maximum.accumulate(rules.max(axis=1)) if len(rules) else np.zeros(0, np.uint32), 0
        while done < len(rules):  # all rules at once whose parts are known
            end = int(np.searchsorted(top, first + done))
            self.flat[self.starts[first + done]:self.starts[first + end - 1] + self.sizes[first + end - 1]] = self.of(rules[done:end].ravel())
            done = end

    def of(self, symbols: np.ndarray) -> np.ndarray:
        sizes = self.sizes[symbols]
        ends = np.cumsum(sizes)
        shift = self.starts[symbols] - (ends - sizes)
        return self.flat[np.repeat(shift, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]


class Shard:
    """A shard file, read as a whole or by document."""

    def __init__(self, content: bytes) -> None:
        if content[:8] != MAGIC:
            raise ValueError("no shard file")
        n, r, self.first = (int(x) for x in np.frombuffer(content, "<u4", 3, 8))
        m, at = int(np.frombuffer(content, "<u8", 1, 20)[0]), 28

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            part = np.frombuffer(content, kind, count, at)
            at += part.nbytes
            return part

        self.doc_ids, self.bounds, self.id_bounds = take("<i8", n), take("<u8", n + 1).astype(np.int64), take("<u8", n + 1).astype(np.int64)
        self.rules, self.lengths, self.symbols = take("<u4", 2 * r).reshape(-1, 2), take("<u4", r), take("<u4", m)
        self.expansions = Expansions(self.rules, self.lengths, self.first)

    def ids(self, document: int) -> np.ndarray:
        return self.expansions.of(self.symbols[self.bounds[document]:self.bounds[document + 1]])

    def some(self, document: int, start: int, stop: int) -> np.ndarray:
        """Ids start..stop of a document: the expansion lengths lead to the symbols that hold them."""
        symbols = self.symbols[self.bounds[document]:self.bounds[document + 1]]
        sizes = self.expansions.sizes[symbols]
        ends = np.cumsum(sizes)
        stop = min(stop, int(ends[-1]))
        if start >= stop:
            return np.zeros(0, np.uint32)
        a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left")
        before = int(ends[a] - sizes[a])
        return self.expansions.of(symbols[a:b + 1])[start - before:stop - before]


def pack(doc_ids: np.ndarray, ids: np.ndarray, id_bounds: np.ndarray, first: int) -> bytes:
    symbols, bounds, rules, lengths = repair(ids, id_bounds, first)
    parts = [MAGIC, np.array([len(doc_ids), len(rules), first], "<u4"), np.array([len(symbols)], "<u8"), doc_ids.astype("<i8"),
             bounds.astype("<u8"), id_bounds.astype("<u8"), rules.astype("<u4"), lengths.astype("<u4"), symbols.astype("<u4")]
    return b"".join(x if isinstance(x, bytes) else x.tobytes() for x in parts)


# --- Spark jobs ------------------------------------------------------------------------------------------------------

def _shards(counts: np.ndarray, held: int):
    """Ranges of documents, each up to the one that fills a shard which already holds ``held`` ids; is it full then?"""
    ends, at, base = np.cumsum(counts), 0, -held
    while at < len(counts):
        stop = min(int(np.searchsorted(ends, base + SHARD_IDS)) + 1, len(counts))
        yield at, stop, bool(ends[stop - 1] - base >= SHARD_IDS)
        at, base = stop, int(ends[stop - 1])


def _write(file: str, folder: str):
    def work(batches):
        encoder = _encoder(file, folder)
        first = encoder.tokenizer.get_vocab_size(with_added_tokens=True)
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def flush():
            doc_ids, ids, counts = (np.concatenate([x[i] for x in held]) for i in range(3))
            held.clear()
            name = f"{base}/{uuid.uuid4().hex}.rpid"
            bounds = np.concatenate([[0], np.cumsum(counts)])
            with store.open_output_stream(name, compression=None) as out:
                out.write(pack(doc_ids, ids, bounds, first))
            n = len(doc_ids)
            return pa.RecordBatch.from_arrays([pa.array([name] * n), pa.array(doc_ids), pa.array(np.arange(n)), pa.array(counts)],
                                              names=["shard", "doc_id", "place", "n_tokens"])

        for batch in batches:
            for rows, data, offsets in slices(batch, "text", STEP_BYTES):
                ids, counts = encoder.encode(data, offsets)
                doc_ids = rows.column("doc_id").fill_null(-2**63).to_numpy(zero_copy_only=False).astype(np.int64)
                bounds = np.concatenate([[0], np.cumsum(counts)])
                for a, b, full in _shards(counts, sum(len(x[1]) for x in held)):
                    held.append((doc_ids[a:b], ids[bounds[a]:bounds[b]], counts[a:b]))
                    if full:
                        yield flush()
        if held:
            yield flush()
    return work


def _read(folder: str):
    def work(batches):
        store = fs.FileSystem.from_uri(folder)[0]
        for batch in batches:
            for name in batch.column("shard").to_pylist():
                with store.open_input_file(name) as file:
                    shard = Shard(file.read())
                ids = shard.expansions.of(shard.symbols).astype("<u4", copy=False)
                b = shard.id_bounds
                sums = [zlib.crc32(ids[b[i]:b[i + 1]]) for i in range(len(shard.doc_ids))]
                n = len(shard.doc_ids)
                yield pa.RecordBatch.from_arrays([pa.array([name] * n), pa.array(shard.doc_ids, mask=shard.doc_ids == -2**63), pa.array(b[:-1]),
                                                  pa.array(np.diff(b)), pa.array(sums, pa.int64())],
                                                 names=["shard", "doc_id", "before", "n_tokens", "ids_crc32"])
    return work


def write_shards(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and write all documents below ``path``, in ascending id order over the files; returns the manifest
    (a row per shard: first and last id, documents, ids)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    made = materialize(ordered.mapInArrow(_write(tokenizer, f"{path}/shards"), MANIFEST), "manifest")
    return made.groupBy("shard").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.count("*").alias("documents"),
                                     F.sum("n_tokens").alias("n_ids"))


def read_shards(spark: SparkSession, manifest: DataFrame, path: str) -> DataFrame:
    """Per document from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Shards are ordered by their ids; the running sum over them is the one single-task step and has a row per shard.
    """
    manifest = materialize(manifest, "shards")
    before = Window.orderBy("first_id", "last_id", "shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = manifest.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    files = manifest.select("shard").repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "shard")
    rows = files.mapInArrow(_read(f"{path}/shards"), "shard string, doc_id long, before long, n_tokens long, ids_crc32 long")
    return rows.join(bases, "shard").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def token_ids(docs: DataFrame, tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    """Write every document's ids and report them from the files."""
    path = fresh_path(docs.sparkSession, "token-ids")
    return read_shards(docs.sparkSession, write_shards(docs, path, tokenizer), path)
