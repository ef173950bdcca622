"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts become lower-case letters; everything else is a word boundary. Each 1- to 3-gram that holds a letter is hashed to
a bucket, one table for all orders. Counts per bucket and language give a log-probability matrix, whose size is fixed by
the number of buckets and languages; it is broadcast, and whole texts are scored in numpy, slice by slice.

The fit reads at most about FIT_ROWS labelled texts of each language, chosen by a hash of the text's id; scoring reads
every text. Nulls: rows with a null language teach nothing; a text that is null or has no letter is ``und`` with score
0, and so is every text when nothing could be learned. Repeated rows are scored alike. Columns beside those asked for
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadtime.llm.common import crc_mod3, mix64, slices
from leadtime.plans.lineage import join_sized

#: Buckets of the n-gram table, orders, added count of unseen n-grams, texts per language in the fit.
BUCKETS, ORDERS, ADDED, FIT_ROWS = 1 << 15, (1, 2, 3), 0.5, 5_000
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, 0 if it isn't one."""
    codes = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        if (c := chr(i)).isalpha():
            codes[i] = ord(low) if len(low := c.lower()) == 1 else i
    return codes


def ngrams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: buckets of the n-grams of all rows, and the row of each."""
    chars = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    bounds = heads[offsets]
    codes = _letters()[chars].astype(np.uint64)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    letter = codes > 0
    for n in ORDERS:
        size = len(codes) - n + 1
        if size <= 0:
            continue
        if n == 1:
            key, good = codes.copy(), letter.copy()
        else:
            key, good = np.zeros(size, np.uint64), np.zeros(size, bool)
            for j in range(n):
                key = (key << np.uint64(21)) | codes[j:size + j]
                good |= letter[j:size + j]
            good &= rows[:size] == rows[n - 1:]
        yield (mix64(key[good] + np.uint64(n << 62 & (2**64 - 1))) & np.uint64(BUCKETS - 1)).astype(np.int64), rows[:size][good]


def _count(batches):
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for part, data, offsets in slices(batch, "text"):
            langs = np.asarray(part.column("lang").to_pylist(), dtype=object)
            names, which = np.unique(langs.astype(str), return_inverse=True)
            for buckets, rows in ngrams(data, offsets):
                counts = np.bincount(which[rows] * BUCKETS + buckets, minlength=len(names) * BUCKETS).reshape(len(names), BUCKETS)
                for name, row in zip(names, counts):
                    totals[name] = totals.get(name, 0) + row
    for name, row in totals.items():
        at = np.flatnonzero(row)
        yield pa.RecordBatch.from_arrays([pa.array([str(name)] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(row[at])], names=["lang", "bucket", "n"])


class Model:
    """Languages, log priors and the matrix of log probabilities (bucket, language)."""

    def __init__(self, langs: list[str], counts: np.ndarray) -> None:
        self.langs = langs
        with np.errstate(divide="ignore"):
            seen = counts + ADDED
            self.logs = np.log(seen / seen.sum(axis=0)).astype(np.float32)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the likeliest language of each row (-1 without letters) and its posterior probability."""
        n, k = len(offsets) - 1, len(self.langs)
        total, seen = np.zeros((n, k)), np.zeros(n, np.int64)
        if k:
            for buckets, rows in ngrams(data, offsets):
                if not len(rows):
                    continue
                starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
                who = rows[starts]
                seen[who] += np.diff(np.r_[starts, len(rows)])
                for j in range(k):
                    total[who, j] += np.add.reduceat(self.logs[buckets, j], starts, dtype=np.float64)
        best = np.where(seen > 0, total.argmax(axis=1) if k else -1, -1)
        top = total.max(axis=1, keepdims=True) if k else np.zeros((n, 1))
        posterior = 1.0 / np.exp(total - top).sum(axis=1) if k else np.zeros(n)
        return best, np.where(best >= 0, posterior, 0.0)


def fit(docs: DataFrame, buckets: int = BUCKETS, fit_rows: int = FIT_ROWS) -> Model:
    """docs: doc_id, text, lang of the labelled texts. The driver gets at most ``buckets`` rows for each language."""
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    shares = labelled.groupBy("lang").agg((F.lit(float(fit_rows)) / F.count("*")).alias("share"))
    place = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = join_sized(labelled, shares, "lang").where(place < F.col("share")).select("lang", "text")
    counts = chosen.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(counts.column("lang").to_pylist()))
    matrix = np.zeros((buckets, len(langs)))
    number = {lang: i for i, lang in enumerate(langs)}
    matrix[counts.column("bucket").to_numpy(), [number[x] for x in counts.column("lang").to_pylist()]] = counts.column("n").to_numpy()
    return Model(langs, matrix)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score for every row of ``docs`` (doc_id, text)."""
    held = docs.sparkSession.sparkContext.broadcast((model.langs, model.logs))

    def work(batches):
        own = Model.__new__(Model)
        own.langs, own.logs = held.value
        names = np.array([*own.langs, UNKNOWN], dtype=object)
        for batch in batches:
            for part, data, offsets in slices(batch, "text"):
                best, posterior = own.score(data, offsets)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names[best], pa.string()), pa.array(posterior)],
                                                 names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        work, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the rows whose crc32 of the id is not 1 modulo 3, then predict every row."""
    model = fit(docs.where(crc_mod3("doc_id") != 1))
    found = predict(docs, model)
    return found.select("doc_id", (crc_mod3("doc_id") == 1).alias("held_out"), "lang_pred", "score")
