"""Substring dedup of word passages by recompression.

Every text becomes a sequence of symbols, at first its words. A round renames maximal runs of equal symbols, then pairs:
a hash of a symbol's name says whether it is a left or a right symbol, and each left symbol followed by a right one
becomes one symbol. Names are fingerprints of what they stand for, so all tasks give the same symbol the same name
without exchanging dictionaries. Whether a symbol arises depends on few symbols around it; this context is tracked, and
a symbol whose context lies inside a window arises in every equal window. That is the interior in which equal
substrings are parsed alike.

A window's anchor is the symbol of the highest round whose context the window holds (of several the one with the least
mixed name), named by the words of its context. Names that occur twice or more are found by one grouping; ``repeats``
verifies the passages around them and removes each word that a repeated window covers.

Words are runs outside [\\x20\\x09-\\x0D], unchanged. Nulls: a null text has no words; rows with a null id are reported
unchanged and match nothing. Give ids that are unique. Empty texts and tables give empty results. Other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadtime.llm.common import IS_SPACE, Fingerprints, mix64, word_spans
from leadtime.llm.repeats import covered, names_of, remove, repeated_windows, span_counts, texts_of
from leadtime.plans.lineage import materialize

#: Words of a window, rounds of renaming.
WIDTH, ROUNDS = 35, 3
_PLACE = np.uint64((1 << 24) - 1)


class Symbols:
    """A parse of all texts of a slice: names, and the words [low, high) that each symbol depends on.

    A symbol that depends on a text's end has a bound outside the text.
    """

    def __init__(self, words: np.ndarray, row: np.ndarray, bounds: np.ndarray) -> None:
        self.name, self.row = words, row
        self.low, self.high = np.arange(len(words)), np.arange(len(words)) + 1
        self.before, self.behind = bounds[:-1] - 1, bounds[1:] + 1

    def _neighbours(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Is the next symbol of the same text; lowest word of the previous symbol, highest of the next one."""
        together = self.row[1:] == self.row[:-1]
        left, right = self.before[self.row], self.behind[self.row]
        left[1:] = np.where(together, self.low[:-1], left[1:])
        right[:-1] = np.where(together, self.high[1:], right[:-1])
        return together, left, right

    def runs(self) -> None:
        if not len(self.name):
            return
        together, left, right = self._neighbours()
        head = np.flatnonzero(np.r_[True, ~together | (self.name[1:] != self.name[:-1])])
        count = np.diff(np.r_[head, len(self.name)])
        last = head + count - 1
        self.low, self.high = left[head], right[last]
        name = self.name[head]
        self.name = np.where(count > 1, mix64(name + mix64(count.astype(np.uint64))), name)
        self.row = self.row[head]

    def pairs(self, turn: int) -> None:
        if len(self.name) < 2:
            return
        together, left, right = self._neighbours()
        is_left = (mix64(self.name + np.uint64(turn)) & np.uint64(1)) == 1
        joins = np.r_[together & is_left[:-1] & ~is_left[1:], False]
        joined = np.r_[False, joins[:-1]]
        alone = ~joins & ~joined
        low, high = self.low.copy(), self.high.copy()
        low[alone & ~is_left] = left[alone & ~is_left]  # a right symbol alone: no left one stands before it
        high[alone & is_left] = right[alone & is_left]
        at = np.flatnonzero(joins)
        high[at] = self.high[at + 1]
        name = self.name.copy()
        name[at] = mix64(mix64(self.name[at]) ^ self.name[at + 1])
        stay = ~joined
        self.name, self.row, self.low, self.high = name[stay], self.row[stay], low[stay], high[stay]


def _least_in(key: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of key[low:high] for ranges that aren't empty."""
    out = np.empty(len(low), key.dtype)
    size = high - low
    level, span = key, 1
    while True:
        now = (size >= span) & (size < 2 * span)
        out[now] = np.minimum(level[low[now]], level[high[now] - span])
        if not (size >= 2 * span).any():
            return out
        longer = level.copy()
        longer[:-span] = np.minimum(level[:-span], level[span:])
        level, span = longer, 2 * span


class WordCutter:
    """Anchors by recompression and windows over the words of texts."""

    def __init__(self, width: int = WIDTH, rounds: int = ROUNDS, texts: bool = False) -> None:
        self.width, self.rounds, self.texts = width, rounds, texts
        self.block = max(1, width // 6)

    def _words(self, data, offsets):
        starts, ends, row = word_spans(~IS_SPACE[data], offsets)
        return starts, ends, row, np.searchsorted(row, np.arange(len(offsets)))

    def runs(self, data: np.ndarray, offsets: np.ndarray):
        starts, ends, row, bounds = self._words(data, offsets)
        width = self.width
        spare = np.maximum(np.diff(bounds) - width + 1, 0)
        if not spare.any():
            return
        words = Fingerprints(data).of(starts, ends)
        prints = Fingerprints(words, seed=2)
        owner = np.repeat(np.arange(len(spare)), spare)
        window = np.arange(len(owner)) - (np.cumsum(spare) - spare)[owner] + bounds[:-1][owner]
        low, high, anchor = np.zeros(len(window), np.int64), np.zeros(len(window), np.int64), np.full(len(window), -1)
        symbols = Symbols(words, row, bounds)
        for turn in range(self.rounds + 1):  # a later round overrules where it has a symbol inside the window
            if turn:
                symbols.runs()
                symbols.pairs(turn)
            first, behind = np.searchsorted(symbols.low, window), np.searchsorted(symbols.high, window + width, "right")
            some = np.flatnonzero(first < behind)
            key = (mix64(symbols.name ^ np.uint64(77)) & ~_PLACE) | (np.arange(len(symbols.name), dtype=np.uint64) & _PLACE)
            best = (_least_in(key, first[some], behind[some]) & _PLACE).astype(np.int64)
            low[some], high[some], anchor[some] = symbols.low[best], symbols.high[best], best * (self.rounds + 1) + turn
        head = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])])
        count = np.diff(np.r_[head, len(window)])
        begin = window[head]
        yield owner[head], begin - bounds[:-1][owner[head]], count, low[head] - begin, prints.of(low[head], high[head]), prints.of(begin, begin + count + width - 1)

    def prints(self, data, offsets, rows, places, length: int) -> np.ndarray:
        starts, ends, _, bounds = self._words(data, offsets)
        first = bounds[:-1][rows] + places
        return Fingerprints(Fingerprints(data).of(starts, ends), seed=2).of(first, first + length)

    def cut(self, data, offsets, rows, start, n):
        starts, ends, _, bounds = self._words(data, offsets)
        gone = covered(bounds, rows, start, n, self.width)
        removed, spans = span_counts(gone, bounds)
        # the kept words, each but a text's first one with one space before it
        stay = np.flatnonzero(~gone)
        raw = data.tobytes()
        cuts = np.searchsorted(stay, bounds)
        kept = [b" ".join([raw[a:b] for a, b in zip(starts[stay[x:y]], ends[stay[x:y]])]) for x, y in zip(cuts[:-1], cuts[1:])]
        return np.diff(bounds), removed, spans, kept


def find_repeats(texts: DataFrame, cutter: WordCutter) -> DataFrame:
    texts = texts.where("id IS NOT NULL")
    names = names_of(texts, cutter).groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name")
    return repeated_windows(texts, cutter, materialize(names, "met"))


def substring_dedup(docs: DataFrame, width: int = WIDTH, texts: bool = True) -> DataFrame:
    """id, n_items (words), n_removed, n_spans, kept_sha256, kept (the kept words joined by a space)."""
    cutter = WordCutter(width, ROUNDS, texts)
    rows = texts_of(docs)
    return remove(rows, cutter, find_repeats(rows, cutter))
