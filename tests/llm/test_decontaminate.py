import hashlib
import random
import re

import pytest

from leadtime.llm import decontaminate as op
from tests.llm.data import frame, hostile, lower, sentence

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return WORD.findall(lower(text or ""))


def _expected(rows, items, window=13):
    windows = {}
    for item, text in items:
        w = _words(text)
        m = min(window, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            windows.setdefault((m, tuple(w[i:i + m])), set()).add("null" if item is None else str(item))
    out = {}
    for doc_id, text, *_ in rows:
        w, hit, found = _words(text), set(), set()
        for m in {m for m, _ in windows}:
            for i in range(len(w) - m + 1):
                if names := windows.get((m, tuple(w[i:i + m]))):
                    found |= names
                    hit |= set(range(i, i + m))
        out[doc_id] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    return out


def _case():
    rng = random.Random(8)
    items = [(i, sentence(rng, n)) for i, n in enumerate((40, 13, 12, 3, 1, 25))] + [(6, None), (7, ""), (8, "..."), (None, sentence(rng, 20)), (10, "x " * 30)]
    items += [items[0], (0, sentence(rng, 15))]  # a repeated row, and a second text of an item
    texts = [sentence(rng, 10) + " " + " ".join(items[0][1].split()[3:30]) + "! " + sentence(rng, 400), items[1][1].upper(), items[1][1].replace(" ", "-- ."), items[2][1],
             "x " * 40, items[9][1] + " " + items[9][1], " ".join(items[5][1].split()[:12]), sentence(rng, 2000), items[3][1] + " é " + items[4][1]]
    rows = [(100 + i, t, None, None, 0, *["c"] * 16) for i, t in enumerate(texts)] + hostile()
    return rows, items


@pytest.mark.parametrize("block", [4 << 20, 400])
def test_scores_against_brute_force(spark, monkeypatch, block):
    """In one broadcast block, and in several."""
    monkeypatch.setattr(op, "BLOCK_BYTES", block)
    rows, items = _case()
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = op.scores(frame(spark, rows).repartition(2), bench).collect()
    assert {r.doc_id: tuple(r)[1:] for r in found} == _expected(rows, items) and len(found) == len(rows)
    want = _expected(rows, items)
    kept = op.remove_contaminated(frame(spark, rows), bench)
    assert kept.schema.simpleString() == frame(spark, rows).schema.simpleString()
    assert {r.doc_id for r in kept.collect()} == {i for i, x in want.items() if not x[4]}


def test_longest_matches(spark):
    rows, items = _case()
    found = op.matches(frame(spark, rows[:1]), spark.createDataFrame(items[:1], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id, r.doc_word, r.item_word, r.n_words) for r in found] == [(100, "0", 10, 3, 27)]


def test_empty_tables(spark):
    rows, items = _case()
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r.n_hit == 0 and not r.contaminated for r in op.scores(frame(spark, rows), none).collect())
    assert op.scores(frame(spark, []), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_windows_longer_than_the_least_depth():
    import numpy as np
    rng = np.random.default_rng(3)
    window, head = 24, list(range(1, 18))  # the first 17 words are equal everywhere
    rows = [[*head, *rng.integers(20, 60, window - 17)] for _ in range(300)]
    bounds = np.arange(301) * window
    array = op.SuffixArray(np.array(rows, np.uint64).ravel(), bounds, max(op.DEPTH, window))
    asked = np.searchsorted(array.vocabulary, np.array(rows, np.uint64)) + 1
    lo, hi = array.search(asked)
    for i, row in enumerate(rows):
        assert array.doc_at[i] in array.suffixes[lo[i]:hi[i]] and hi[i] - lo[i] == rows.count(row)
