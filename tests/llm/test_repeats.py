import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from leadtime.llm import substring_dedup, suffix_dedup
from tests.llm.data import frame, hostile, words


def _removed(sequences, width):
    """Flags of the items that a repeated window covers, and the number of stretches."""
    count = Counter(s[i:i + width] for s in sequences for i in range(len(s) - width + 1))
    out = []
    for s in sequences:
        flags = [False] * len(s)
        for i in range(len(s) - width + 1):
            if count[s[i:i + width]] > 1:
                flags[i:i + width] = [True] * width
        out.append((flags, sum(f and not (i and flags[i - 1]) for i, f in enumerate(flags))))
    return out


def _texts(seed):
    """Texts over a few words, with passages that start at any place and periods of any length."""
    rng = random.Random(seed)
    pool = [" ".join(rng.choice(("aa", "b", "ccc", "dd", "é")) for _ in range(rng.randrange(1, 60))) for _ in range(6)]
    return [" ".join(rng.choice(pool) if rng.random() < 0.5 else f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 9))) for _ in range(60)]


@pytest.mark.parametrize("seed,width", [(1, 40), (2, 25), (3, 61)])
def test_bytes_against_brute_force(spark, seed, width):
    texts = _texts(seed) + [r[1] for r in hostile(seed)]
    rows = [(i, t, None, None, 0, *["clash"] * 16) for i, t in enumerate(texts)]
    found = {r.id: r for r in suffix_dedup.suffix_dedup(frame(spark, rows).repartition(3), width, batches=3).collect()}
    raw = [(t or "").encode() for t in texts]
    assert len(found) == len(raw)
    for i, (b, (flags, spans)) in enumerate(zip(raw, _removed(raw, width))):
        kept = bytes(x for x, gone in zip(b, flags) if not gone)
        r = found[i]
        assert (r.n_items, r.n_removed, r.n_spans, bytes(r.kept), r.kept_sha256) == (len(b), sum(flags), spans, kept, hashlib.sha256(kept).hexdigest()), i


@pytest.mark.parametrize("seed,width", [(1, 9), (2, 35), (3, 5)])
def test_words_against_brute_force(spark, seed, width):
    texts = _texts(seed) + [r[1] for r in hostile(seed)]
    rows = [(i, t, None, None, 0, *["clash"] * 16) for i, t in enumerate(texts)]
    found = {r.id: r for r in substring_dedup.substring_dedup(frame(spark, rows).repartition(3), width).collect()}
    parts = [tuple(words(t)) for t in texts]
    assert len(found) == len(parts)
    for i, (w, (flags, spans)) in enumerate(zip(parts, _removed(parts, width))):
        kept = " ".join(x for x, gone in zip(w, flags) if not gone).encode()
        r = found[i]
        assert (r.n_items, r.n_removed, r.n_spans, bytes(r.kept), r.kept_sha256) == (len(w), sum(flags), spans, kept, hashlib.sha256(kept).hexdigest()), i


@pytest.mark.parametrize("run", [lambda d: suffix_dedup.suffix_dedup(d, 30), lambda d: substring_dedup.substring_dedup(d, 5)])
def test_empty_table_and_null_id(spark, run):
    assert run(frame(spark, [])).count() == 0
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(i, text, None, None, 0, *["x"] * 16) for i in (None, 4)]
    assert sorted((r.id or -1, r.n_removed) for r in run(frame(spark, rows)).collect()) == [(-1, 0), (4, 0)]  # null ids match nothing


def test_long_texts_are_cut_in_pieces(monkeypatch):
    rng = np.random.default_rng(4)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    whole = suffix_dedup.ByteCutter(40, 16)
    offsets = np.array([0, len(data)])
    windows = {}
    for row, start, n, _, name, _ in whole.runs(data, offsets):
        for s, k, x in zip(start, n, name):
            windows.update({int(s) + j: x for j in range(k)})
    monkeypatch.setattr(suffix_dedup, "CUT_BYTES", 300)
    pieces = {}
    for row, start, n, _, name, _ in whole.runs(data, offsets):
        for s, k, x in zip(start, n, name):
            pieces.update({int(s) + j: x for j in range(k)})
    assert pieces == windows and len(windows) == len(data) - 39
    starts = np.arange(0, 4900, 7)
    assert (whole.prints(data, offsets, np.zeros(len(starts), np.int64), starts, 40) == suffix_dedup.Fingerprints(data).of(starts, starts + 40)).all()


def test_equal_windows_have_equal_anchors():
    """The property that both operators rest on, for words: names depend on the window alone."""
    rng = random.Random(9)
    passage = [f"p{rng.randrange(30)}" for _ in range(80)]
    texts = [" ".join([f"x{rng.randrange(99)}" for _ in range(rng.randrange(9))] + passage + [f"y{rng.randrange(99)}" for _ in range(rng.randrange(9))]) for _ in range(8)]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    cutter, named = substring_dedup.WordCutter(20), {}
    for row, start, n, _, name, _ in cutter.runs(data, offsets):
        for r, s, k, x in zip(row, start, n, name):
            for j in range(s, s + k):
                named.setdefault(tuple(texts[r].split()[j:j + 20]), set()).add(int(x))
    assert all(len(v) == 1 for v in named.values()) and len(named) > 100
