import random

import numpy as np
import pytest

from leadtime.llm import near_dedup as op
from leadtime.llm.graph import components, local_components
from tests.llm.data import frame, hostile, lower, sentence, words


def _sets(rows, shingle):
    out = {}
    for doc_id, text, *_ in rows:
        w = words(lower(text or ""))
        out.setdefault(doc_id, set()).update(tuple(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1)) if w)
    return out


def _expected(rows, shingle, percent):
    sets = _sets(rows, shingle)
    ids = sorted(sets)
    label = {i: i for i in ids}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                label[b] = a
    return {i: (len(sets[i]), top(i)) for i in ids}


@pytest.mark.parametrize("shingle,percent", [(4, 80), (5, 80)])
def test_hostile_texts_against_brute_force(spark, shingle, percent):
    rows = hostile()
    want = _expected(rows, shingle, percent)
    found = op.near_components(frame(spark, rows), shingle, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found) and len(found) == len(rows)


def _family(seed, n, edits):
    rng = random.Random(seed)
    base = sentence(rng, 150).split()
    rows = []
    for i in range(n):
        copy = list(base)
        for _ in range(rng.randrange(edits)):
            copy[rng.randrange(len(copy))] = f"q{rng.randrange(10**6)}"
        rows.append((1000 - i, " ".join(copy), None, None, 0, *["x"] * 16))
    return rows


@pytest.mark.parametrize("blocks", [None, 8])
def test_large_group_of_near_copies(spark, monkeypatch, blocks):
    """With blocks of 8 members keys and components are split, and nothing changes."""
    if blocks:
        monkeypatch.setattr(op, "KEY_BLOCK", blocks)
        monkeypatch.setattr(op, "SET_BLOCK", blocks)
    rows = _family(4, 90, 14)
    want = _expected(rows, 4, 80)
    assert 1 < len({c for _, c in want.values()}) < 80
    found = op.near_components(frame(spark, rows), 4, 80).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: c for i, (_, c) in want.items()}


def test_empty_null_and_repeated(spark):
    assert op.near_components(frame(spark, [])).count() == 0
    text = sentence(random.Random(1), 30)
    rows = [(i, t, None, None, 0, *["x"] * 16) for i, t in [(None, text), (4, text), (4, text), (9, text), (6, None), (7, " "), (8, None)]]
    found = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in op.near_components(frame(spark, rows), 4).collect()), key=str)
    assert found == [(4, 27, 4, True), (4, 27, 4, True), (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True), (9, 27, 4, False), (None, 27, None, True)]
    assert sorted((r.doc_id or 0) for r in op.drop_near_copies(frame(spark, rows), 4).collect()) == [0, 4, 4, 6, 7, 8]


def test_pairs_in_the_radius_share_a_key():
    """The pigeonhole guarantee, for signatures that differ as badly as the radius allows."""
    rng = np.random.default_rng(3)
    symbols = rng.integers(0, 1 << 16, (200, op.SYMBOLS)).astype(np.uint16)
    other = symbols.copy()
    radius = op.CHUNKS * op.ERRORS + op.CHUNKS - 1
    for row in range(200):
        at = rng.permutation(op.SYMBOLS)[:radius] if row % 2 else np.r_[:radius * 2:2]
        other[row, at] ^= 0x55
    assert (op.index_keys(symbols) == op.index_keys(other)).any(axis=1).all()


def test_links_inside_a_large_group():
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 16, (3, op.SYMBOLS)).astype(np.uint16)
    which = rng.integers(0, 3, 200)
    symbols = centres[which]
    for row in range(200):
        symbols[row, rng.permutation(op.SYMBOLS)[:rng.integers(0, 25)]] ^= 1
    near = (symbols[:, None] != symbols[None]).sum(axis=2) <= op.FAR
    a, b = np.nonzero(near)
    want = local_components(200, a, b)
    for sizes in ([200], [20] * 10):
        starts = np.cumsum([0, *sizes[:-1]])
        got = op.near_links(symbols, starts, np.array(sizes))
        for s, n in zip(starts, sizes):
            inside = (a >= s) & (a < s + n) & (b >= s) & (b < s + n)
            assert (got[s:s + n] == s + local_components(n, a[inside] - s, b[inside] - s)).all()
    assert want.max() > 0


def test_components_of_a_long_path_and_a_hub(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, j) for j in range(200, 260)] + [(5, 5), (None, 3), (300, 301), (301, 300)]
    found = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 100 for i in range(100, 141)} | {7: 7} | {j: 7 for j in range(200, 260)} | {300: 300, 301: 300}


def test_far_loses_less_than_the_keys_do():
    from math import comb
    n = op.SYMBOLS  # unequal symbols of a pair at a similarity of 0.8
    assert sum(comb(n, k) * 0.2**k * 0.8**(n - k) for k in range(op.FAR + 1, n + 1)) < 1e-8
