import random
import re
from collections import Counter, defaultdict

import pytest

from leadtime.llm import divergence as op
from tests.llm.data import frame, hostile, lower, sentence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def _expected(rows, top=200):
    groups, df = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        found = Counter(TERM.findall(lower(text or "")))
        groups[lang or "", source or ""].update(found)
        df[lang or ""].update(found.keys())
    out = set()
    for lang in df:
        kept = {t for t, n in df[lang].items() if n >= 3}
        own = {s: {t: c for t, c in words.items() if t in kept} for (x, s), words in groups.items() if x == lang}
        whole = Counter()
        for words in own.values():
            whole.update(words)

        def p(words):
            n = sum(words.values())
            return {t: 1 + 10**9 * (words.get(t, 0) + 1) // (n + len(kept)) for t in kept}

        ps, q = {s: p(words) for s, words in own.items()}, p(whole)
        f = lambda a, b: (a - b) ** 2 // b
        for s in own:
            pairs = sorted((-sum(f(ps[s][t], ps[o][t]) for t in kept), o.encode(), o) for o in own if o != s)
            terms = sorted((-f(ps[s][t], q[t]), t.encode(), t) for t in kept if own[s].get(t, 0) and ps[s][t] > q[t])
            for part, items in (("pair", pairs), ("term", terms[:top])):
                out |= {(lang, s, part, item, -value, i + 1) for i, (value, _, item) in enumerate(items)}
    return out


def _mixed(seed):
    rng = random.Random(seed)
    rows = hostile(seed)
    rows += [(1000 + i, sentence(rng, rng.randrange(80), 60).replace("w", rng.choice(["w", "é", "Zz", "日"])), rng.choice(["en", "", None, "de"]), rng.choice(["s0", "s1", "s9", None]),
              0, *["c"] * 16) for i in range(80)]
    rows += [(5000, "", "xx", "only", 0, *["c"] * 16), (5001, None, "yy", "a", 0, *["c"] * 16), (5002, "one two", "yy", "b", 0, *["c"] * 16)]
    return rows + rows[:10]


@pytest.mark.parametrize("cells", [None, 40])
def test_hostile_documents_against_plain_loops(spark, monkeypatch, cells):
    rows = _mixed(4)
    if cells:  # stripes are spilled, buckets and blocks are small
        for name in ("STRIPE_CELLS", "BUCKET_CELLS", "BLOCK_CELLS"):
            monkeypatch.setattr(op, name, cells)
    got = op.divergences(frame(spark, rows).repartition(3))
    found = [tuple(r) for r in got.collect()]
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"] and len(found) == len(set(found))
    assert set(found) == _expected(rows)


def test_ranks_stop_at_the_top(spark):
    rows = _mixed(5)
    assert {tuple(r) for r in op.divergences(frame(spark, rows), top=3).collect()} == _expected(rows, 3)


def test_no_documents(spark):
    assert op.divergences(frame(spark, [])).count() == 0


def test_spilled_stripes_merge_to_the_same(monkeypatch):
    import numpy as np
    import pyarrow as pa
    rows = [r for r in _mixed(6)]
    table = pa.RecordBatch.from_pydict({"text": [r[1] for r in rows], "lang": [r[2] or "" for r in rows], "source": [r[3] or "" for r in rows]},
                                       schema=pa.schema([("text", pa.string()), ("lang", pa.string()), ("source", pa.string())]))

    def merged():
        spilled = list(op._fold([table.slice(i, 7) for i in range(0, table.num_rows, 7)]))
        parts = pa.Table.from_batches(spilled).sort_by([("lang", "ascending"), ("term", "ascending")]).to_batches(max_chunksize=13)
        return len(spilled), sorted((r["lang"], r["term"], r["df"], *sorted(zip(r["sources"], r["counts"]))) for b in op._merge(parts) for r in b.to_pylist())

    once, whole = merged()
    monkeypatch.setattr(op, "STRIPE_CELLS", 30)
    often, again = merged()
    assert once == 1 < often and whole == again and np.all([r[2] >= 1 for r in whole])
