"""The two classifiers' queries, row by row, against plain-Python versions over whole texts."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from leadtime.llm import language_id, quality
from leadtime.llm.queries import op4, op6
from tests.llm.data import frame, hostile

SF = "/root/testdata/sf0.001"
STOPS, LETTERS = b".,;:?'\"()-", re.compile(rb"[A-Za-z0-9\x80-\xff]")


def _share(part, whole):
    return part / whole if whole > 0 else 0.0


def _longest_run(words):
    best = run = 0
    for i, w in enumerate(words):
        run = run + 1 if i and w == words[i - 1] else 1
        best = max(best, run)
    return best


def plain_statistics(text):
    data = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    lines = [x for x in data.split(b"\n") if x]
    n, size = len(words), len(data)
    count = lambda chars: sum(data.count(bytes([c])) for c in set(chars))
    marks = [c for c in range(33, 127) if not chr(c).isalnum() and c not in STOPS]
    wide = count(range(128, 256))
    letters = count(range(65, 91)) + count(range(97, 123)) + wide / 2
    distinct = sum(len(set(words[i:i + 100])) for i in range(0, n, 100))
    return {"log_words": math.log1p(n), "word_bytes": _share(sum(map(len, words)), n), "upper": _share(count(range(65, 91)), letters),
            "marks": _share(count(marks), size), "stops": _share(count(STOPS), size), "digits": _share(count(b"0123456789"), size),
            "spaces": _share(count(b" \t\n\x0b\x0c\r"), size), "wide": _share(wide, size),
            "same_as_before": _share(sum(a == b for a, b in zip(words, words[1:])), n), "distinct": _share(distinct, n),
            "bare_marks": _share(sum(not LETTERS.search(w) for w in words), n), "ends_in_mark": _share(sum(w[-1] in marks for w in words), n),
            "top_run": _share(_longest_run(words), n), "same_lines": _share(len(lines) - len(set(lines)), len(lines))}


def plain_score(ensemble, stats):
    total = ensemble.intercept + sum(weight for rule, weight in ensemble.rules
                                     if all(stats[name] > t if above else stats[name] <= t for name, above, t in rule.conditions))
    return 1 / (1 + math.exp(-total))


def test_statistics_of_any_text(spark):
    rows = hostile()
    found = {r.doc_id: r for r in quality.statistics(frame(spark, rows)).collect()}
    for row in rows:
        want = plain_statistics(row[1])
        assert tuple(want) == quality.STATISTICS
        for name, value in want.items():
            assert found[row[0]][name] == pytest.approx(value, abs=1e-12), (row[1], name)


def test_quality_of_every_document(spark, monkeypatch):
    learned, learn = [], quality.learn
    monkeypatch.setattr(quality, "learn", lambda *given: learned.append(learn(*given)) or learned[-1])
    found = op4(spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    assert len(found) == len(texts) and len(learned) == 1 and learned[0].rules
    for r in found:
        want = plain_score(learned[0], plain_statistics(texts[r.doc_id]))
        assert r.score == pytest.approx(want, abs=1e-9) and r.predicted == (1 if r.score >= 0.5 else 0)


def _mixed(x):
    wrap = (1 << 64) - 1
    x = (x + 0x9E3779B97F4A7C15) & wrap
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & wrap
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & wrap
    return x ^ (x >> 31)


def plain_ngrams(text):
    codes = []
    for c in text or "":
        low = c.lower()
        codes.append(0 if not c.isalpha() else ord(low if len(low) == 1 else c))
    found, bucket = Counter(), {}
    for n in language_id.ORDERS:
        for i in range(len(codes) - n + 1):
            gram = tuple(codes[i:i + n])
            if any(gram):
                if gram not in bucket:
                    key = 0
                    for code in gram:
                        key = key << 21 | code
                    bucket[gram] = _mixed((key + (n << 62)) & ((1 << 64) - 1)) % language_id.BUCKETS
                found[bucket[gram]] += 1
    return found


def plain_languages(rows):
    """rows: (doc_id, text, lang); the likeliest language and its posterior by id."""
    grams = {i: plain_ngrams(text) for i, text, _ in rows}
    counts = {}
    for i, text, lang in rows:
        if lang is not None and text is not None and zlib.crc32(str(i).encode()) % 3 != 1:
            counts.setdefault(lang, Counter()).update(grams[i])
    whole = {lang: sum(c.values()) + language_id.ADDED * language_id.BUCKETS for lang, c in counts.items()}
    out = {}
    for i, _, _ in rows:
        if not grams[i] or not counts:
            out[i] = ("und", 0.0)
            continue
        logs = {lang: sum(n * float(np.float32(math.log((c[b] + language_id.ADDED) / whole[lang]))) for b, n in grams[i].items())
                for lang, c in sorted(counts.items())}
        best = max(logs, key=logs.get)
        out[i] = (best, 1 / sum(math.exp(v - logs[best]) for v in logs.values()))
    return out


def test_language_of_every_document(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]
    want, found = plain_languages(rows), op6(spark, SF).collect()
    assert len(found) == len(want) == len(rows)
    for r in found:
        assert r.lang_pred == want[r.doc_id][0] and r.score == pytest.approx(want[r.doc_id][1], abs=1e-4), r


def test_language_of_hostile_texts(spark):
    rows = hostile()
    want = plain_languages([r[:3] for r in rows])
    for r in language_id.identify(frame(spark, rows)).collect():
        assert r.score == pytest.approx(want[r.doc_id][1], abs=1e-4)
        assert r.lang_pred == want[r.doc_id][0] or r.score == pytest.approx(0.5, abs=1e-3), r
