import zlib

from leadtime.llm import language_id as op
from leadtime.llm.queries import op6
from tests.llm.data import frame


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    found = op6(spark, sf).collect()
    assert len(found) == len(lang) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    held = [r.lang_pred == lang[r.doc_id] for r in found if r.held_out]
    assert sum(held) / len(held) >= 0.98 and all(0 <= r.score <= 1 for r in found)


def _rows(pairs):
    return [(i, text, lang, "s", 0, *["clash"] * 16) for i, text, lang in pairs]


def test_texts_without_letters_and_ties(spark):
    pairs = [(i, "alpha beta gamma" if i % 2 else "über größe straße", "en" if i % 2 else "de") for i in range(40)]
    pairs += [(100, None, "en"), (101, "", None), (102, "12 34 !?", "en"), (103, "größe", None), (104, "beta", "de"), (104, "beta", "de"), (None, "gamma", None)]
    found = op.identify(frame(spark, _rows(pairs))).collect()
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in found}
    assert len(found) == len(pairs)
    assert by_id[100] == by_id[101] == by_id[102] == ("und", 0.0)
    assert by_id[103][0] == "de" and by_id[104][0] == "en" and by_id[None][0] == "en"


def test_nothing_to_learn(spark):
    found = op.identify(frame(spark, _rows([(1, "text", None), (2, None, "en")]))).collect()
    assert {(r.lang_pred, r.score) for r in found} == {("und", 0.0)}
    assert op.identify(frame(spark, [])).count() == 0


def test_ngrams_stay_inside_their_text():
    import numpy as np
    a, b = "abé".encode(), "ßcd".encode()
    apart = [x for t in (a, b) for buckets, _ in op.ngrams(np.frombuffer(t, np.uint8), np.array([0, len(t)])) for x in buckets]
    both = [x for buckets, _ in op.ngrams(np.frombuffer(a + b, np.uint8), np.array([0, len(a), len(a + b)])) for x in buckets]
    assert sorted(apart) == sorted(both) and len(both) == 12
