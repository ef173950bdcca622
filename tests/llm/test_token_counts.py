import random
from functools import lru_cache

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from leadtime.llm import token_counts as op
from tests.llm.data import frame, hostile, sentence

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model")


@lru_cache
def _open(file):
    if file.endswith(".json"):
        return Tokenizer.from_file(public_tokenizers.path(file))
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(file))


def _library(file, text):
    if file.endswith(".json"):
        return len(_open(file).encode(text or "", add_special_tokens=False).ids)
    return len(_open(file).encode(text or ""))


def _texts(seed=1):
    rng = random.Random(seed)
    alphabet = list("abCZé ÉÑß'.,!#12  \n\t\x0b ́　sS") + ["'s", "'ll", " ", "İ", "日", "\U0001f600", "ſ", "<|endoftext|>", " <|startoftext|>", "   ", "word ", "x" * 40, "é" * 30, "\n" * 30]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(300))) for _ in range(60)]
    return texts + ["a" * 700, " " * 500, "ab, " * 300, "日本" * 200, sentence(rng, 400), "x" * 300 + " " + sentence(rng, 50) + " " + "y" * 900 + " end", "w " * 32 + "z" * 200]


@pytest.mark.parametrize("file, chunk, width", [(FILES[0], 50, 4), (FILES[1], 64, 16), (FILES[2], 64, 16)])
def test_spliced_counts_equal_the_library(spark, file, chunk, width):
    rows = [(i, t, None, None, 0, *["x"] * 16) for i, t in enumerate(_texts())]
    got = {r.doc_id: r for r in op.token_counts(frame(spark, rows), file, 100, chunk=chunk, width=width).collect()}
    for i, t, *_ in rows:
        n = _library(file, t)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len(t.encode()), n, n > 100), t


@pytest.mark.parametrize("file", FILES)
def test_every_offered_boundary_splits_the_tokens(file):
    codec = op.Codec(file)
    assert codec.proven()
    for text in _texts(3):
        starts, ends = codec.spans([text])[0]
        at, before = op.boundaries(text, starts, ends, 0, len(text), codec.blanks)
        for a, b in zip(at.tolist(), before.tolist()):
            assert _library(file, text[:a]) == b
            tail = _library(file, "a" + text[a:]) - _library(file, "a")  # what stands before must not matter
            assert tail == len(starts) - b, (text, a)


def test_seams_are_spliced_and_failed_ones_widened(spark, monkeypatch):
    text = sentence(random.Random(1), 300) + " " + "q" * 2000 + " " + sentence(random.Random(2), 300)
    rounds = []
    monkeypatch.setattr(op, "_cut", lambda step, width, f=op._cut: rounds.append((step, width)) or f(step, width))
    rows = [(1, text, None, None, 0, *["x"] * 16)]
    got = op.token_counts(frame(spark, rows), chunk=200, width=20).first()
    assert got.n_tokens == _library(FILES[0], text)
    assert rounds[0] == (200, 20) and 1 < len(rounds) <= 4 and all(b == (max(200, 4 * b[1]), 4 * a[1]) for a, b in zip(rounds, rounds[1:]))


def test_a_file_without_proof_is_encoded_whole(spark, monkeypatch):
    monkeypatch.setattr(op, "_is_proven", lambda file: False)
    rows = [(i, t, None, None, 0, *["x"] * 16) for i, t in enumerate(_texts(2)[:20])]
    got = {r.doc_id: r.n_tokens for r in op.token_counts(frame(spark, rows), chunk=20, width=4).collect()}
    assert all(got[i] == _library(FILES[0], t) for i, t, *_ in rows)


def test_hostile_rows(spark):
    rows = [*hostile(), (None, "a b", None, None, 0, *["x"] * 16), (3, None, None, None, 0, *["x"] * 16), (3, "c", None, None, 0, *["x"] * 16)]
    got = sorted((str(r.doc_id), r.n_tokens) for r in op.token_counts(frame(spark, rows).repartition(3), chunk=1000, width=64).collect())
    assert got == sorted((str(r[0]), _library(FILES[0], r[1])) for r in rows)
    assert op.token_counts(frame(spark, [])).count() == 0
