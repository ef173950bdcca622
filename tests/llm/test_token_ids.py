import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from leadtime.llm import token_ids as op
from tests.llm.data import frame, hostile

FILE = "word_bpe_49k.json"


def _library(text):
    return Tokenizer.from_file(public_tokenizers.path(FILE)).encode(text or "", add_special_tokens=False).ids + [1]


def test_hostile_texts_against_the_library(spark):
    rows = hostile()
    found = {r.doc_id: r for r in op.token_ids(frame(spark, rows).repartition(3)).collect()}
    start = 0
    for doc_id, text, *_ in sorted(rows):
        ids, r = _library(text), found[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), text
        start += len(ids)


def test_pieces_of_random_characters():
    rng = random.Random(2)
    alphabet = list("abCZé ÉÑß'.,!#12 \n\t\x0b ́　sS") + ["'s", "'ll", " ", "İ", "日", "\U0001f600", "ſ", "ſ", "Å", "Å"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(400)]
    raw = [t.encode() for t in texts]
    encoder = op.PieceEncoder(FILE)
    ids, counts = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    at = 0
    for text, n in zip(texts, counts):
        assert ids[at:at + n].tolist() == _library(text), text
        at += n


@pytest.mark.parametrize("seed", range(4))
def test_grammar_round_trip_and_random_access(seed):
    rng = np.random.default_rng(seed)
    counts = rng.integers(1, 400, 80)
    ids = rng.choice([3, 4, 5, 5, 5, 900], int(counts.sum())).astype(np.uint32)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    shard = op.Shard(op.pack(np.arange(80), ids, bounds, 1000))
    assert len(shard.rules) and len(shard.symbols) < len(ids) / 1.5
    for d in range(80):
        own = ids[bounds[d]:bounds[d + 1]]
        assert (shard.ids(d) == own).all()
        a, b = sorted(rng.integers(0, len(own) + 2, 2))
        assert (shard.some(d, a, b) == own[a:b]).all()
    for i, pair in enumerate(shard.rules):  # a rule expands to its parts, and to as many ids as the file says
        whole = shard.expansions.of(np.array([1000 + i]))
        assert len(whole) == shard.lengths[i] and (whole == shard.expansions.of(pair)).all()


def test_files_follow_the_id_order(spark):
    from leadtime.plans.lineage import fresh_path
    rows = hostile()
    path = fresh_path(spark, "ids")
    manifest = op.write_shards(frame(spark, rows), path, FILE).orderBy("first_id").collect()
    assert all(a.last_id <= b.first_id for a, b in zip(manifest, manifest[1:]))
    assert sum(r.documents for r in manifest) == len(rows)


def test_repeated_and_null_ids_and_no_rows(spark):
    assert op.token_ids(frame(spark, [])).count() == 0
    rows = [(i, t, None, None, 0, *["x"] * 16) for i, t in [(5, "b"), (5, "a"), (None, "z"), (5, "a"), (1, None)]]
    found = sorted((r.start, r.doc_id, r.n_tokens) for r in op.token_ids(frame(spark, rows)).collect())
    assert [d for _, d, _ in found] == [None, 1, 5, 5, 5] and [s for s, _, _ in found] == [0, 2, 3, 5, 7]


def test_a_small_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(op, "REMEMBERED", 50)
    raw = [(r[1] or "").encode() for r in hostile()]
    encoder = op.PieceEncoder(FILE)
    for b, r in zip(raw, hostile()):
        assert encoder.encode(np.frombuffer(b, np.uint8), np.array([0, len(b)]))[0].tolist() == _library(r[1])


def test_grammar_goes_on_until_no_rule_pays():
    ids = np.full(1 << 16, 7, np.uint32)
    symbols, _, rules, lengths = op.repair(ids, np.array([0, len(ids)]), 1000)
    assert len(symbols) <= 8 and lengths.max() >= 1 << 13
    rng = np.random.default_rng(1)
    passage = rng.integers(0, 1000, 300)
    ids = np.concatenate([np.r_[passage, rng.integers(0, 1000, 50)] for _ in range(5)] + [rng.integers(0, 1000, 20_000)]).astype(np.uint32)
    bounds = np.array([0, 0, 350, 1000, len(ids), len(ids)])
    shard = op.Shard(op.pack(np.arange(5), ids, bounds, 1000))
    assert all((shard.ids(d) == ids[bounds[d]:bounds[d + 1]]).all() for d in range(5))
    left, places = {}, {}
    for d in range(5):
        own = shard.symbols[shard.bounds[d]:shard.bounds[d + 1]].tolist()
        for i, pair in enumerate(zip(own, own[1:])):
            if places.get(pair) != (d, i - 1):  # overlapping places count once
                left[pair], places[pair] = left.get(pair, 0) + 1, (d, i)
    assert max(left.values()) < op.LEAST and shard.lengths.max() >= 50


@pytest.mark.parametrize("file, pieced", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_ids_of_another_tokenizer_file(file, pieced):
    texts = ["", "Hello  World, it's A\ttest\n", " É Ü 日本 <|endoftext|> X", "ABC abc 12"]
    raw = [t.encode() for t in texts]
    encoder = op.PieceEncoder(file)
    ids, counts = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    library = Tokenizer.from_file(public_tokenizers.path(file))
    assert encoder.pieced == pieced
    assert ids.tolist() == [x for t in texts for x in [*library.encode(t, add_special_tokens=False).ids, 1]]


def test_ascii_words_go_to_the_model_in_one_lookup_a_step(spark, monkeypatch):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(1, 12))) for _ in range(3000)]
    text = " ".join([*words, "Été", "DON'T", "x1", *words[:500], "<|endoftext|>s"])
    encoder = op.PieceEncoder(FILE)
    asked = []
    monkeypatch.setattr(encoder, "_encode_ascii", lambda w, f=encoder._encode_ascii: asked.extend(w) or f(w))
    raw = text.replace("<|endoftext|>", "").encode()
    for _ in range(2):
        ids = encoder.encode(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]
        assert ids.tolist() == _library(raw.decode())
    assert len(asked) == len(set(asked)) and set(words) <= {w.decode() for w in asked}
    encoder.direct = False  # as for a file with a word among its added tokens
    encoder._forget()
    assert encoder.encode(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0].tolist() == ids.tolist()


@pytest.mark.parametrize("top", [1000, 1 << 31])
def test_frequent_pairs_against_counting(top):
    rng = np.random.default_rng(3)
    left, right = (rng.choice([0, 1, 5, top - 2, top - 1], 400).astype(np.uint32) for _ in range(2))
    places = {}
    for i, pair in enumerate(zip(left.tolist(), right.tolist())):
        places.setdefault(pair, []).append(i)
    wanted = sorted(p for p, at in places.items() if len(at) >= op.LEAST)
    pairs, counts, which = op._frequent(left, right, top)
    assert [tuple(p) for p in pairs.tolist()] == wanted and counts.tolist() == [len(places[p]) for p in wanted]
    assert which.tolist() == [wanted.index(p) if p in wanted else -1 for p in zip(left.tolist(), right.tolist())]
    assert [x.size for x in op._frequent(left[:0], right[:0], top)] == [0, 0, 0]


def test_shards_are_cut_inside_a_step(spark, monkeypatch):
    from leadtime.plans.lineage import fresh_path
    monkeypatch.setattr(op, "SHARD_IDS", 10)
    assert list(op._shards(np.array([4, 6, 1, 25, 2]), 0)) == [(0, 2, True), (2, 4, True), (4, 5, False)]
    assert list(op._shards(np.array([4, 6]), 9)) == [(0, 1, True), (1, 2, False)] and not list(op._shards(np.array([], np.int64), 9))
    rows = [(i, "a b c d", None, None, 0, *["x"] * 16) for i in range(9)]
    batches = [pa.RecordBatch.from_pydict({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]})]
    made = list(op._write(FILE, fresh_path(spark, "cut"))(iter(batches)))
    assert [b.num_rows for b in made] == [2, 2, 2, 2, 1]


def test_a_worker_learns_a_piece_once_for_all_its_tasks(spark, monkeypatch):
    from leadtime.plans.lineage import fresh_path
    op._encoder.cache_clear()
    learned = []
    monkeypatch.setattr(op.PieceEncoder, "_learn", lambda self, p, f=op.PieceEncoder._learn: learned.extend(p) or f(self, p))
    texts = ["one two three", "two élan three four <|endoftext|>", "", None, "x1 one four's"]
    made, folders = [], [fresh_path(spark, "again") for _ in range(2)]
    for folder in (folders[0], folders[0], folders[1]):
        if folder == folders[1]:
            assert b"three" in learned and len(learned) == len(set(learned))
        batch = pa.RecordBatch.from_pydict({"doc_id": list(range(5)), "text": texts})
        made.append([b.column("n_tokens").to_pylist() for b in op._write(FILE, folder)(iter([batch]))])
    assert made == [[[len(_library(t)) for t in texts]]] * 3
    assert learned.count(b"three") == 2  # another run begins anew
    op._encoder.cache_clear()


def test_accented_words_go_to_the_model_too(monkeypatch):
    letters = [chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)]
    text = " ".join(a + b for a in letters for b in ("", "a", "à", "\u00ed\u00ed", "s" + a))
    encoder = op.PieceEncoder(FILE)
    monkeypatch.setattr(encoder, "_encode_words", None)  # is for files whose words can't go to the model
    raw = text.encode()
    assert encoder.encode(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0].tolist() == _library(text)
