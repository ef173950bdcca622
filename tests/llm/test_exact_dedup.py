import hashlib
from collections import defaultdict

import numpy as np
import pytest

from leadtime.llm import exact_dedup as op
from tests.llm.data import SPACE, frame, hostile


def _expected(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[SPACE.sub("", text or "")].append((-len(text or ""), doc_id))
    out = []
    for plain, members in groups.items():
        keep = min(members)[1]
        out += [(d, keep, len(members), d == keep, hashlib.sha256(plain.encode()).hexdigest()) for _, d in members]
    return sorted(out)


def test_groups_of_hostile_texts(spark):
    rows = hostile()
    found = op.exact_dedup(frame(spark, rows))
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(tuple(r) for r in found.collect()) == _expected(rows)


def test_empty_table_and_repeated_rows(spark):
    assert op.exact_dedup(frame(spark, [])).count() == 0
    rows = [hostile()[11]] * 3
    found = op.exact_dedup(frame(spark, rows)).collect()
    assert [(r.group_size, r.kept) for r in found] == [(3, True)] * 3


def test_filter_finds_all_and_deletes():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 2**63, 3000).astype(np.uint64)
    held = op.CuckooFilter.sized(len(hashes))
    assert held.insert(hashes)
    assert held.may_hold(hashes).all()
    other = rng.integers(0, 2**63, 20000).astype(np.uint64)
    assert held.may_hold(other).mean() < 0.01
    held.delete(hashes[:1500])
    assert held.may_hold(hashes[1500:]).all()
    assert held.may_hold(hashes[:1500]).mean() < 0.01


def test_overflow_rebuilds_from_stored_keys():
    shard = op._Shard(np.zeros(0, "S32"), np.zeros((0, 3), np.int64), op.CuckooFilter(4))
    keys = np.array([hashlib.sha256(str(i).encode()).digest() for i in range(500)], "S32")
    for at in range(0, 500, 50):
        values = np.stack([np.arange(at, at + 50), np.ones(50), np.ones(50)], axis=1).astype(np.int64)
        shard.add(keys[at:at + 50], values)
    assert shard.resized >= 5 and (shard.find(keys) >= 0).all()
    assert (shard.find(np.array([hashlib.sha256(b"no").digest()], "S32")) == -1).all()


def test_index_inserts_looks_up_and_deletes(spark):
    def rows(pairs):
        return spark.createDataFrame([(hashlib.sha256(str(k).encode()).digest(), i, 1, 1) for k, i in pairs], "digest binary, keep_id long, n_points long, group_size long")

    index = op.CuckooIndex(spark, 3).insert(rows([(k, k) for k in range(60)])).insert(rows([(k, 100 + k) for k in range(50, 80)]))
    stored = {bytes(r.digest): (r.keep_id, r.group_size) for r in index.keys().collect()}
    assert len(stored) == 80 and stored[hashlib.sha256(b"55").digest()] == (55, 2)
    index = index.delete(rows([(k, 0) for k in range(70)]))
    asked = rows([(k, 0) for k in (5, 69, 70, 79, 1000)])
    assert sorted(r.keep_id for r in index.look_up(asked).collect()) == [170, 179]
    again = index.insert(rows([(5, 7)])).look_up(asked)
    assert sorted(r.keep_id for r in again.collect()) == [7, 170, 179]


@pytest.mark.parametrize("n", [0, 1])
def test_index_of_nothing(spark, n):
    empty = op.CuckooIndex.create(spark, 10)
    asked = spark.createDataFrame([(b"\0" * 32,)][:n], "digest binary")
    assert empty.look_up(asked).count() == 0 and empty.delete(asked).keys().count() == 0
