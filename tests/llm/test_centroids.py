import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import types as T

from leadtime.llm import centroids as op

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       *(T.StructField(n, T.StringType()) for n in ("cluster", "v", "distance", "inertia", "total", "n"))])


def _expected(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v, *_ in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    points = [list(v) for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(points))

    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(nearest(v)[1], []).append(v)
        for c, vs in own.items():
            points[c] = [sum(x) // len(vs) for x in zip(*vs)]
    found = [(i, nearest(v)) for i, v in kept]
    per = {}
    for _, (d, c) in found:
        per[c] = per.get(c, 0) + d
    return sorted([(i, c, d, per[c], sum(per.values()), hashlib.sha256(",".join(map(str, points[c])).encode()).hexdigest()) for i, (d, c) in found], key=str)


def _hostile(seed=1, n=150):
    rng = np.random.default_rng(seed)
    clash = ["x"] * 6
    rows = [(i, [float(x) for x in rng.normal(size=64) * rng.choice([0.05, 1, 30])], *clash) for i in range(n)]
    rows += [(1000 + i, list(rows[3][1]), *clash) for i in range(60)]  # a large group of copies
    rows += [(5, rows[9][1], *clash), (5, rows[9][1], *clash), (None, rows[10][1], *clash)]  # repeated and null ids
    rows += [(2000, None, *clash), (2001, [], *clash), (2002, [1.0] * 63, *clash), (2003, [1.0] * 65, *clash), (2004, [math.nan] + [0.0] * 63, *clash),
             (2005, [math.inf] + [0.0] * 63, *clash), (2006, [None] + [0.0] * 63, *clash)]
    return rows


@pytest.mark.parametrize("n", [150, 7, 0])
def test_hostile_vectors_against_plain_loops(spark, n):
    rows = _hostile(n=n) if n > 20 else _hostile()[:n]
    got = op.clusters(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == _expected(rows)


@pytest.mark.parametrize("k, spread", [(1, 9), (5, 2), (40, 1), (300, 2), (300, 500)])
def test_tree_search_equals_a_scan(k, spread):
    rng = np.random.default_rng(k + spread)
    points = rng.integers(-spread, spread + 1, (k, 6))  # many ties and equal points
    vectors = np.concatenate([rng.integers(-spread, spread + 1, (500, 6)), points])
    best, away = op.VantageTree(points).nearest(vectors)
    every = ((vectors[:, None, :] - points[None]) ** 2).sum(axis=2)
    assert (best == every.argmin(axis=1)).all() and (away == every.min(axis=1)).all()


def test_search_leaves_out_most_points_of_apart_groups(monkeypatch):
    rng = np.random.default_rng(2)
    groups = rng.integers(-10**6, 10**6, (20, 64))
    points = np.repeat(groups, 30, axis=0) + rng.integers(-5, 6, (600, 64))
    vectors = points + rng.integers(-3, 4, points.shape)
    compared = []
    monkeypatch.setattr(op, "squared", lambda v, p, f=op.squared: compared.append(len(v)) or f(v, p))
    tree = op.VantageTree(points)
    compared.clear()
    best, _ = tree.nearest(vectors)
    assert (best == ((vectors[:, None, :] - points[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
    assert sum(compared) < 0.35 * len(points) * len(vectors)


def test_coinciding_centroids_keep_the_tree_flat():
    tree = op.VantageTree(np.zeros((5000, 3), np.int64))
    assert tree.nearest(np.zeros((3, 3), np.int64))[0].tolist() == [0, 0, 0]


def test_components_beyond_64_bits_are_refused(spark):
    rows = [(1, [1e30] + [0.0] * 63, *["x"] * 6)]
    with pytest.raises(Exception, match="larger than"):
        op.clusters(spark.createDataFrame(rows, SCHEMA)).collect()
