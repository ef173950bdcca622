import random
from collections import defaultdict

from leadtime.llm import mixing as op
from tests.llm.data import frame, hostile, words


def _targets(sizes, weights=(5, 2, 1), cap=3):
    """Sharing again and again until nothing is above its cap."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_, rest = {}, set(names), sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if rest * weight[s] / total > cap * sizes[s]}
        if not over:
            return target | {s: rest * weight[s] / total for s in open_}
        for s in over:
            target[s] = cap * sizes[s]
        rest -= sum(target[s] for s in over)
        open_ -= over
    return target


def test_targets_and_words_taken(spark):
    rows = hostile()
    found = op.mix(op.materialize(op.word_sizes(frame(spark, rows)))).collect()
    sizes, by_id = defaultdict(int), {}
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
        by_id[r[0]] = (len(words(r[1])), r[3])
    goal, taken = _targets(sizes), defaultdict(int)
    assert len(found) == len(rows)
    for r in found:
        size, source = by_id[r.doc_id]
        assert (r.size, r.source_size) == (size, sizes[source])
        assert abs(r.target - goal[source]) < 1e-6 and 0 <= r.taken <= 3 * size
        taken[source] += r.taken
    for source in sizes:
        assert goal[source] - 1 < taken[source] <= goal[source] + 1e-6


def test_many_sources_and_small_buckets(spark):
    rng = random.Random(5)
    rows = [(i, f"s{min(rng.randrange(40), rng.randrange(40))}" if i % 9 else None, rng.randrange(0, 300)) for i in range(2000)]
    sizes = spark.createDataFrame(rows, "doc_id long, source string, size long")
    a = sorted(tuple(r) for r in op.mix(sizes, bucket_rows=7).collect())
    totals = defaultdict(int)
    for _, s, n in rows:
        totals[s] += n
    goal, source, taken = _targets(totals), {i: s for i, s, _ in rows}, defaultdict(int)
    for doc_id, _, _, target, n in a:
        assert abs(target - goal[source[doc_id]]) < 1e-6
        taken[source[doc_id]] += n
    assert all(goal[s] - 1 < taken[s] <= goal[s] + 1e-6 for s in totals)
    assert a == sorted(tuple(r) for r in op.mix(sizes.repartition(5), bucket_rows=500).collect())  # buckets and partitions change nothing


def test_documents_follow_the_words_taken(spark):
    rows = hostile()
    docs = frame(spark, rows)
    made = op.mixed_documents(docs)
    assert made.schema.simpleString() == docs.schema.simpleString()
    want = {r.doc_id: r.taken for r in op.mix(op.materialize(op.word_sizes(docs))).collect()}
    text, got = {r[0]: r[1] for r in rows}, defaultdict(int)
    for r in made.collect():
        assert (text[r.doc_id] or "").startswith(r.text) and r.n_chars == len(r.text) and r["key"] == "clash"
        got[r.doc_id] += len(words(r.text))
    assert {k: v for k, v in want.items() if v} == dict(got)


def test_no_words_and_no_rows(spark):
    empty = frame(spark, [])
    assert op.mix(op.word_sizes(empty)).count() == 0 and op.mixed_documents(empty).count() == 0
    blank = frame(spark, [r for r in hostile() if not words(r[1])])
    assert [(r.target, r.taken) for r in op.mix(op.word_sizes(blank)).collect()] == [(0.0, 0)] * 3
