"""Versioned and range-partitioned stores, and the block index of a history."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from leadtime.operators import history, nightly
from leadtime.plans.lineage import fresh_path
from leadtime.sources import ranged, sinks, versions
from tests.helpers import at


def _local(root):
    return root.removeprefix("file://")


def test_of_two_writers_one_gets_the_number(spark):
    root = fresh_path(spark, "store")
    sinks.commit_version(spark.range(1), root)
    assert versions.last_version(spark, root)[0] == 1
    assert versions.claim(spark, root, 2, "a") and not versions.claim(spark, root, 2, "b")
    assert versions.last_version(spark, root) == (2, "a")
    files = os.listdir(f"{_local(root)}/pointer")
    assert len(files) == 2 and all(json.loads(open(f"{_local(root)}/pointer/{f}").read()) for f in files)


def test_writers_from_one_start_lose_nothing(spark):
    """The second writer commits while the first one is merging: the first reads again."""
    root, tried = fresh_path(spark, "store"), []

    def add(values, between=None):
        def merge(before):
            tried.append(before)
            rows = spark.createDataFrame([(v,) for v in values], "v int")
            rows = rows if before is None else spark.read.parquet(before).unionByName(rows)
            path = versions.data_path(root)
            rows.write.parquet(path)
            if between is not None and len(tried) == 2:
                between()
            return path
        return merge

    versions.commit_merged(spark, root, add([1]))
    versions.commit_merged(spark, root, add([2], lambda: versions.commit_merged(spark, root, add([3]))))
    assert versions.last_version(spark, root)[0] == 3 and len(tried) == 4
    assert sorted(r.v for r in spark.read.parquet(versions.current_version(spark, root)).collect()) == [1, 2, 3]
    with pytest.raises(RuntimeError):
        versions.commit_merged(spark, root, lambda before: versions.claim(spark, root, versions.last_version(spark, root)[0] + 1, "x") and "y", tries=2)


def _rows(keys):
    return [(k, f"n{k % 3}", float(k)) for k in keys]


SCHEMA = "k int, name string, v double"


def test_a_batch_of_one_key_reads_one_file_of_many(spark, monkeypatch):
    root = fresh_path(spark, "ranged")
    ranged.create(spark.createDataFrame(_rows(range(1000)), SCHEMA), root, ["k"], file_rows=50)
    before = {r.file: (r.low.k, r.high.k, r.n_rows) for r in ranged.manifest(spark, root).collect()}
    assert len(before) >= 15 and sum(n for _, _, n in before.values()) == 1000
    read = []
    monkeypatch.setattr(ranged, "_read_files", lambda s, files, keys, f=ranged._read_files: read.append(list(files)) or f(s, files, keys))
    ranged.merge(spark.createDataFrame([(500, "new", -1.0)], SCHEMA), root, ["k"], file_rows=50)
    assert len(read) == 1 and len(read[0]) == 1
    after = {r.file: (r.low.k, r.high.k, r.n_rows) for r in ranged.manifest(spark, root).collect()}
    assert set(before) - set(after) == set(read[0]) and len(set(after) - set(before)) in (1, 2)
    got = {r.k: (r.name, r.v) for r in ranged.read(spark, root).collect()}
    assert len(got) == 1000 and got[500] == ("new", -1.0) and got[499] == ("n1", 499.0)
    part = ranged.read(spark, root, [100], [120])
    assert sorted(r.k for r in part.collect()) == list(range(100, 121)) and len(read[-1]) < 5


@pytest.mark.parametrize("seed", range(3))
def test_merges_equal_upserts(spark, seed):
    """Composite keys with nulls, keys before, between and behind the files, several batches."""
    rng = random.Random(seed)
    key = lambda: (rng.choice([None, "a", "b", "é", "日"]), rng.choice([None, *range(40)]))
    schema = "s string, i int, v double, batch int"

    def batch(n, number):
        return [(*k, float(rng.randrange(9)), number) for k in {key() for _ in range(n)}]

    first = batch(60, 0)
    root = fresh_path(spark, "ranged")
    ranged.create(spark.createDataFrame(first, schema), root, ["s", "i"], file_rows=7)
    whole = spark.createDataFrame(first, schema)
    for number, keep in ((1, "last"), (2, "first"), (3, "last")):
        new = spark.createDataFrame(batch(rng.choice([1, 25]), number), schema)
        new = new.unionByName(new.limit(2))  # repeated rows
        whole = sinks.upsert(whole, new, ["s", "i"], keep)
        ranged.merge(new, root, ["s", "i"], keep, file_rows=7)
        got = ranged.read(spark, root)
        assert sorted(map(str, got.collect())) == sorted(map(str, whole.select(got.columns).collect()))
        assert sorted(got.columns) == sorted(whole.columns)
    same = versions.current_version(spark, root)
    assert ranged.merge(new.limit(0), root, ["s", "i"]) == same


def test_merges_of_the_whole_range_keep_the_number_of_files(spark):
    """Files that are all read make one range; a task writes many small files, and a batch is not written again."""
    from leadtime.plans.lineage import materialize
    root = fresh_path(spark, "ranged")
    ranged.create(spark.createDataFrame(_rows(range(0, 2000, 2)), SCHEMA), root, ["k"], file_rows=50)
    for i in range(3):
        new = materialize(spark.createDataFrame([(k, f"m{i}", 0.5) for k in range(1, 2000, 20)], SCHEMA), "new")
        ranged.merge(new, root, ["k"], file_rows=50, written=True)
    files = ranged.manifest(spark, root).orderBy("low").collect()
    assert 1100 / 50 <= len(files) <= 1100 / 50 + 2 and sum(f.n_rows for f in files) == 1100
    assert all(a.high.k < b.low.k for a, b in zip(files, files[1:])) and max(f.n_rows for f in files) <= 50
    assert len({f.file.rsplit("/", 1)[1].split("-")[1] for f in files}) == 1  # the task that wrote it
    got = {r.k: r.name for r in ranged.read(spark, root).collect()}
    assert got[1] == "m2" and got[2] == "n2" and len(got) == 1100


def _history(spark, seed=1, days=1.0):
    rng = random.Random(seed)
    rows = [(e, at(h / 6 + (e or 0) * 0.01), rng.random()) for e in (1, 2, None) for h in sorted(rng.sample(range(0, 1500), 300 if e == 1 else 80))]
    df = spark.createDataFrame(rows, "entity_id int, ts timestamp, v double").coalesce(1)
    store = history.History(spark, fresh_path(spark, "history"), days=days)
    cuts = [at(0), at(90), at(170), at(1000)]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        for _ in range(2 if i == 1 else 1):  # an increment that runs twice
            store.append(df.where((F.col("ts") >= F.lit(a)) & (F.col("ts") < F.lit(b))), i)
    return df, store


def _set(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


@pytest.mark.parametrize("days", [0.5, 3.0])
def test_history_answers_equal_a_scan(spark, days):
    df, store = _history(spark, days=days)
    assert _set(store.trailing(25), "entity_id", "ts", "v") == _set(nightly.trailing_rows(df, 25), "entity_id", "ts", "v")
    mark = spark.createDataFrame([(1, at(150)), (2, at(200)), (None, at(20))], "entity_id int, stored_until timestamp")
    columns = ("entity_id", "ts", "v", "row_no", "is_new")
    assert _set(store.trailing(25, mark), *columns) == _set(nightly.with_context(df, mark, 25), *columns)
    some = mark.where("entity_id = 1")
    assert _set(store.after(some), "entity_id", "ts", "v") == _set(nightly.new_rows(df, some), "entity_id", "ts", "v")
    assert _set(store.after(mark), "entity_id", "ts", "v") == _set(nightly.new_rows(df, mark), "entity_id", "ts", "v")
    assert {(r.entity_id, r.n_rows) for r in store.known().collect()} == {(1, 300), (2, 80), (None, 80)}


def test_only_late_blocks_are_read(spark):
    df, store = _history(spark, days=1.0)
    mark = spark.createDataFrame([(1, at(200)), (2, at(200)), (None, at(200))], "entity_id int, stored_until timestamp")
    text = store.after(mark)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in text.splitlines() if "increment" in line or "PartitionFilters" in line]
    assert any("block" in line and ">=" in line and "GreaterThanOrEqual(ts" in line for line in scans)


def test_nothing_stored_behind_the_mark(spark):
    df, store = _history(spark)
    mark = spark.createDataFrame([(e, at(9999)) for e in (1, 2, None)], "entity_id int, stored_until timestamp")
    assert store.after(mark).count() == 0 and store.trailing(5, mark).count() == 0
