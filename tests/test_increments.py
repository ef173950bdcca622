"""A store of features under late, repeated and replayed readings equals one run over all readings."""

import os
import random

import pytest

from helpers import at, same, telemetry
from leadtime.operators.rolling import rolling_features
from leadtime.plans.lineage import fresh_path
from leadtime.streaming import jobs
from leadtime.streaming.increments import FeatureStore

WINDOWS = {"a": 3, "b": 9}
COLUMNS = "v double, w double"


def base(spark):
    return spark.createDataFrame([(1, "v", 2.0, 0.5), (2, "v", 1.0, 0.0), (1, "w", 1.0, 0.7)],
                                 "entity_id int, sensor string, mean double, p90 double")


def made(spark, **options):
    return FeatureStore(fresh_path(spark, "store"), ["v", "w"], base(spark), windows=WINDOWS, chunk_rows=10, file_rows=40,
                        **{"days": 0.3, "fold": 2} | options)


def table(df):
    names = [c for c in sorted(df.columns) if c not in ("entity_id", "ts")]
    rows = [((r.entity_id is None, r.entity_id or 0, r.ts), *[r[c] for c in names]) for r in df.collect()]
    return sorted(rows, key=lambda row: row[0])


def assert_whole(spark, store, rows):
    whole = table(rolling_features(telemetry(spark, rows, COLUMNS), ["v", "w"], base(spark), windows=WINDOWS, chunk_rows=10))
    ours = table(store.features(spark))
    assert [x[0] for x in ours] == [x[0] for x in whole]
    for a, b in zip(ours, whole):
        assert all(same(p, q, 1e-6) or abs(p - q) < 1e-6 for p, q in zip(a[1:], b[1:])), (a, b)


def series(seed, n=70):
    """A sensor that is often missing, one that is silent for long, and an entity without a key."""
    rnd = random.Random(seed)
    rows = [(e, float(h), rnd.random() if rnd.random() < 0.4 else None, rnd.random() if h < 8 or h % 29 == 0 else None)
            for e in (1, 2, None) for h in sorted(rnd.sample(range(n), n if e == 1 else n // 3))]
    return rnd, rows


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_arrival_gives_one_run(spark, seed):
    """Late readings up to any age, with what was given before coming again now and then."""
    rnd, rows = series(seed)
    store = made(spark)
    parts = [[] for _ in range(4)]
    for row in rows:
        home = min(3, int(row[1] // 18))
        parts[min(3, home + (rnd.randrange(1, 4) if rnd.random() < 0.15 else 0))].append(row)
    given = []
    for i, part in enumerate(parts):
        again = rnd.sample(given, min(len(given), 5))
        store.add(telemetry(spark, part + again, COLUMNS), i)
        given += part
    assert_whole(spark, store, rows)
    counts = {r.increment: r for r in store.counts(spark).collect()}
    assert sum(r.n_late + r.n_new for r in counts.values()) == len(rows)
    assert [counts[i].n_repeated for i in range(4)] == [0, 5, 5, 5]


def test_increment_that_runs_again(spark):
    _, rows = series(5)
    store = made(spark, fold=1)
    for i in (0, 1, 1, 2, 2):
        store.add(telemetry(spark, [r for r in rows if r[1] % 3 == i], COLUMNS), i)
    assert_whole(spark, store, rows)
    with pytest.raises(ValueError):
        store.add(telemetry(spark, rows[:1], COLUMNS), 0)


def test_a_late_reading_touches_what_its_effect_reaches(spark):
    """v is known in every row: three days, six blocks of half a day and a frame of 9 rows."""
    rows = [(1, h / 2, float(h % 7), 1.0) for h in range(144)]
    late = (1, 10.25, 99.0, None)
    store = made(spark, days=0.5)
    store.add(telemetry(spark, rows, COLUMNS), 0)
    store.add(telemetry(spark, [late], COLUMNS), 1)
    assert_whole(spark, store, [*rows, late])
    counts = store.counts(spark).where("increment = 1").first()
    # the rest of its block, the next one where v has a value again, and one more for the frames
    assert (counts.n_late, counts.n_new, counts.n_written) == (1, 0, 4 + 24 + 24)


def test_readings_without_a_time_and_empty_increments(spark):
    store = made(spark)
    store.add(telemetry(spark, [], COLUMNS), 0)
    store.add(spark.createDataFrame([(1, None, 1.0, 1.0), (1, at(1), 1.0, None), (1, at(1), 2.0, None)], f"entity_id int, ts timestamp, {COLUMNS}"), 1)
    store.add(telemetry(spark, [], COLUMNS), 2)
    assert_whole(spark, store, [(1, 1.0, 2.0, None)])
    got = store.counts(spark).orderBy("increment").select("n_given", "n_without_time", "n_repeated", "n_new", "n_written").collect()
    assert [tuple(r) for r in got] == [(0, 0, 0, 0, 0), (3, 1, 1, 1, 1), (0, 0, 0, 0, 0)]


def folders(path):
    return sorted(f for f in os.listdir(path) if "=" in f)


def test_folders_stay_few(spark):
    rows = [(1, float(h), float(h), None) for h in range(40)]
    store, old = made(spark, fold=3), fresh_path(spark, "store")
    handle = jobs.feature_batches(old, ["v"], base(spark), {"a": 3})
    for i in range(10):
        part = [r for r in rows if r[1] // 4 == i]
        store.add(telemetry(spark, part, COLUMNS), i)
        handle(telemetry(spark, part, COLUMNS), i)
        assert len(folders(f"{store.root}/index")) <= 4
    assert folders(f"{old}/context") == ["batch_id=8", "batch_id=9"]
    assert len([f for f in os.listdir(f"{store.root}/folded/data")]) == 1
    assert_whole(spark, store, rows)
