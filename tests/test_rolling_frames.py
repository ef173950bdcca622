"""Long frames of the native engine: from running aggregates, equal to the frames added up row by row."""

import random

from pyspark.sql import functions as F

from leadtime.operators import nightly
from leadtime.operators.rolling import rolling_features, rolling_over
from leadtime.plans.series import fill_forward
from tests.helpers import quantile, same, telemetry

WINDOWS = {"a": 5, "b": 60, "c": 100}
BASE = [(1, "v", 2.0, 5.0), (1, "u", None, None), (2, "v", 2.0, 1e9)]


def _features(spark, engine, spike=3.7):
    rng = random.Random(7)
    rows = []
    for e, n in ((1, 733), (2, 100), (3, 59)):
        for i in range(n):  # stretches of one value, a spike that must not outlive its frames
            v = spike if i == 120 else 3.7 if i % 300 < 130 else rng.choice([None, rng.uniform(0, 10)])
            rows.append((e, i / 6, v, rng.uniform(-1, 1)))
    base = spark.createDataFrame(BASE, "entity_id int, sensor string, mean double, p90 double")
    out = rolling_features(telemetry(spark, rows, "v double, u double"), ["v", "u"], base, windows=WINDOWS, engine=engine,
                           stats=("mean", "std", "exceed"), chunk_rows=100)
    return out


def test_long_native_frames_equal_the_other_engine(spark):
    native, halo = ({(r.entity_id, r.ts): r.asDict() for r in _features(spark, e).collect()} for e in ("native", "halo"))
    assert native.keys() == halo.keys() and len(native) == 892
    for key, row in native.items():
        assert all(same(value, halo[key][name], 1e-8) for name, value in row.items()), (key, row, halo[key])


def test_a_spike_leaves_the_frames_whole(spark):
    """Frames behind the spike of entity 1 hold one value again: exactly its mean, no deviation."""
    rows = [r for r in _features(spark, "native", 1e15).where("entity_id = 1").orderBy("ts").collect()]
    for i in range(400, 430):  # rows 300 to 429 are 3.7
        assert same(rows[i].v__mean_c, 3.7, 1e-12) and abs(rows[i].v__std_c) < 1e-9 and rows[i].v__exceed_c == 0.0
    assert rows[179].v__mean_b > 1e13 and rows[180].v__mean_b < 10 and rows[219].v__mean_c > 1e12 and rows[220].v__mean_c < 10


def test_no_long_frame_is_added_up_row_by_row(spark):
    plan = _features(spark, "native")._jdf.queryExecution().executedPlan().toString()
    assert "RowFrame, -4, currentrow" in plan
    assert "RowFrame, -59, currentrow" not in plan and "RowFrame, -99, currentrow" not in plan


def test_rows_that_are_not_wanted_only_fill_the_frames(spark):
    """Wanted rows at the end, in the middle and in no place of a chunk: the values are those of a full run."""
    rng = random.Random(3)
    rows = [(e, i / 6, rng.choice([None, rng.uniform(0, 10), 4.0]), rng.uniform(-1, 1)) for e, n in ((1, 333), (2, 90), (None, 40)) for i in range(n)]
    base = spark.createDataFrame(BASE, "entity_id int, sensor string, mean double, p90 double")
    filled = fill_forward(telemetry(spark, rows, "v double, u double"), ["entity_id"], "ts", ["v", "u"], number="row_no")
    windows = {"a": 1, "b": 6, "c": 40, "d": 100}
    whole = {(r.entity_id, r.ts): r for r in rolling_over(filled, ["v", "u"], base, windows=windows, chunk_rows=100).collect()}
    for r in whole.values():  # frames that are sorted for the percentile, and those looked up
        own = sorted((k[1], x) for k, x in whole.items() if k[0] == r.entity_id)
        place = [t for t, _ in own].index(r.ts)
        for name, w in windows.items():
            if place + 1 >= max(1, w // 3):
                frame = [x.v__mean_a for _, x in own[max(0, place - w + 1):place + 1]]
                assert same(r[f"v__p95_{name}"], quantile(frame, 0.95), 1e-9)
    flag = F.when(F.col("entity_id") == 2, None).otherwise((F.col("row_no") % 150).between(20, 60) | (F.col("row_no") == 90))
    some = rolling_over(filled.withColumn("_some", flag), ["v", "u"], base, windows=windows, chunk_rows=100, wanted="_some").collect()
    assert {r.entity_id for r in some} == {1, None} and len(some) == 41 * 2 + 14 + 1 + 21
    for r in some:
        assert all(same(x, y, 1e-8) for x, y in zip(r, whole[(r.entity_id, r.ts)]))


def test_an_increment_computes_no_features_of_its_context(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(nightly, "rolling_over", lambda *a, f=rolling_over, **k: asked.append(f(*a, **k)) or asked[-1])
    base = spark.createDataFrame(BASE, "entity_id int, sensor string, mean double, p90 double")
    context = spark.createDataFrame([], nightly.context_schema(["v"]))
    rows = [(1, float(h), float(h % 5)) for h in range(30)]
    for part in (rows[:20], rows[20:]):
        added, context = nightly.update_features(telemetry(spark, part), context, ["v"], base, windows={"a": 10})
        context = spark.createDataFrame(context.collect(), context.schema)
    assert asked[-1].count() == added.count() == 10 and context.count() == 9
