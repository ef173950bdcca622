"""Hours since the last fault on a stream: late rows, faults behind readings, a restart."""

import random


from leadtime import config
from leadtime.plans.lineage import fresh_path
from leadtime.streaming import jobs, since
from tests.helpers import at

FAMILIES = [config.Family("yaw_cable", 4, 2, 2, 1), config.Family("generator", 4, 2, 2, 1)]
SCHEMA = "entity_id int, event_ts timestamp, family string"


def _run(spark, batches, folder, out, progress, minutes=10):
    since.keyed_state(spark)
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).repartition(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    jobs.run_to_table(since.hours_since_stream(stream, FAMILIES, minutes=minutes), out, progress)
    found = spark.read.parquet(out).collect()
    assert len(found) == len({(r.entity_id, r.ts, r.family) for r in found})
    return {(r.entity_id, r.ts, r.family): round(r.hours_since, 6) for r in found}


def _expected(rows):
    bucket = lambda t: t.replace(minute=t.minute - t.minute % 10, second=0, microsecond=0)
    readings = {(e, bucket(t)) for e, t, _ in rows if e is not None}
    out = {}
    for e, t in readings:
        for f in FAMILIES:
            before = [bucket(x) for k, x, name in rows if k == e and name == f.name and bucket(x) <= t]
            out[e, t, f.name] = round((t - max(before)).total_seconds() / 3600, 6) if before else 8760.0
    return out


def test_a_reading_behind_a_newer_fault(spark):
    """The newer fault and the reading behind it come before the late ones."""
    path = [fresh_path(spark, n) for n in ("feed", "out", "progress")]
    first = [(1, at(1), "yaw_cable"), (1, at(5), None), (1, at(5.2), "yaw_cable"), (2, at(5), "generator")]
    late = [(1, at(4.6), None), (1, at(4.5), "yaw_cable"), (1, at(5.1), "generator"), (1, at(6), None), (None, at(99), None)]
    got = _run(spark, [first, late], *path)
    assert got == _expected(first + late) and got[1, at(5), "yaw_cable"] == 0.5 and got[1, at(6), "generator"] == 1.0


def test_a_restarted_query_goes_on(spark):
    """Each call is a query of its own that starts from the checkpoint of the one before."""
    rng = random.Random(3)
    rows = sorted((at(rng.uniform(0, 60)) for _ in range(300)))
    rows = [(rng.choice([1, 2, 3]), t, rng.choice([None, None, None, "yaw_cable", "generator", "other"])) for t in rows]
    parts = [rows[i:i + 60] for i in range(0, 300, 60)]
    for i in range(4):  # a fifth of the last rows comes with the next part
        near = [r for r in parts[i] if r[1] > max(t for _, t, _ in parts[i]) - (at(0.6) - at(0))]
        for r in near[::5]:
            parts[i].remove(r)
            parts[i + 1].append(r)
    path = [fresh_path(spark, n) for n in ("feed", "out", "progress")]
    got = {}
    for part in [*parts, [(None, at(999), None)]]:
        got = _run(spark, [part], *path)
    assert got == _expected(rows)


def test_state_stays_small():
    """Faults before the lateness shrink to the latest one, answered readings go."""
    class Value:
        def __init__(self):
            self.v = None
        exists = lambda self: self.v is not None
        get = lambda self: self.v

        def update(self, v):
            self.v = v

    class Map(dict):
        updateValue, containsKey, removeKey = dict.__setitem__, dict.__contains__, dict.__delitem__

    class Handle:
        timers = []
        getValueState = lambda self, *a: Value()
        getMapState = lambda self, *a: Map()
        registerTimer = lambda self, t: self.timers.append(t)

    class Time:
        def __init__(self, ms):
            self.ms = ms
        getCurrentWatermarkInMs = lambda self: self.ms

    p = since.SinceLast(600_000_000, 8760.0, ["e", "f"])
    p.init(Handle())
    step = 600_000_000
    list(p.handleInputRows((1, "x"), iter([{"at_us": i * step, "is_fault": i % 3 == 0} for i in range(30)]), None))
    out = list(p.handleExpiredTimer((1, "x"), Time(20 * 600_000), None))
    assert [(r.at_us // step, round(r.hours_since * 6)) for r in out] == [(i, i % 3) for i in range(20) if i % 3]
    assert p.latest.get() == (18 * step,) and sorted(k[0] // step for k in p.faults) == [21, 24, 27]
    assert sorted(k[0] // step for k in p.waiting) == [i for i in range(20, 30) if i % 3]
    assert not list(p.handleExpiredTimer((1, "x"), Time(20 * 600_000), None))


def test_a_key_sets_one_timer_for_a_batch():
    """Every timer is a call of the state and a call of Python: a reading has none of its own."""
    timers, calls = [], []

    class Value:
        exists = lambda self: hasattr(self, "v")
        get = lambda self: self.v
        update = lambda self, v: setattr(self, "v", v)

    class Map(dict):
        def updateValue(self, k, v):
            calls.append(k)
            self[k] = v
        containsKey = dict.__contains__

        def removeKey(self, k):
            calls.append(k)
            del self[k]

    class Handle:
        getValueState = lambda self, *a: Value()
        getMapState = lambda self, *a: Map()
        registerTimer = lambda self, t: timers.append(t)

    class Time:
        def __init__(self, ms):
            self.ms = ms
        getCurrentWatermarkInMs = lambda self: self.ms

    step = 600_000_000
    p = since.SinceLast(step, 8760.0, ["e", "f"])
    p.init(Handle())
    list(p.handleInputRows((1, "x"), iter([{"at_us": i * step, "is_fault": False} for i in range(1000)] * 2), None))
    assert timers == [600_000] and len(calls) == 1000
    out = [r.at_us // step for r in p.handleExpiredTimer((1, "x"), Time(990 * 600_000), None)]
    assert out == list(range(990)) and timers == [600_000, 991 * 600_000] and len(calls) == 1010
    assert not list(p.handleExpiredTimer((1, "x"), Time(990 * 600_000), None)) and len(timers) == 2
    out = [r.at_us // step for r in p.handleExpiredTimer((1, "x"), Time(2000 * 600_000), None)]
    assert out == list(range(990, 1000)) and not p.waiting and len(timers) == 2
