"""Chunked results equal whole-series results, and other invariants, on random small series."""

import hashlib
import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import at, faults, quantile, same, telemetry
from leadtime import config
from leadtime.operators import asof, diagnostics as dg, domain, evaluate as ev, faults as flt, nightly, report, review, splits
from leadtime.operators.baseline import series_p90
from leadtime.operators.rolling import rolling_features, smooth_centered
from leadtime.plans.lineage import materialize
from leadtime.plans.ranking import percentiles, with_slots
from leadtime.plans.series import fill_forward, interval_join, number_rows, previous_row, with_halo
from leadtime.sources import sinks

FEW = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
YAW = config.Family("yaw_cable", 5, 2, 2, 1)
GEN = config.Family("generator", 9, 3, 3, 1)


def series(seed, n=60, entities=(1, 2), missing=0.4):
    """Sorted (entity, hours, value) with gaps in time; entity 1 has most of the rows."""
    rnd = random.Random(seed)
    out = []
    for e in entities:
        hours = sorted(rnd.sample(range(n * 3), n if e == 1 else n // 4))
        out += [(e, h / 2, None if rnd.random() < missing else round(rnd.uniform(-50, 50), 2)) for h in hours]
    return out


def by_entity(rows):
    out = {}
    for e, h, v in sorted(rows, key=lambda r: r[:2]):
        out.setdefault(e, []).append((h, v))
    return out


@FEW
@given(st.integers(0, 10_000), st.sampled_from([0.2, 0.7, 3, 400]))
def test_numbering_filling_and_lag(spark, seed, days):
    rows = series(seed)
    shuffled = random.Random(seed).sample(rows, len(rows))
    tel = telemetry(spark, shuffled)
    num = {(r.entity_id, r.ts): r for r in number_rows(tel, ["entity_id"], "ts", days=days, total="n").collect()}
    fill = {(r.entity_id, r.ts): r for r in fill_forward(tel, ["entity_id"], "ts", ["v"], days=days, number="k").collect()}
    prev = {(r.entity_id, r.ts): r for r in previous_row(tel, ["entity_id"], "ts", ["v", "ts"], days=days).collect()}
    assert len(num) == len(fill) == len(prev) == len(rows)
    for e, items in by_entity(rows).items():
        last, before = 0.0, (None, None)
        for i, (h, v) in enumerate(items, 1):
            last = last if v is None else v
            key = (e, at(h))
            assert (num[key].row_no, num[key].n) == (i, len(items))
            assert fill[key].k == i and fill[key].v == last
            assert (prev[key].prev_v, prev[key].prev_ts) == before
            before = (v, at(h))


@FEW
@given(st.integers(0, 10_000), st.integers(1, 40), st.sampled_from(["halo", "native"]))
def test_chunked_rolling_equals_plain_loops(spark, seed, chunk, engine):
    rows = series(seed)
    windows = {"a": 2, "b": 7}
    base = spark.createDataFrame([(1, "v", -3.0, 10.0), (2, "v", 2.0, -5.0)],
                                 "entity_id int, sensor string, mean double, p90 double")
    got = {(r.entity_id, r.ts): r for r in rolling_features(
        telemetry(spark, rows), ["v"], base, windows=windows, engine=engine, chunk_rows=chunk).collect()}
    assert len(got) == len(rows)
    for e, items in by_entity(rows).items():
        limit, mean = {1: (10.0, -3.0), 2: (-5.0, 2.0)}[e]
        filled, last = [], 0.0
        for _, v in items:
            last = last if v is None else v
            filled.append(last)
        for i, (h, _) in enumerate(items):
            r = got[(e, at(h))]
            for name, w in windows.items():
                frame = filled[max(0, i - w + 1):i + 1]
                ready = i + 1 >= max(1, w // 3)
                want = (statistics.fmean(frame), quantile(frame, 0.95), sum(x > limit for x in frame) / len(frame))
                assert [same(r[f"v__{k}_{name}"], x if ready else None, 1e-7)
                        for k, x in zip(("mean", "p95", "exceed"), want)] == [True] * 3
                std = statistics.stdev(frame) if ready and len(frame) > 1 else 0.0
                assert same(r[f"v__std_{name}"], std, 1e-6)
            assert same(r["v__baseline_ratio"], statistics.fmean(filled[max(0, i - 6):i + 1]) / abs(mean)
                        if i + 1 >= 2 else None, 1e-7)


@FEW
@given(st.integers(0, 10_000), st.sampled_from([0.1, 1, 50]))
def test_labels_equal_plain_loops(spark, seed, days):
    rnd = random.Random(seed)
    rows = series(seed, missing=0)
    fl = [(e, rnd.randrange(0, 180) / 2, f) for e in (1, 2) for f in ("yaw_cable", "generator") for _ in range(6)]
    tel, log, fams = telemetry(spark, rows), faults(spark, fl), [YAW, GEN]
    near, last = ({(r.entity_id, r.ts): r for r in asof.label_hours_to_fault(
        tel, log, fams, mode=m, exclude_after_hours=1.5, days=days).collect()} for m in ("nearest", "last"))
    since = {(r.entity_id, r.ts): r for r in asof.hours_since_last(tel, log, fams, days=days).collect()}
    assert len(near) == len(rows)
    for e, h, _ in rows:
        for f in fams:
            times = sorted(x for e2, x, name in fl if e2 == e and name == f.name)
            ahead = [x - h for x in times if x > h]
            past = [h - x for x in times if x <= h]
            inside = [x for x in ahead if x <= f.lead_hours]
            n, c, key = near[(e, at(h))], last[(e, at(h))], (e, at(h))
            assert same(n[f"hours_to_{f.name}"], inside[0] if inside else None)
            assert same(c[f"hours_to_{f.name}"], inside[-1] if inside else float(f.lead_hours))
            assert n[f"is_pre_{f.name}"] == c[f"is_pre_{f.name}"] == bool(inside)
            assert n[f"excluded_{f.name}"] == (bool(past) and min(past) < 1.5)
            want = min(past) if past else (8760.0 if ahead else 9999.0)
            assert same(since[key][f"hours_since_last_{f.name}"], want)
            if inside:  # the nearest fault is never later than the latest covering one
                assert n[f"hours_to_{f.name}"] <= c[f"hours_to_{f.name}"]


@FEW
@given(st.integers(0, 10_000))
def test_no_feature_looks_ahead(spark, seed):
    rows = series(seed)
    cut = sorted(h for e, h, _ in rows if e == 1)[30]
    changed = [(e, h, v if h <= cut else 999.0) for e, h, v in rows]
    base = spark.createDataFrame([], "entity_id int, sensor string, mean double, p90 double")
    step = [domain.Step("d", "v", 6)]

    def run(data):
        tel = telemetry(spark, data)
        feats = rolling_features(tel, ["v"], base, windows={"a": 5}, chunk_rows=8)
        steps = domain.add_steps(tel, step, chunk_rows=8).select("entity_id", "ts", "d")
        return sorted(tuple(map(str, r)) for r in feats.join(steps, ["entity_id", "ts"])
                      .where(F.col("ts") <= F.lit(at(cut))).collect())
    assert run(rows) == run(changed)


@FEW
@given(st.lists(st.one_of(st.floats(-1e6, 1e6, allow_nan=False, allow_subnormal=False),
                          st.sampled_from([0.0, 1.0, -1.0])), min_size=1, max_size=60))
def test_percentiles(spark, values):
    df = spark.createDataFrame([("a", v) for v in values] + [("a", None)], "g string, v double")
    got = percentiles(df, ["g"], "v", {"lo": 0.05, "mid": 0.5, "hi": 0.9}).first()
    for name, q in (("lo", 0.05), ("mid", 0.5), ("hi", 0.9)):
        assert same(got[name], quantile(values, q), 1e-9)


@FEW
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=2, max_size=80))
def test_slots_keep_order(spark, values):
    df = materialize(spark.createDataFrame([(1, v) for v in sorted(set(values))], "g int, v double"))
    slots = [r["_slot"] for r in with_slots(df, ["g"], "v", slots=8).orderBy("v").collect()]
    assert slots == sorted(slots)


def test_slots_share_a_narrow_band_and_a_skewed_group(spark):
    """No slot holds more than a few times its share, wherever the values lie."""
    rnd = random.Random(3)
    rows = ([("mains", 50 + rnd.gauss(0, 0.05)) for _ in range(4000)] + [("factor", 1 - 10 ** rnd.uniform(-9, -2)) for _ in range(4000)]
            + [("skewed", rnd.expovariate(1) ** 6) for _ in range(4000)] + [("both", rnd.choice((-1, 1)) * rnd.random()) for _ in range(4000)])
    counts = materialize(spark.createDataFrame(rows, "g string, v double").distinct())
    sizes = with_slots(counts, ["g"], "v", slots=32).groupBy("g", "_slot").count().collect()
    assert max(r["count"] for r in sizes) <= 3 * 4000 / 32 and len(sizes) >= 4 * 30


def test_percentiles_skip_nan(spark):
    df = spark.createDataFrame([(v,) for v in (0.1, 0.2, 0.3, 10.0, 20.0, float("nan"))], "v double")
    assert same(percentiles(df, [], "v", {"mid": 0.5}).first().mid, 0.3)


@FEW
@given(st.integers(0, 10_000))
def test_auc_and_curve(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice([0.0, 0.25, 0.5, round(rnd.random(), 2)]), rnd.random() < 0.4) for _ in range(50)] + [(0.3, True), (0.3, False)]
    df = spark.createDataFrame([("x", s, y) for s, y in rows], "family string, s double, y boolean")
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert same(dg.auc(df, "s", F.col("y"), ["family"]).first().auc, wins / (len(pos) * len(neg)))
    for r in dg.pr_curve(df, "s", F.col("y")).collect():
        assert (r.tp, r.fp) == (sum(p >= r.threshold for p in pos), sum(n >= r.threshold for n in neg))


@FEW
@given(st.integers(0, 10_000))
def test_sweep_equals_plain_loops(spark, seed):
    rnd = random.Random(seed)
    preds = [(e, "yaw_cable", h / 2, float(rnd.randrange(0, 40)) / 2) for e in (1, 2) for h in sorted(rnd.sample(range(200), 60))]
    events = [(e, float(h), "yaw_cable") for e in (1, 2) for h in (10, 31, 60, 85)]
    p = spark.createDataFrame([(e, f, at(h), v) for e, f, h, v in preds], "entity_id int, family string, ts timestamp, pred_h double")
    floors = spark.createDataFrame([("yaw_cable", 3)], "family string, floor_h int")
    for r in review.threshold_sweep(p, faults(spark, events), floors, ceiling=22, step=3, match_hours=12).collect():
        alerts = [(e, h) for e, _, h, v in preds if v < r.threshold]
        leads = []
        for e, x, _ in events:
            prior = [h for e2, h in alerts if e2 == e and h < x and x - h <= 12]
            leads += [x - min(prior)] if prior else []
        hits = sum(any(e2 == e and 0 <= x - h <= 12 for e2, x, _ in events) for e, h in alerts)
        assert (r.n_alerts, r.tp_events, r.n_events) == (len(alerts), len(leads), len(events))
        assert same(r.recall, len(leads) / len(events))
        assert same(r.precision, hits / len(alerts) if alerts else None)
        assert same(r.avg_lead_h, sum(leads) / len(leads) if leads else None)


@FEW
@given(st.integers(0, 10_000), st.sampled_from([1, 2, 5, 8]), st.integers(1, 30))
def test_smoothing(spark, seed, n, chunk):
    rows = series(seed, missing=0)
    got = {(r.entity_id, r.ts): r.smoothed for r in smooth_centered(telemetry(spark, rows), "v", n, chunk_rows=chunk).collect()}
    for e, items in by_entity(rows).items():
        vals = [v for _, v in items]
        wide = vals[::-1] + vals + vals[::-1]
        for i, (h, _) in enumerate(items):
            j = len(vals) + i - n // 2
            assert same(got[(e, at(h))], sum(wide[j:j + n]) / n, 1e-9)


def test_split_partitions_rows(spark):
    rows = [(1, h, 0.0) for h in range(50)] + [(2, 100_000 + h, 0.0) for h in range(10)]
    tel = telemetry(spark, rows).withColumn("source", F.col("entity_id").cast("string"))
    got = splits.temporal_split(tel).groupBy("source", "split").count().collect()
    assert {(r.source, r.split): r["count"] for r in got} == {
        ("1", "train"): 30, ("1", "val"): 10, ("1", "test"): 10, ("2", "train"): 6, ("2", "val"): 2, ("2", "test"): 2}


@pytest.mark.parametrize("parts", [(20,), (1, 2, 40), (25, 45)])
def test_increments_equal_one_run(spark, parts):
    """Whatever the cuts, and with a sensor silent for longer than the context."""
    rows = [(e, h, None if e == 2 and h > 2 else v) for e, h, v in series(11, n=60)]
    base = spark.createDataFrame([(1, "v", 2.0, 5.0), (2, "v", 1.0, 0.0)], "entity_id int, sensor string, mean double, p90 double")
    windows = {"a": 3, "b": 9}
    whole = rolling_features(telemetry(spark, rows), ["v"], base, windows=windows, chunk_rows=10)
    context = spark.createDataFrame([], nightly.context_schema(["v"]))
    edges = [-1.0, *[float(p) for p in parts], 1e6]
    total = None
    for lo, hi in zip(edges, edges[1:]):
        new = telemetry(spark, [r for r in rows if lo < r[1] <= hi])
        feats, context = nightly.update_features(new, context, ["v"], base, windows=windows, chunk_rows=10)
        total = feats if total is None else total.unionByName(feats)
    names = [c for c in whole.columns if c not in ("entity_id", "ts")]

    def table(df):
        return sorted((r.entity_id, r.ts, *[None if r[c] is None else round(r[c], 6) for c in names]) for r in df.collect())
    a, b = table(whole), table(total)
    assert [x[:2] for x in a] == [x[:2] for x in b] and all(same(p, q, 1e-5) for x, y in zip(a, b) for p, q in zip(x[2:], y[2:]))


def test_late_rows_do_not_change_the_store(spark):
    base = spark.createDataFrame([], "entity_id int, sensor string, mean double, p90 double")
    context = spark.createDataFrame([], nightly.context_schema(["v"]))
    _, context = nightly.update_features(telemetry(spark, [(1, 5, 1.0)]), context, ["v"], base, windows={"a": 3})
    feats, _ = nightly.update_features(telemetry(spark, [(1, 4, 9.0), (1, 6, 2.0)]), context, ["v"], base, windows={"a": 3})
    assert [r.ts for r in feats.collect()] == [at(6)]


def test_halo_copies_are_bounded(spark):
    rows = spark.range(1, 1001).select(F.lit(1).alias("entity_id"), F.col("id").alias("row_no"))
    sizes = with_halo(rows, before=30, after=5, chunk_rows=100).groupBy("chunk").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("own").alias("own"))
    assert all(r.n <= 135 and r.own <= 100 for r in sizes.collect())
    assert sizes.agg(F.sum("own")).first()[0] == 1000


@FEW
@given(st.integers(0, 10_000), st.sampled_from([1.0, 4.0, 30.0]))
def test_interval_join(spark, seed, slice_hours):
    rnd = random.Random(seed)
    pts = [(1, float(h)) for h in range(0, 60, 3)]
    spans = [(1, float(a), float(a + rnd.randrange(0, 12))) for a in rnd.sample(range(60), 8)]
    p = spark.createDataFrame([(e, at(h)) for e, h in pts], "entity_id int, ts timestamp")
    s = spark.createDataFrame([(e, at(a), at(b)) for e, a, b in spans], "entity_id int, a timestamp, b timestamp")
    for closed in (False, True):
        got = sorted((r.ts, r.a, r.b) for r in interval_join(
            p, s, ["entity_id"], "ts", "a", "b", hours=slice_hours, include_end=closed).collect())
        want = sorted((at(h), at(a), at(b)) for _, h in pts for _, a, b in spans if a <= h and (h <= b if closed else h < b))
        assert got == want


def test_sample_is_stable_and_whole_when_small(spark):
    df = spark.range(3000).select(F.lit("a").alias("family"), F.col("id").alias("k")).unionByName(
        spark.range(7).select(F.lit("b").alias("family"), F.col("id").alias("k")))
    first = report.sample_rows(df, 50, ["k"]).collect()
    again = report.sample_rows(df.repartition(5), 50, ["k"]).collect()
    assert sorted(first) == sorted(again)
    assert sum(r.family == "a" for r in first) == 50 and sum(r.family == "b" for r in first) == 7


@pytest.mark.parametrize("n", [1, 700, 2000, 5000])
def test_sample_has_the_smallest_hashes(spark, n):
    """Of any size, for a group without a name, too, and with a key that comes three times."""
    sizes = {"a": 3000, None: 40}
    rows = [(g, k) for g, size in sizes.items() for k in range(size)] + [("a", 5), ("a", 5)]
    got = report.sample_rows(spark.createDataFrame(rows, "family string, k int"), n, ["k"]).collect()
    for g in sizes:
        want = sorted((hashlib.md5(f"{k}|42".encode()).hexdigest(), k) for f, k in rows if f == g)[:n]
        assert sorted(r.k for r in got if r.family == g) == sorted(k for _, k in want)


def test_distinct_on_order(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (2, 5, "x")], "k int, t int, v string")
    assert {r.k: r.v for r in sinks.distinct_on(df, ["k"], ["t"]).collect()} == {1: "a", 2: "x"}
    assert {r.k: r.v for r in sinks.distinct_on(df, ["k"], ["t"], "last").collect()} == {1: "c", 2: "x"}


def test_series_fallback_threshold(spark):
    tel = telemetry(spark, [(1, i, float(i)) for i in range(11)])
    assert series_p90(tel, ["v"]).first().p90 == 9.0


def test_donor_faults_only_where_own_are_missing(spark):
    own = faults(spark, [(2, 1, "generator")])
    donor = faults(spark, [(1, 2, "generator"), (1, 3, "yaw_cable")])
    targets = spark.createDataFrame([(2, 1)], "entity_id int, donor_id int")
    got = {(r.family, r.origin) for r in flt.with_donor_faults(own, donor, targets).collect()}
    assert got == {("generator", "own"), ("yaw_cable", "donor")}


def test_event_starts_across_blocks(spark):
    flags = [0, 1, 1, 0, 1, 1]
    df = spark.createDataFrame([(1, "x", at(24 * 40 * i), bool(f)) for i, f in enumerate(flags)],
                               "entity_id int, family string, ts timestamp, is_pre boolean")
    assert sorted(r.event_start for r in ev.event_starts(df).collect()) == [at(24 * 40), at(24 * 160)]
