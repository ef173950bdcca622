"""Hand-computed cases."""

import datetime as dt
import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from helpers import at, faults, same, telemetry
from leadtime import config
from leadtime.functions import scalars as S
from leadtime.functions.headers import clean_header, normalize_columns
from leadtime.operators import asof, clean, diagnostics as dg, domain, evaluate as ev, faults as flt, models, report, review
from leadtime.operators.baseline import baseline
from leadtime.operators.rolling import feature_names, rolling_features, smooth_centered
from leadtime.sources import files, sinks

YAW = config.Family("yaw_cable", 4, 2, 2, 24)


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


@pytest.mark.parametrize("raw, want", [
    ('# Date and time,"Wind speed, sensor 1 (m/s)",Power (kW)', "timestamp,wind_speed_sensor_1_ms,power_kw"),
    ('#Date and time,"A, b, c",_x__y_', "timestamp,a_b_c,x_y"),
    ("Date and time,Vane position 1+2 (°)", "timestamp,vane_position_12"),
])
def test_header(spark, raw, want):
    assert one(spark, clean_header(F.lit(raw))) == want


def test_header_keeps_case_on_request(spark):
    assert one(spark, clean_header(F.lit("# Date and time,Power (kW)"), lower=False)) == "Date_and_time,Power_kW"
    df = spark.range(1).select(F.lit(1).alias("# Date and time"), F.lit(2).alias("Power, max (kW)"))
    assert normalize_columns(df).columns == ["timestamp", "power_max_kw"]


def test_angle(spark):
    assert one(spark, S.angle_error(F.lit(350.0), F.lit(10.0))) == 20
    assert one(spark, S.angle_error(F.lit(10.0), F.lit(350.0))) == 20
    assert one(spark, S.angle_error(F.lit(0.0), F.lit(180.0))) == 180


def test_row_statistics(spark):
    cols = [F.lit(1.0), F.lit(None).cast("double"), F.lit(4.0)]
    assert one(spark, S.row_spread(cols)) == 3
    assert one(spark, S.row_mean(cols)) == 2.5
    assert same(one(spark, S.row_std(cols)), 2.1213203435596424)
    alone = [F.lit(1.0), F.lit(None).cast("double")]
    assert one(spark, S.row_std(alone)) is None


def test_shift(spark):
    assert one(spark, S.shift_years(F.lit(dt.datetime(2020, 2, 29)), 8)) == dt.datetime(2028, 2, 29)
    assert one(spark, S.shift_year_text(F.lit("2018-03-04 05:06:07"), 8)) == "2026-03-04 05:06:07"
    assert one(spark, S.shift_year_text(F.lit("-"), 8)) == "-"
    assert one(spark, S.parse_ts(F.lit("-"))) is None


@pytest.mark.parametrize("engine", ["native", "halo"])
def test_rolling(spark, engine):
    tel = telemetry(spark, [(1, i / 6, v) for i, v in enumerate([1.0, 2.0, None, 4.0])])
    base = spark.createDataFrame([(1, "v", 2.0, 1.5)], "entity_id int, sensor string, mean double, p90 double")
    out = rolling_features(tel, ["v"], base, windows={"1h": 6}, engine=engine).orderBy("ts").collect()
    want = {"mean": [None, 1.5, 5 / 3, 2.25], "std": [0, 0.5 ** 0.5, 0.5773502691896258, 1.2583057392117916],
            "p95": [None, 1.95, 2.0, 3.7], "exceed": [None, 0.5, 2 / 3, 0.75]}
    for stat, values in want.items():
        for row, v in zip(out, values):
            assert same(row[f"v__{stat}_1h"], v), (stat, row)
    assert same(out[3]["v__baseline_ratio"], 2.25 / 2)


@pytest.mark.parametrize("engine", ["native", "halo"])
def test_baseline_edge_values(spark, engine):
    tel = telemetry(spark, [(e, i / 6, 1.0, 1.0) for e in (1, 2) for i in range(4)], "a double, b double")
    base = spark.createDataFrame([(1, "a", 0.0, None)], "entity_id int, sensor string, mean double, p90 double")
    out = {r.entity_id: r for r in rolling_features(tel, ["a", "b"], base, windows={"1h": 6}, engine=engine)
           .where(F.col("ts") == F.lit(at(0.5))).collect()}
    assert out[1]["a__baseline_ratio"] is None          # mean of about 0
    assert same(out[1]["b__baseline_ratio"], 1.0)       # no baseline: divided by 1
    assert out[1]["a__exceed_1h"] is None and same(out[2]["a__baseline_ratio"], 1.0)


def test_feature_names():
    names = feature_names(["x"])
    assert len(names) == 17 and names[0] == "x__mean_1h" and names[-1] == "x__baseline_ratio"
    assert sum(len(v) for v in config.FAMILY_SENSORS.values()) == 61
    assert len({s for v in config.FAMILY_SENSORS.values() for s in v}) == 56
    assert len(config.SILVER_COLUMNS) == 47


LABEL_TIMES = [5 + 59 / 60, 8, 9, 10]


def _labels(spark, mode, exclude=None):
    tel = telemetry(spark, [(1, h, 0.0) for h in LABEL_TIMES])
    return asof.label_hours_to_fault(tel, faults(spark, [(1, 10, "yaw_cable"), (1, 12, "yaw_cable")]), [YAW],
                                     mode=mode, exclude_after_hours=exclude).orderBy("ts").collect()


def test_label_nearest(spark):
    rows = _labels(spark, "nearest")
    assert [r.hours_to_yaw_cable for r in rows] == [None, 2, 1, 2]
    assert [r.is_pre_yaw_cable for r in rows] == [False, True, True, True]


def test_label_last(spark):
    rows = _labels(spark, "last", 24)
    assert [r.hours_to_yaw_cable for r in rows] == [4, 4, 3, 2]
    assert [r.is_pre_yaw_cable for r in rows] == [False, True, True, True]
    assert [r.excluded_yaw_cable for r in rows] == [False, False, False, True]


def test_hours_since(spark):
    tel = telemetry(spark, [(1, h, 0.0) for h in (10 - 1 / 6, 10, 11.5)] + [(2, 1, 0.0)])
    rows = asof.hours_since_last(tel, faults(spark, [(1, 10, "yaw_cable")]), [YAW]).orderBy("entity_id", "ts").collect()
    assert [r.hours_since_last_yaw_cable for r in rows] == [8760, 0, 1.5, 9999]


def test_cluster_gap(spark):
    rows = flt.cluster_events(faults(spark, [(1, h, "generator") for h in (0, 24, 49)]), 24).orderBy("ts").collect()
    assert [r.ts for r in rows] == [at(0), at(49)]


def _status(spark, rows):
    return spark.createDataFrame([(1, at(m / 60), i, c, "Stop", f"m{c}") for i, (m, c) in enumerate(rows)],
                                 "entity_id int, event_ts timestamp, event_id long, code int, status string, message string")


def test_bucket_dedup(spark):
    out = flt.first_per_bucket(_status(spark, [(1, 7), (9, 7), (10, 7)])).orderBy("event_ts").collect()
    assert [r.event_ts for r in out] == [at(1 / 60), at(10 / 60)]


def test_group_faults(spark):
    rows = _status(spark, [(3, 717), (1, 716), (2, 716)]).withColumns(
        {"ts": S.floor_ts("event_ts"), "family": F.lit("pitch_bat")})
    out = flt.group_faults(rows).first()
    assert (out.codes, out.messages, out.n_events) == ("716,717", "m716 | m717", 3)


def test_first_family_wins_and_other(spark):
    catalog = config.code_table(spark, {"a": (1, 2), "b": (2, 3)})
    out = flt.map_family(spark.createDataFrame([(2,), (3,), (9,), (None,)], "code int"), catalog, other="other")
    assert [r.family for r in out.collect()] == ["a", "b", "other", "other"]


def _sweep(spark, thresholds):
    preds = spark.createDataFrame([(1, "yaw_cable", at(24 * d), float(p)) for d, p in ((0, 50), (1, 30), (2, 40), (3, 20))],
                                  "entity_id int, family string, ts timestamp, pred_h double")
    events = faults(spark, [(1, 96, "yaw_cable")])
    floors = spark.createDataFrame([("yaw_cable", thresholds[0])], "family string, floor_h int")
    return review.threshold_sweep(preds, events, floors, ceiling=thresholds[-1], step=5)


def test_sweep(spark):
    rows = {r.threshold: r for r in _sweep(spark, (20, 60)).collect()}
    assert rows[20].n_alerts == 0 and rows[20].recall == 0 and rows[20].precision is None
    r35 = rows[35]
    assert (r35.n_alerts, r35.recall, r35.precision, r35.avg_lead_h) == (2, 1, 1, 72)
    assert rows[55].avg_lead_h == 96 and rows[55].n_alerts == 4


@pytest.mark.parametrize("full_from, floor, want, reason", [
    (34, 24, 34, "data"), (10, 24, 24, "operational floor"), (None, 24, None, "no threshold reaches full recall")])
def test_recommendation(spark, full_from, floor, want, reason):
    rows = [("x", t, 1.0 if full_from and t >= full_from else 0.5) for t in range(8, 60, 2)]
    sweep = spark.createDataFrame(rows, "family string, threshold int, recall double")
    floors = spark.createDataFrame([("x", floor)], "family string, floor_h int")
    out = review.recommend_threshold(sweep, floors).first()
    assert (out.recommended, out.reason) == (want, reason)


def test_isotonic(spark):
    pts = spark.createDataFrame([(1.0, 10.0), (1.0, 20.0), (2.0, 5.0), (3.0, 30.0), (4.0, 28.0)], "raw_h double, hours_to double")
    curve = models.fit_calibration(pts)
    ask = spark.createDataFrame([(x,) for x in (0.0, 1.0, 2.0, 2.5, 3.0, 4.0, 9.0)], "raw_h double")
    got = [r.pred_h for r in curve.transform(ask).orderBy("raw_h").collect()]
    for a, b in zip(got, (35 / 3, 35 / 3, 35 / 3, 20.333333333333332, 29, 29, 29)):
        assert same(a, b, 1e-6)


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string")
    for keep, want in (("last", {1: "b", 2: "c"}), ("first", {1: "a", 2: "c"})):
        once = sinks.upsert(old, new, ["k"], keep)
        twice = sinks.upsert(once, new, ["k"], keep)
        assert {r.k: r.v for r in once.collect()} == want == {r.k: r.v for r in twice.collect()}


def test_upsert_new_column_and_null_key(spark):
    old = spark.createDataFrame([(1, "a"), (None, "z")], "k int, v string")
    new = spark.createDataFrame([(1, None, 5)], "k int, v string, w int")
    out = {r.k: (r.v, r.w) for r in sinks.upsert(old, new, ["k"]).collect()}
    assert out == {1: (None, 5), None: ("z", None)}


def test_reliability_bins(spark):
    df = spark.createDataFrame([(p, True) for p in (0.0, 0.1, 0.1001, 1.0)], "p double, y boolean")
    got = {r.bin: r.n for r in dg.reliability(df.withColumn("family", F.lit("x")), "p", F.col("y")).collect()}
    assert got == {1: 2, 2: 1, 10: 1}


def test_auc_with_ties_and_empty_class(spark):
    df = spark.createDataFrame([("a", 1.0, False), ("a", 1.0, True), ("a", 2.0, True), ("b", 1.0, True)],
                               "g string, s double, y boolean")
    got = {r.g: r.auc for r in dg.auc(df, "s", F.col("y"), ["g"]).collect()}
    assert got["a"] == 0.75 and got["b"] is None


def test_null_profile_classes(spark):
    df = spark.createDataFrame([(None if i < 2 else 1.0, float("nan"), 1.0, None if i < 9 else 1.0) for i in range(10)],
                               "a double, b double, c double, d double")
    got = {r.column_name: (r.n_missing, r.null_class) for r in clean.null_profile(df, df.columns).collect()}
    assert got == {"a": (2, "10 to 40"), "b": (10, "empty"), "c": (0, "none"), "d": (9, "over 40")}


def test_event_recall_details(spark):
    rows = [(1, "yaw_cable", at(h), h in (1, 2, 6), p) for h, p in ((0, 9.0), (1, 5.0), (2, 1.0), (3, 9.0), (6, 7.0))]
    scored = spark.createDataFrame(rows, "entity_id int, family string, ts timestamp, is_pre boolean, pred_h double")
    events = ev.event_windows(scored, F.lit(4.0), 4).orderBy("event_start").collect()
    assert [(r.event_start, r.best_score) for r in events] == [(at(1), 1.0), (at(6), 7.0)]


def test_label_event_count(spark):
    rows = [(1, "x", at(h), hours is not None, hours) for h, hours in enumerate([3.0, 2.0, 1.0, None, 3.0, 2.0])]
    df = spark.createDataFrame(rows, "entity_id int, family string, ts timestamp, is_pre boolean, hours_to double")
    assert ev.count_label_events(df).first().n_events == 2
    assert ev.count_label_events(df.withColumn("is_pre", F.lit(False))).first().n_events == 0


def test_winner_rules(spark):
    cand = spark.createDataFrame([("a", "target", 0.5), ("a", "donor+target", 0.5), ("b", "target", 0.7),
                                  ("b", "donor+target", 0.6), ("c", "target", 0.1)], "family string, source string, f1_ep double")
    got = {r.family: (r.source, r.reason) for r in ev.pick_winner(cand).collect()}
    assert got == {"a": ("donor+target", "tie, more training data"), "b": ("target", "best f1_ep"),
                   "c": ("target", "only candidate")}


def test_threshold_default(spark):
    curve = spark.createDataFrame([("x", 0.5, 0.05, 1.0)], "family string, threshold double, precision double, recall double")
    assert dg.choose_threshold(curve).first().threshold == 0.20
    assert dg.best_precision(curve, 1.1).first().max_precision == 0


def test_timeline_emits_empty_bins(spark):
    rows = spark.createDataFrame([(1, "x", at(1), True, 2.0), (1, "x", at(14), False, 4.0)],
                                 "entity_id int, family string, ts timestamp, is_pre boolean, pred_h double")
    out = report.alert_timeline(rows, F.lit(4.0)).orderBy("bin").collect()
    assert [(r.bin, r.alert_score, r.is_pre) for r in out] == [(at(0), 0.5, 1), (at(6), None, None), (at(12), 0.0, 0)]


def test_weekly_label_is_sunday(spark):
    rows = spark.createDataFrame([("x", at(0), True)], "family string, ts timestamp, is_pre boolean")  # a Monday
    assert report.weekly_share(rows).first().week == dt.datetime(2024, 1, 7)


def test_centered_average_mirrors_edges(spark):
    tel = telemetry(spark, [(1, i, float(v)) for i, v in enumerate([1, 2, 4, 8, 16])])
    for n, want in ((3, [4 / 3, 7 / 3, 14 / 3, 28 / 3, 40 / 3]), (2, [1, 1.5, 3, 6, 12]), (1, [1, 2, 4, 8, 16])):
        for chunk in (2, 100):
            got = [r.smoothed for r in smooth_centered(tel, "v", n, chunk_rows=chunk).orderBy("ts").collect()]
            assert all(same(a, b) for a, b in zip(got, want)), (n, chunk, got)


def test_consecutive_rule(spark):
    tel = telemetry(spark, [(1, i, float(v)) for i, v in enumerate([2, 2, 0, 2, 2, 2, 2])])
    got = [r.confirmed for r in domain.confirm_consecutive(tel, F.col("v") > 1.5, 3, chunk_rows=3).orderBy("ts").collect()]
    assert got == [False] * 5 + [True, True]


def test_steps(spark):
    tel = telemetry(spark, [(1, i, v) for i, v in enumerate([5.0, 3.0, None, 4.0, 6.0])])
    steps = [domain.Step("rate", "v", 1, fill=0.0), domain.Step("up", "v", 1, fill=0.0, floor=0.0), domain.Step("two", "v", 2)]
    rows = domain.add_steps(tel, steps, chunk_rows=2).orderBy("ts").collect()
    assert [r.rate for r in rows] == [0, -2, 0, 0, 2]
    assert [r.up for r in rows] == [0, 0, 0, 0, 2]
    assert [r.two for r in rows] == [None, None, None, 1, None]


def test_baseline_period_and_interpolation(spark):
    tel = telemetry(spark, [(1, 24 * d, float(d)) for d in range(20)])
    row = baseline(tel, ["v"], days=10).first()
    assert (row["mean"], row["p90"], row["n_rows"]) == (4.5, 8.1, 10)


def test_missing_store_is_empty_and_broken_store_is_not(spark, tmp_path):
    assert files.read_or_empty(spark, str(tmp_path / "none"), "k int").count() == 0
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        files.read_or_empty(spark, str(bad), "k int").count()
    with pytest.raises(AnalysisException):
        files.read_or_empty(spark, str(bad), "k int", fmt="parquet").select("absent").count()


PREAMBLE = "".join(f"# line {i}\n" for i in range(1, 10))


def test_scada_files_with_drift(spark, tmp_path):
    for name, text in {
        "Turbine_Data_1_a.csv": PREAMBLE + "# Date and time,Power (kW)\n2018-01-01 00:00:00,1.5\n2018-01-01 00:10:00,NaN\n",
        "Turbine_Data_1_b.csv": PREAMBLE + '# Date and time,"Wind speed, x (m/s)",Power (kW)\n2019-01-01 00:00:00,3,2.5\n',
        "Turbine_Data_1_c.csv": "# Date and time,Power (kW)\n2020-01-01 00:00:00,9\n",
        "Turbine_Data_2_d.csv": PREAMBLE + "# Date and time,Power (kW)\n2021-01-01 00:00:00,7\n",
    }.items():
        folder = tmp_path / f"SCADA_20{18 + ord(name[-5]) - 97}_x"
        os.makedirs(folder, exist_ok=True)
        (folder / name).write_text(text)
    paths = files.yearly_globs(str(tmp_path), [2018, 2019, 2020], "SCADA_{year}_*", "Turbine_Data_1_*.csv")
    rows = files.read_scada(spark, paths, entity_from=r"Turbine_Data_(\d+)_").orderBy("timestamp").collect()
    assert [(r.entity_id, r.timestamp.year, r.power_kw, r.wind_speed_x_ms) for r in rows] == [
        (1, 2018, 1.5, None), (1, 2018, None, None), (1, 2019, 2.5, 3.0)]
    with pytest.raises(FileNotFoundError):
        files.read_scada(spark, [paths[2]])


def test_status_csv_skips_comments(spark, tmp_path):
    head = "Timestamp start,Timestamp end,Duration,Status,Code,Message,Comment,Service contract category,IEC category\n"
    (tmp_path / "s.csv").write_text("# x\n" + head + "2018-01-01 00:00:01,-,-,Stop,716,b,,c,i\n")
    row = files.read_status_events(spark, str(tmp_path / "s.csv")).first()
    assert (row.timestamp_start, row.timestamp_end, row.Code) == (dt.datetime(2018, 1, 1, 0, 0, 1), None, 716)


def test_dashboard_document(spark):
    keys = "entity_id int, family string"
    metrics = spark.createDataFrame([(1, "x", 0.5)], f"{keys}, precision double")
    lines = spark.createDataFrame([(1, "x", at(6), None), (1, "x", at(0), 1.0)], f"{keys}, bin timestamp, pred_h double")
    events = spark.createDataFrame([(1, "x", at(0), True)], f"{keys}, event_start timestamp, detected boolean")
    points = spark.createDataFrame([(1, "x", 1.0, 2.0)], f"{keys}, x double, y double")
    doc = json.loads(report.dashboard_documents(metrics, lines, events, points).first().document)
    assert doc["metrics"] == {"precision": 0.5} and [p["pred_h"] for p in doc["timeline"]] == [1.0, None]
    assert doc["events"][0]["detected"] is True and doc["scatter"] == [{"x": 1.0, "y": 2.0}]
