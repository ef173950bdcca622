"""Late entities, missing floors, lost keys, leaking targets, lost state: cases that the fixtures don't show."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from leadtime import config
from leadtime.operators import clean, models, nightly, review
from leadtime.plans import lineage
from leadtime.plans.series import number_rows
from leadtime.sources import sinks
from leadtime.streaming import jobs
from tests.helpers import at, faults, telemetry


def test_an_entity_owes_nothing_before_its_own_log(spark):
    preds = spark.createDataFrame([(1, "generator", at(h), 20.0) for h in range(0, 400, 2)]
                                  + [(2, "generator", at(h), 20.0) for h in range(300, 400, 2)], "entity_id int, family string, ts timestamp, pred_h double")
    log = faults(spark, [(1, 100, "generator"), (1, 300, "generator"), (2, 100, "generator"), (2, 380, "generator"), (3, 350, "generator")])
    floors = spark.createDataFrame([("generator", 10)], "family string, floor_h int")
    row = review.threshold_review(preds, log, floors, match_hours=48).first()
    assert (row.n_events, row.data_driven, row.floor_missing) == (3, 22, False)


def test_a_family_without_a_floor_is_reviewed_from_zero(spark):
    preds = spark.createDataFrame([(1, f, at(h), 3.0) for f in ("generator", "yaw_cable") for h in range(0, 60, 2)],
                                  "entity_id int, family string, ts timestamp, pred_h double")
    log = faults(spark, [(1, 40, "generator"), (1, 40, "yaw_cable")])
    floors = spark.createDataFrame([("generator", 10)], "family string, floor_h int")
    found = {r.family: (r.floor_h, r.floor_missing, r.recommended) for r in review.threshold_review(preds, log, floors, match_hours=24).collect()}
    assert found == {"generator": (10, False, 10), "yaw_cable": (0, True, 4)}


def test_targets_and_marks_are_no_features(spark):
    df = spark.createDataFrame([(1, at(0), 1.0, 2, "x", "f", 3.0, True, "train", 5)],
                               "entity_id int, ts timestamp, s double, n int, text string, family string, hours_to double, is_pre boolean, split string, row_no int")
    assert clean.feature_columns(df) == ["s", "n"]


def test_rows_with_null_keys_are_numbered(spark):
    df = spark.createDataFrame([(1, at(0)), (1, None), (None, at(5))], "entity_id int, ts timestamp")
    assert sorted((r.entity_id or 0, r.row_no) for r in number_rows(df, ["entity_id"], "ts").collect()) == [(0, 1), (1, 1), (1, 2)]


def test_the_mark_reaches_the_scan(spark):
    path = lineage.fresh_path(spark, "tel")
    telemetry(spark, [(e, h, 1.0) for e in (1, 2) for h in range(10)]).write.parquet(path)
    marks = [(1, at(3)), (2, at(6))]
    for rows, pushed, n in ((marks, True, 9), (marks[:1], False, 16)):  # an entity without a mark is read from its start
        fresh = nightly.new_rows(spark.read.parquet(path), spark.createDataFrame(rows, "entity_id int, stored_until timestamp"))
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        assert ("GreaterThan(ts" in plan) == pushed and fresh.count() == n


def test_upsert_does_not_depend_on_the_order_of_arrival(spark):
    rows = [(1, "a", 2.0), (1, "b", 1.0)]
    both = [sinks.upsert(spark.createDataFrame([], "k int, t string, v double"), spark.createDataFrame(r, "k int, t string, v double"), ["k"]).first() for r in (rows, rows[::-1])]
    assert both[0] == both[1]


def test_lost_stream_context_is_an_error(spark):
    store = lineage.fresh_path(spark, "store")
    base = spark.createDataFrame([(1, "v", 1.0, 1.0)], "entity_id int, sensor string, mean double, p90 double")
    handle = jobs.feature_batches(store, ["v"], base, {"1h": 6})
    batch = telemetry(spark, [(1, h, 1.0) for h in range(4)])
    with pytest.raises(AnalysisException):
        handle(batch, 1)
    handle(batch, 0)
    assert spark.read.parquet(f"{store}/features").count() == 4


def test_best_round_waits_for_its_patience():
    losses = [5, 4, 4, 4, 4, 3, 6, 6, 6]
    assert models.best_round(losses, 3) == (1, True)  # the plateau outlasts the patience
    assert models.best_round(losses, 5) == (5, False)
    assert models.best_round([3.0], 1) == (0, False)


def test_event_guard_counts_both_parts(spark):
    def part(n):
        rows = [(1, "yaw_cable", at(10 * i + h), float(5 - h), True) for i in range(n) for h in range(5)]
        return spark.createDataFrame(rows, "entity_id int, family string, ts timestamp, hours_to double, is_pre boolean")

    assert models.event_guard(part(3), part(1)) and not models.event_guard(part(2), part(1)) and not models.event_guard(part(3), part(1).limit(0))


def test_a_loaded_model_keeps_its_parameters(spark):
    family = config.Family("yaw_cable", 10, 3, 4, 2, 4, 2)
    rows = spark.createDataFrame([(1, "yaw_cable", at(i), float(i % 10), float(i % 10), True) for i in range(60)],
                                 "entity_id int, family string, ts timestamp, x double, hours_to double, is_pre boolean")
    model = models.fit_hours(rows, rows, family, ["x"], trees=6, patience=2)
    path = lineage.fresh_path(spark, "model")
    model.save(path)
    found = models.FamilyModel.load(spark, path)
    assert found.family == family and 1 <= model.metrics["n_trees"] <= 6
    gap = model.score(rows).select("ts", F.col("pred_h").alias("a")).join(found.score(rows).select("ts", F.col("pred_h").alias("b")), "ts")
    assert gap.agg(F.max(F.abs(F.col("a") - F.col("b")))).first()[0] == 0
