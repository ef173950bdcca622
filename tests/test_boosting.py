"""Boosting round by round: resumable, cut without a second fit, stopped by the held rows."""

import random

import pytest
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from leadtime import config
from leadtime.operators import boosting, models
from leadtime.plans.lineage import fresh_path, materialize
from leadtime.plans.together import together


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(5)
    rows = [(float(i % 10) * 3 + rng.gauss(0, 1), float(i % 10), rng.random(), 1 if rng.random() < 0.5 else 0) for i in range(500)]
    df = spark.createDataFrame(rows, "y double, a double, b double, h int").coalesce(1)
    df = VectorAssembler(inputCols=["a", "b"], outputCol="_features").transform(df)
    df = materialize(df, "fit")
    return df.where("h = 1"), df.where("h = 0")


def _predicted(model, rows):
    return [r.prediction for r in model.transform(rows).select("prediction").collect()]


def test_going_on_and_cutting_equal_a_direct_fit(spark, sides):
    rows, held = sides
    parts = {"depth": 3, "min_child": 5}
    long = boosting.Boosting(rows, held, **parts)
    assert long.grow_until_known(11, 4) <= 11  # blocks of 5, 5 and 1 rounds, unless the best is known before
    while long.rounds < 11:
        long.grow(min(5, 11 - long.rounds))
    short = boosting.Boosting(rows, held, **parts)
    short.grow(5)
    short.grow(2)  # seven rounds, fitted directly
    assert len(long.losses) == 11 and long.losses[:7] == pytest.approx(short.losses)
    a, b = _predicted(long.cut(7), held), _predicted(short.cut(7), held)
    assert a == pytest.approx(b) and long.cut(7).getNumTrees == 7
    # the loss that decides is that of the cut model
    labels = [r.y for r in held.select("y").collect()]
    assert long.losses[6] == pytest.approx(sum((x - y) ** 2 for x, y in zip(a, labels)) / len(a))
    first = boosting.GBTRegressor(featuresCol="_features", labelCol="y", maxIter=3, stepSize=0.05, maxDepth=3, minInstancesPerNode=5,
                                  subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=42).fit(long.__class__(rows, held, **parts)._rows)
    assert _predicted(long.cut(3), held) == pytest.approx(_predicted(first, held))  # and Spark ML's own of three rounds


def test_margins_are_those_of_plain_boosting(spark):
    """One feature with two values: a tree gives the mean of what is left on each side, which Spark ML doubles."""
    data = spark.createDataFrame([(1.0, 0.0)] * 30 + [(5.0, 1.0)] * 30, "y double, a double").coalesce(1)
    data = VectorAssembler(inputCols=["a"], outputCol="_features").transform(data)
    data = data.withColumn("y", F.when(F.rand(1) < 0.5, F.col("y") + 1).otherwise(F.col("y")))
    data = materialize(data, "two")
    grown = boosting.Boosting(data, data, depth=2, min_child=1)
    for _ in range(2):
        grown.grow(2)
    assert grown.losses == sorted(grown.losses, reverse=True)
    low, high = sorted(set(_predicted(grown.cut(4), data)))
    means = [r.m for r in data.groupBy(F.col("y") > 3).agg(F.avg("y").alias("m")).orderBy("m").collect()]
    assert [low, high] == pytest.approx(means, abs=0.2)


def test_rounds_end_when_nothing_gets_better(spark, sides):
    rows, _ = sides
    noise = rows.withColumn("y", F.pmod(F.xxhash64("_features"), F.lit(1000)) / 1000.0)
    held = rows.withColumn("y", F.pmod(F.xxhash64("_features", F.lit(7)), F.lit(997)) / 997.0)
    model, grown = boosting.regression(noise, held, 1000, 8, depth=5, min_child=1)
    best, known = boosting.best_round(grown.losses, 8)
    assert known and grown.rounds < 200 and model.getNumTrees == best + 1
    assert all(len(b.treeWeights) == boosting.block_rounds(8) == 10 for b in grown.blocks)


def test_classes_of_a_clear_table(spark, sides):
    rows, held = (df.withColumns({"y": (F.col("a") >= 5).cast("double"), "w": F.lit(1.0)}) for df in sides)
    model, losses = boosting.classification(rows, held, 12, 4, depth=2, min_child=5)
    assert isinstance(model, GBTClassificationModel) and model.getNumTrees == boosting.best_round(losses, 4)[0] + 1
    scored = model.transform(held).select("y", "prediction", "probability").collect()
    assert all(r.prediction == r.y and (r.probability[1] > 0.5) == (r.y == 1.0) for r in scored)
    whole, losses = boosting.classification(rows, None, 3, 4, depth=2, min_child=5)
    assert whole.getNumTrees == 3 and not losses


def test_partitions_follow_the_rows(spark, monkeypatch):
    df = materialize(spark.range(1000).repartition(8), "rows")
    assert boosting.sized(df).rdd.getNumPartitions() == 1
    monkeypatch.setattr(boosting, "TASK_ROWS", 300)
    assert boosting.sized(df).rdd.getNumPartitions() == 4


def test_no_more_tasks_than_cores_unless_they_get_too_long(spark, monkeypatch):
    df = materialize(spark.range(2000).repartition(50), "rows")
    df = df.union(df).union(df)
    cores = spark.sparkContext.defaultParallelism
    assert df.rdd.getNumPartitions() > 2 * cores
    monkeypatch.setattr(boosting, "TASK_ROWS", 100)
    assert boosting.sized(df).rdd.getNumPartitions() == cores and boosting.sized(df).count() == 6000
    monkeypatch.setattr(boosting, "MOST_ROWS", 6000 // (cores + 4))
    assert boosting.sized(df).rdd.getNumPartitions() in (cores + 4, cores + 5)


def test_jobs_run_at_the_same_time_and_errors_surface(spark):
    import threading
    barrier = threading.Barrier(3, timeout=60)
    assert together(spark, [lambda i=i: (barrier.wait(), spark.range(i + 1).count())[1] for i in range(3)]) == [1, 2, 3]
    with pytest.raises(ZeroDivisionError):
        together(spark, [lambda: 1, lambda: 1 // 0])
    assert together(spark, []) == []


def _family_model(spark, sides, shift=0.0):
    rows, held = (df.select((F.col("y") + shift).alias("hours_to"), F.lit(True).alias("is_pre"), "a", "b") for df in sides)
    return models.fit_hours(rows, held, config.Family("yaw_cable", 60, 5, 5, 1, 8, 5), ["a", "b"], 5)


def test_a_failure_between_the_parts_leaves_the_former_model(spark, sides, monkeypatch):
    path = fresh_path(spark, "model")
    first = _family_model(spark, sides)
    first.save(path)
    rows = sides[1].select("a", "b")
    want = [r.pred_h for r in models.FamilyModel.load(spark, path).score(rows).collect()]
    assert want == pytest.approx([r.pred_h for r in first.score(rows).collect()])
    second = _family_model(spark, sides, 20.0)

    class Broken:
        def write(self):
            raise OSError("no space")

    whole, second.calibration = second.calibration, Broken()
    with pytest.raises(OSError):
        second.save(path)
    again = models.find_model(spark, [fresh_path(spark, "none"), path])
    assert [r.pred_h for r in again.score(rows).collect()] == pytest.approx(want)
    second.calibration = whole
    second.save(path)
    assert [r.pred_h for r in models.FamilyModel.load(spark, path).score(rows).collect()] != pytest.approx(want)


def test_a_fitted_family_beats_the_constant(spark, sides):
    model = _family_model(spark, sides)
    held = sides[1].select(F.col("y").alias("hours_to"), "a", "b")
    mean = sides[0].agg(F.avg("y")).first()[0]
    row = model.score(held).agg(F.avg(F.abs(F.col("pred_h") - F.col("hours_to"))).alias("m"), F.avg(F.abs(F.col("hours_to") - mean)).alias("c")).first()
    assert row.m < 0.6 * row.c
