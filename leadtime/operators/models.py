"""Training, calibration, candidate selection and scoring with Spark ML.

The driver only branches on one-row aggregates (event guards) and loops over the families; every
fit and transform is a distributed job.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field, fields

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadtime import config
from leadtime.functions.scalars import clip
from leadtime.operators import boosting
from leadtime.operators.boosting import PATIENCE, TREES, best_round  # noqa: F401
from leadtime.operators.clean import align, with_model_inputs
from leadtime.operators.evaluate import (alert_summary, confusion, count_label_events, event_recall,
                                         event_windows, regression_metrics)
from leadtime.operators.splits import temporal_split
from leadtime.plans.isotonic import Curve
from leadtime.plans.together import together
from leadtime.sources.sinks import current_version, new_version


@dataclass
class FamilyModel:
    """A fitted family: trees, calibration curve, its inputs and where the rows came from."""

    family: config.Family
    features: list[str]
    trees: PipelineModel
    calibration: Curve
    source: str
    metrics: dict = field(default_factory=dict)

    def score(self, df: DataFrame) -> DataFrame:
        """Adds ``raw_h`` and the calibrated ``pred_h``, both within 0 and the lead time."""
        lead = self.family.lead_hours
        raw = self.trees.transform(with_model_inputs(df, self.features)).withColumn(
            "raw_h", clip("raw_h", 0, lead))
        return self.calibration.transform(raw.drop("_features")).withColumn("pred_h", clip("pred_h", 0, lead))

    def save(self, path: str) -> None:
        """Publishes the model as the next version below ``path``.

        Trees, curve and parameters are written beside each other under a name of their own, and only
        then named in the pointer: a failure in between leaves the former version the current one.
        """
        spark = SparkSession.active()
        with new_version(spark, path) as folder:
            self.trees.write().save(f"{folder}/trees")
            self.calibration.write().save(f"{folder}/calibration")
            spark.createDataFrame(
                [(*(getattr(self.family, f.name) for f in fields(self.family)), self.source, self.features)],
                ", ".join(f"{f.name} {_KINDS[type(getattr(self.family, f.name))]}" for f in fields(self.family))
                + ", source string, features array<string>"
            ).coalesce(1).write.parquet(f"{folder}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "FamilyModel":
        """The current version below ``path``."""
        folder = current_version(spark, path)
        if folder is None:
            raise FileNotFoundError(f"no model below {path}")
        meta = spark.read.parquet(f"{folder}/meta").first()
        fam = config.Family(**{f.name: meta[f.name] for f in fields(config.Family)})
        return FamilyModel(fam, list(meta.features), PipelineModel.load(f"{folder}/trees"),
                           Curve.load(spark, f"{folder}/calibration"), meta.source)


_KINDS = {str: "string", int: "int", float: "double", bool: "boolean"}


def tree_depth(leaves: int) -> int:
    return max(1, math.ceil(math.log2(leaves)))


def fit_calibration(scored: DataFrame, raw: str = "raw_h", actual: str = "hours_to", out: str = "pred_h") -> Curve:
    """Increasing curve from raw to actual hours, fitted on the exact raw values of any number."""
    return Curve.fit(scored, raw, actual, out)


def fit_hours(train: DataFrame, val: DataFrame, family: config.Family, features: Sequence[str],
              trees: int = TREES, source: str = "target", patience: int = PATIENCE) -> FamilyModel:
    """Boosted trees on positive rows, cut after the best round on the validation rows, calibrated on them.

    A round is the best one if ``patience`` later rounds don't beat it. Boosting goes on until that is
    known; the model is the trees up to the best round, nothing is fitted twice.
    """
    assembler = VectorAssembler(inputCols=list(features), outputCol="_features")
    fit_on, held = (assembler.transform(with_model_inputs(df.where("is_pre"), features).select("hours_to", *features))
                    .select(F.col("hours_to").alias("y"), "_features") for df in (train, val))
    fitted, grown = boosting.regression(fit_on, held, trees, patience, depth=tree_depth(family.leaves), min_child=family.min_child)
    stages: list[Transformer] = [assembler, fitted]
    scored = fitted.transform(grown.held).withColumn("raw_h", clip("raw_h", 0, family.lead_hours))
    return FamilyModel(family, list(features), PipelineModel(stages), fit_calibration(scored, actual="y"), source,
                       {"n_trees": fitted.getNumTrees, "n_grown": grown.rounds})


def fit_classifier(train: DataFrame, features: Sequence[str], trees: int = TREES, depth: int = 5,
                   min_child: int = 30, val: DataFrame | None = None, patience: int = PATIENCE) -> PipelineModel:
    """Balanced classifier: rows weigh n / (2 n_class) of the training rows.

    With validation rows the model is cut after the round that ``patience`` later ones didn't beat.
    """
    sizes = {r._y: r.n for r in train.groupBy(F.col("is_pre").cast("int").alias("_y"))
             .agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    n = sum(sizes.values())
    weight = F.lit(None).cast("double")
    for y, size in sizes.items():
        weight = F.when(F.col("is_pre").cast("int") == y, F.lit(n / (2.0 * size))).otherwise(weight)
    assembler = VectorAssembler(inputCols=list(features), outputCol="_features")
    sides = [None if df is None else assembler.transform(with_model_inputs(df.select("is_pre", *features), features)).select(
        F.col("is_pre").cast("double").alias("y"), F.coalesce(weight, F.lit(1.0)).alias("w"), "_features") for df in (train, val)]
    fitted, _ = boosting.classification(*sides, trees, patience, depth=depth, min_child=min_child)
    return PipelineModel([assembler, fitted])


def feature_importance(model: PipelineModel, features: Sequence[str], k: int = 20) -> DataFrame:
    """The ``k`` largest importances; a feature that no tree splits on has 0."""
    found = model.stages[-1].featureImportances.toArray()  # reaches to the last feature that is used
    values = [*found, *[0.0] * (len(features) - len(found))]
    spark = SparkSession.active()
    table = spark.createDataFrame([(f, float(v)) for f, v in zip(features, values)],
                                  "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(k)


def event_guard(train: DataFrame, val: DataFrame, min_train: int = config.MIN_TRAIN_EVENTS,
                min_val: int = config.MIN_VAL_EVENTS, by: Sequence[str] = ("entity_id", "family")) -> bool:
    """Are there enough distinct faults to train and to calibrate?"""
    row = guard_counts(train.withColumn("split", F.lit("train")).unionByName(val.withColumn("split", F.lit("val")), allowMissingColumns=True),
                       min_train, min_val, by).groupBy().pivot("split", ["train", "val"]).agg(F.max("enough")).first()
    return bool(row["train"] and row["val"])


def guard_counts(rows: DataFrame, min_train: int = config.MIN_TRAIN_EVENTS, min_val: int = config.MIN_VAL_EVENTS,
                 by: Sequence[str] = ("entity_id", "family"), pool: Sequence[str] = ()) -> DataFrame:
    """Distinct faults behind the train and val rows, in one pass: (pool, split, n_events, enough)."""
    keys = [*pool, "split"]
    per = count_label_events(rows.where(F.col("split").isin("train", "val")), [*keys, *(c for c in by if c not in keys)])
    out = per.groupBy(*keys).agg(F.sum("n_events").alias("n_events"))
    return out.withColumn("enough", F.col("n_events") >= F.when(F.col("split") == "train", min_train).otherwise(min_val))


def evaluate_scored(scored: DataFrame, family: config.Family, alert_h: float) -> DataFrame:
    """One row: MAE, row precision and recall, event recall, F1 of (event recall, precision)."""
    alert, lead = F.col("pred_h") <= F.lit(float(alert_h)), F.lit(float(family.lead_hours))
    rows = confusion(scored, alert, F.col("is_pre")).drop("f1", "tn")
    starts = event_windows(scored, lead, family.lead_hours)
    events = event_recall(starts, F.col("best_score") <= F.lit(float(alert_h)))
    regress = regression_metrics(scored).drop("n")
    return alert_summary(rows, events).join(regress, "family", "left")


def train_candidates(stores: DataFrame, family: config.Family, features: Sequence[str], *,
                     target: str = "target", donor: str = "donor", trees: int = TREES,
                     patience: int = PATIENCE, alert_h: float | None = None) -> tuple[dict[str, FamilyModel], DataFrame | None]:
    """Fit (target only) and (donor + target); evaluate both on the target's last fifth.

    ``stores`` has ``source``, the keys, ``is_pre``, ``hours_to`` and the features; it is read once for each side of
    a candidate and is therefore a written table or a view of one: its wide rows are not written again here. Returns
    the fitted models by source and one metrics row per candidate (None when no candidate is trained).
    """
    alert_h = family.retrain_alert_h if alert_h is None else alert_h
    split = temporal_split(stores, by=("source",))
    test = split.where((F.col("source") == target) & (F.col("split") == "test"))
    span = test.agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.count(F.lit(1)).alias("n")).first()
    counts = {(r["source"], r["split"]): r["n_events"] for r in guard_counts(split, pool=("source",)).collect()}  # two sources, two splits
    pools = {target: (target,)}
    if any(s == donor for s, _ in counts):
        pools[f"{donor}+{target}"] = (donor, target)

    def candidate(name: str, sources: Sequence[str]) -> tuple[FamilyModel, DataFrame]:
        pool = split.where(F.col("source").isin(*sources))
        model = fit_hours(pool.where("split = 'train'"), pool.where("split = 'val'"), family, features, trees, name, patience)
        return model, evaluate_scored(model.score(test), family, alert_h).withColumns({
            "source": F.lit(name), "n_trees": F.lit(model.metrics["n_trees"]), "test_start": F.lit(span["first"]),
            "test_end": F.lit(span["last"]), "test_rows": F.lit(span["n"])})

    jobs = {}
    for name, sources in pools.items():
        enough = {s: sum(counts.get((x, s), 0) for x in sources) for s in ("train", "val")}
        if enough["train"] >= config.MIN_TRAIN_EVENTS and enough["val"] >= config.MIN_VAL_EVENTS:
            jobs[name] = lambda name=name, sources=sources: candidate(name, sources)
    if not jobs:
        return {}, None
    found = dict(zip(jobs, together(stores.sparkSession, list(jobs.values()))))
    out = None
    for _, row in found.values():
        out = row if out is None else out.unionByName(row)
    return {name: model for name, (model, _) in found.items()}, out


def stack_sources(donor: DataFrame, target: DataFrame, donor_name: str = "donor",
                  target_name: str = "target") -> DataFrame:
    """Both stores on their common columns, marked by source."""
    left, right = align(donor, target)
    return (left.withColumn("source", F.lit(donor_name))
            .unionByName(right.withColumn("source", F.lit(target_name))))


def find_model(spark: SparkSession, candidates: Sequence[str]) -> FamilyModel | None:
    """First model that exists, in the order given (own model, then donor model)."""
    for path in candidates:
        if current_version(spark, path) is not None:
            return FamilyModel.load(spark, path)
    return None


def score_latest(latest_rows: DataFrame, model: FamilyModel, run_date: Column,
                 alert_h: float | None = None, time: str = "ts") -> DataFrame:
    """Prediction log rows for the last reading of every entity."""
    alert_h = model.family.alert_h if alert_h is None else alert_h
    scored = model.score(latest_rows)
    return scored.select(
        run_date.alias("date"), F.col(time).alias("last_data_ts"), "entity_id",
        F.lit(model.family.name).alias("family"), F.round("pred_h", 1).alias("pred_h"),
        (F.col("pred_h") <= F.lit(float(alert_h))).alias("alert"),
        F.lit(float(alert_h)).alias("alert_threshold_h"))
