"""Class balance, separability, threshold choice and calibration diagnostics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadtime.functions.scalars import guarded_ratio
from leadtime.plans.lineage import join_sized
from leadtime.plans.ranking import percentiles, running_counts


def class_balance(labels: DataFrame, by: Sequence[str] = ("family",)) -> DataFrame:
    """Positives, rows, share and the longest labelled horizon, with the verdict on the share."""
    out = labels.groupBy(*by).agg(
        F.count_if("is_pre").alias("n_pos"), F.count(F.lit(1)).alias("n_rows"),
        F.max("hours_to").alias("max_hours"))
    pct = guarded_ratio(F.col("n_pos") * 100.0, F.col("n_rows"))
    return out.withColumns({"pct_pos": pct, "verdict": (
        F.when(pct > 30, "too dense").when(pct > 25, "dense").when(pct >= 2, "ok").otherwise("sparse"))})


def split_events(faults: DataFrame, cuts: DataFrame, by: Sequence[str] = ("family",),
                 keys: Sequence[str] = ("entity_id",), time: str = "ts") -> DataFrame:
    """Faults before, and at or after, the cut of their entity."""
    joined = join_sized(faults, cuts, keys)
    return joined.groupBy(*by).agg(
        F.count_if(F.col(time) < F.col("cut")).alias("n_train"),
        F.count_if(F.col(time) >= F.col("cut")).alias("n_test"), F.count(F.lit(1)).alias("n_total"))


def split_positives(labels: DataFrame, by: Sequence[str] = ("family",)) -> DataFrame:
    """Positives in train and test (column ``split``) with a verdict per family."""
    out = labels.groupBy(*by).agg(
        F.count_if(F.col("is_pre") & (F.col("split") != "test")).alias("train_pos"),
        F.count_if(F.col("is_pre") & (F.col("split") == "test")).alias("test_pos"))
    return out.withColumn("verdict", (
        F.when(F.col("train_pos") == 0, "no train").when(F.col("test_pos") == 0, "no test")
        .when(F.col("train_pos") < 100, "few").otherwise("ok")))


def feature_quality(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, pct_missing, pct_zero) in one pass; no rows are exploded."""
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[
        F.struct(F.count_if(F.col(c).isNull()).alias("missing"),
                 F.count_if(F.col(c) == 0).alias("zero")).alias(c) for c in features])
    long = one.unpivot("_n", list(features), "feature", "_s")
    return long.select("feature", (F.col("_s.missing") * 100.0 / F.col("_n")).alias("pct_missing"),
                       (F.col("_s.zero") * 100.0 / F.col("_n")).alias("pct_zero"))


def overall_quality(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row: cells, share of missing and of zero cells over all features."""
    cells = F.count(F.lit(1)) * F.lit(len(features))
    missing, zero = (sum((F.count_if(test(F.col(c))) for c in features), F.lit(0))
                     for test in (lambda c: c.isNull(), lambda c: c == 0))
    return df.agg(cells.alias("n_cells"), F.try_divide(missing * 100.0, cells).alias("pct_missing"),
                  F.try_divide(zero * 100.0, cells).alias("pct_zero"))


def first_valid_rows(df: DataFrame, features: Sequence[str], by: Sequence[str] = ("entity_id",),
                     row_no: str = "row_no") -> DataFrame:
    """First position with a value per series and feature (a leakage check for rolling features)."""
    one = df.groupBy(*by).agg(*[F.min(F.when(F.col(c).isNotNull(), F.col(row_no))).alias(c) for c in features])
    return one.unpivot(list(by), list(features), "feature", "first_row")


def auc(df: DataFrame, score: str, label: Column, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve by ranks, ties counted half; NULL when a class is empty."""
    by = list(by)
    ranked = running_counts(df.where(F.col(score).isNotNull()), by, score,
                            {"pos": F.count_if(label), "neg": F.count_if(~label)})
    return ranked.groupBy(*by).agg(
        F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2)).alias("_u"),
        F.max("pos_total").alias("n_pos"), F.max("neg_total").alias("n_neg")).select(
        *by, "n_pos", "n_neg",
        F.try_divide(F.col("_u"), F.col("n_pos").cast("double") * F.col("n_neg")).alias("auc"))


def symmetric_auc(df: DataFrame, features: Sequence[str], label: Column,
                  by: Sequence[str] = ()) -> DataFrame:
    """max(auc, 1 - auc) of every feature on its own, NULL read as 0."""
    long = df.select(*by, label.alias("_y"), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
                                              for c in features]).unpivot(
        [*by, "_y"], list(features), "feature", "value")
    one = auc(long, "value", F.col("_y"), [*by, "feature"])
    return one.select(*by, "feature", F.greatest("auc", 1 - F.col("auc")).alias("auc"))


def auc_report(aucs: DataFrame, k: int = 5, by: Sequence[str] = ()) -> DataFrame:
    """Per group: median over the features and the k best and k worst."""
    group = Window.partitionBy(*by)  # one row per feature
    ranked = aucs.withColumns({"best": F.row_number().over(group.orderBy(F.desc("auc"), "feature")),
                               "worst": F.row_number().over(group.orderBy("auc", "feature")),
                               "median_auc": F.median("auc").over(group)})
    return ranked.where((F.col("best") <= k) | (F.col("worst") <= k))


def class_means(df: DataFrame, column: str, by: Sequence[str] = ("family",)) -> DataFrame:
    return df.groupBy(*by).agg(
        F.avg(F.when(F.col("is_pre"), F.col(column))).alias("pos_mean"),
        F.avg(F.when(~F.col("is_pre"), F.col(column))).alias("neg_mean"))


def separation(df: DataFrame, score: str, label: Column, by: Sequence[str] = ("family",)) -> DataFrame:
    """Negative mean and p95, positive mean and p05, share of negatives above the positive p05."""
    by = list(by)
    rows = df.select(*by, F.col(score).alias("_s"), label.alias("_y"))
    neg = percentiles(rows.where(~F.col("_y")), by, "_s", {"neg_p95": 0.95})
    pos = percentiles(rows.where("_y"), by, "_s", {"pos_p05": 0.05})
    joined = join_sized(rows, neg.join(pos, by, "full"), by)
    return joined.groupBy(*by).agg(
        F.avg(F.when(~F.col("_y"), F.col("_s"))).alias("neg_mean"), F.max("neg_p95").alias("neg_p95"),
        F.avg(F.when(F.col("_y"), F.col("_s"))).alias("pos_mean"), F.max("pos_p05").alias("pos_p05"),
        (100.0 * F.avg(F.when(~F.col("_y"), (F.col("_s") > F.col("pos_p05")).cast("int")))).alias("overlap_pct"))


def monthly_false_positives(df: DataFrame, alert: Column, label: Column, time: str = "ts",
                            by: Sequence[str] = ("family",)) -> DataFrame:
    """False alerts as a share of the negatives of each calendar month, months without any as 0."""
    rows = df.select(*by, F.date_trunc("month", time).alias("month"),
                     (alert & ~label).alias("_fp"), (~label).alias("_neg"))
    seen = rows.groupBy(*by, "month").agg(F.count_if("_fp").alias("n_fp"), F.count_if("_neg").alias("n_neg"))
    spine = seen.groupBy(*by).agg(F.sequence(F.min("month"), F.max("month"), F.make_interval(months=F.lit(1)))
                                  .alias("_m")).select(*by, F.explode("_m").alias("month"))
    full = spine.join(seen, [*by, "month"], "left").na.fill(0, ["n_fp", "n_neg"])
    return full.withColumn("fp_pct", guarded_ratio(F.col("n_fp") * 100.0, F.col("n_neg")))


def month_correlation(df: DataFrame, features: Sequence[str], time: str = "ts") -> DataFrame:
    """Pearson correlation of each feature with the calendar month, in one pass."""
    month = F.month(time).cast("double")
    one = df.agg(*[F.corr(F.col(c).cast("double"), month).alias(c) for c in features])
    return one.unpivot([], list(features), "feature", "corr_month")


def pr_curve(df: DataFrame, score: str, label: Column, by: Sequence[str] = ("family",)) -> DataFrame:
    """(threshold, tp, fp, precision, recall): alert when the score reaches the threshold."""
    ranked = running_counts(df.where(F.col(score).isNotNull()), by, score,
                            {"pos": F.count_if(label), "neg": F.count_if(~label)})
    tp = F.col("pos_total") - F.col("pos_below")
    fp = F.col("neg_total") - F.col("neg_below")
    return ranked.select(*by, F.col(score).alias("threshold"), tp.alias("tp"), fp.alias("fp"),
                         guarded_ratio(tp, tp + fp).alias("precision"),
                         guarded_ratio(tp, F.col("pos_total")).alias("recall"))


def best_precision(curve: DataFrame, min_recall: float = 0.80, by: Sequence[str] = ("family",)) -> DataFrame:
    """Highest precision with at least ``min_recall``; the lowest threshold wins a tie; 0 if none."""
    ok = F.col("recall") >= F.lit(float(min_recall))
    rank = F.when(ok, F.struct("precision", (-F.col("threshold")).alias("t")))
    out = curve.groupBy(*by).agg(F.max_by(F.struct("precision", "threshold"), rank).alias("b"))
    return out.select(*by, F.coalesce("b.precision", F.lit(0.0)).alias("max_precision"),
                      F.coalesce("b.threshold", F.lit(0.0)).alias("best_threshold"))


def choose_threshold(curve: DataFrame, min_precision: float = 0.10, default: float = 0.20,
                     by: Sequence[str] = ("family",)) -> DataFrame:
    """Threshold with the highest recall at ``min_precision`` or more; ties to the lowest; else the default."""
    ok = F.col("precision") >= F.lit(float(min_precision))
    rank = F.when(ok, F.struct("recall", (-F.col("threshold")).alias("t")))
    return curve.groupBy(*by).agg(
        F.coalesce(F.max_by("threshold", rank), F.lit(float(default))).alias("threshold"))


def nearest_curve_point(curve: DataFrame, threshold: float, by: Sequence[str] = ("family",)) -> DataFrame:
    """The point of the curve closest to a threshold; the lower one if two are equally close."""
    gap = F.struct(F.abs(F.col("threshold") - F.lit(float(threshold))), F.col("threshold"))
    return curve.groupBy(*by).agg(F.min_by(F.struct("threshold", "precision", "recall"), gap).alias("p")).select(
        *by, "p.*")


def reliability(df: DataFrame, score: str, label: Column, bins: int = 10,
                by: Sequence[str] = ("family",)) -> DataFrame:
    """Observed against predicted rate in equal, right-closed bins of [0, 1]; empty bins are absent.

    Scores are added up as decimals, so the mean doesn't depend on the order of the rows.
    """
    bucket = F.least(F.greatest(F.ceil(F.col(score) * bins), F.lit(1)), F.lit(bins))
    exact = F.sum(F.col(score).cast("decimal(28,18)")).cast("double")
    return df.groupBy(*by, bucket.alias("bin")).agg(
        F.avg(label.cast("int")).alias("frac_pos"), (exact / F.count(score)).alias("mean_pred"),
        F.count(F.lit(1)).alias("n"))


def calibration_error(curve: DataFrame, by: Sequence[str] = ("family",)) -> DataFrame:
    return curve.groupBy(*by).agg(F.avg(F.abs(F.col("frac_pos") - F.col("mean_pred"))).alias("calibration_error"))


def histogram(df: DataFrame, column: str, bins: int, by: Sequence[str] = ("family",),
              density: bool = False, shared_range: Sequence[str] | None = None) -> DataFrame:
    """Equal-width bins between the smallest and largest value; the top edge belongs to the last bin.

    ``shared_range`` names the columns within which the groups share one value range (all of
    ``by`` by default).
    """
    by = list(by)
    scope = by if shared_range is None else list(shared_range)
    rows = df.where(F.col(column).isNotNull()).select(*by, F.col(column).cast("double").alias("_v"))
    limits = rows.groupBy(*scope).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    joined = join_sized(rows, limits, scope)
    width = (F.col("_hi") - F.col("_lo")) / bins
    raw = F.floor(F.try_divide(F.col("_v") - F.col("_lo"), width))
    bucket = F.least(F.coalesce(raw, F.lit(0)), F.lit(bins - 1)) + 1
    counts = joined.groupBy(*by, bucket.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.max(width).alias("_w"))
    if not density:
        return counts.drop("_w")
    total = F.sum("n").over(Window.partitionBy(*by))
    return counts.withColumn("density", F.try_divide(F.col("n"), total * F.col("_w"))).drop("_w")


