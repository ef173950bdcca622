"""Schema drift, projections, and the null profile."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadtime.functions.scalars import missing, nan_to_null

TARGET_PREFIXES = ("is_pre_", "hours_to_", "excluded_")
TARGETS = ("is_pre", "hours_to", "excluded", "family", "source", "split", "row_no")
NUMERIC = ("double", "float", "int", "bigint", "smallint", "tinyint", "decimal")


def union_drift(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column some frames lack is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def select_present(df: DataFrame, wanted: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The wanted columns that exist, and the names of those that do not."""
    present = [c for c in wanted if c in df.columns]
    return df.select(*present), [c for c in wanted if c not in df.columns]


def nulls_for_nan(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating column, so that SQL aggregates skip both."""
    return df.select(*[nan_to_null(c).alias(c) if t in ("double", "float") else F.col(c)
                       for c, t in df.dtypes])


def feature_columns(df: DataFrame, keys: Sequence[str] = ("entity_id", "ts")) -> list[str]:
    """Every numeric column that is neither a key, a target nor a mark of where the row belongs."""
    return [c for c, kind in df.dtypes
            if c not in keys and c not in TARGETS and not c.startswith(TARGET_PREFIXES) and kind.startswith(NUMERIC)]


def align(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames on their common columns, in the order of the left one."""
    common = [c for c in left.columns if c in right.columns]
    return left.select(*common), right.select(*common)


def with_model_inputs(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Absent model inputs as 0.0 columns, NULL inputs as 0.0."""
    absent = {c: F.lit(0.0) for c in features if c not in df.columns}
    return (df.withColumns(absent) if absent else df).na.fill(0.0, list(features))


def null_class(pct: Column) -> Column:
    return (F.when(pct == 0, "none").when(pct == 100, "empty").when(pct >= 99, "nearly empty")
            .when(pct > 40, "over 40").when(pct >= 10, "10 to 40").otherwise("under 10"))


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_missing, pct, class) for all columns in one pass over the data."""
    kinds = dict(df.dtypes)
    tests = {c: missing(c) if kinds[c] in ("double", "float") else F.col(c).isNull() for c in columns}
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(test).alias(c) for c, test in tests.items()])
    pct = F.coalesce(F.try_divide(100.0 * F.col("n_missing"), F.col("_n")), F.lit(0.0))
    return (one.unpivot("_n", list(columns), "column_name", "n_missing")
            .select("column_name", "n_missing", pct.alias("pct"), null_class(pct).alias("null_class")))


def top_missing(profile: DataFrame, k: int = 10) -> DataFrame:
    return profile.orderBy(F.desc("pct"), "column_name").limit(k)
