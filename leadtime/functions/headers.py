"""Column names out of raw header lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean_header(line: Column, lower: bool = True) -> Column:
    """Normalised, comma-separated column names of a raw header line.

    Commas between quotes separate nothing and are dropped with the other punctuation.
    """
    # commas with an odd number of quotes ahead of them lie inside a quoted name
    text = F.regexp_replace(line, r',(?=[^"]*"(?:[^"]*"[^"]*")*[^"]*$)', "-")
    text = F.regexp_replace(F.regexp_replace(text, '"', ""), r"^# ?", "")
    names = F.transform(F.split(text, ","), lambda name: _clean_name(name, lower))
    return F.array_join(names, ",")


def _clean_name(name: Column, lower: bool) -> Column:
    kept = F.regexp_replace(name, r"[^a-zA-Z0-9_ ]", "")
    joined = F.regexp_replace(F.regexp_replace(kept, "[ _]+", "_"), "^_+|_+$", "")
    if not lower:
        return joined
    joined = F.lower(joined)
    return F.when(joined == "date_and_time", F.lit("timestamp")).otherwise(joined)


def normalize_columns(df: DataFrame, lower: bool = True) -> DataFrame:
    """Rename every column the way ``clean_header`` does (names only, no data is read)."""
    spark = df.sparkSession
    if not df.columns:
        return df
    raw = spark.createDataFrame([(i, c) for i, c in enumerate(df.columns)], "i int, raw string")
    rows = raw.select("i", _clean_name(F.regexp_replace("raw", '^# ?|"', ""), lower).alias("name"))
    names = [r.name for r in rows.orderBy("i").collect()]  # one row per column
    return df.toDF(*names)
