"""Column expressions. All are built-ins, so they stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_ts(ts: str | Column, minutes: int = 10) -> Column:
    """Start of the clock-aligned bucket that contains ``ts`` (10 minutes by default)."""
    step = F.lit(minutes * 60_000_000)
    micros = F.unix_micros(_col(ts))
    return F.timestamp_micros(micros - F.pmod(micros, step))


def shift_years(ts: str | Column, years: int) -> Column:
    """Calendar shift; 29 February goes to the last day of the target month if needed."""
    return _col(ts) + F.make_interval(years=F.lit(years))


def shift_year_text(text: str | Column, years: int) -> Column:
    """Shift the year of a date written as text; the open-end mark ``-`` stays as it is."""
    c = _col(text)
    year = F.substring(c, 1, 4).try_cast("int") + F.lit(years)
    return F.when(c == "-", c).otherwise(F.concat(year.cast("string"), c.substr(F.lit(5), F.length(c))))


def parse_ts(text: str | Column) -> Column:
    """Timestamp of a text, NULL when it is not one (``-`` for an open end)."""
    return F.try_to_timestamp(_col(text))


def missing(c: str | Column) -> Column:
    """True for NULL and for NaN."""
    return _col(c).isNull() | F.isnan(_col(c))


def nan_to_null(c: str | Column) -> Column:
    return F.when(~F.isnan(_col(c)), _col(c))


def angle_error(a: str | Column, b: str | Column) -> Column:
    """Smallest angle between two headings, 0..180 degrees."""
    gap = F.pmod(F.abs(_col(a) - _col(b)), F.lit(360.0))
    return F.least(gap, F.lit(360.0) - gap)


def safe_ratio(num: str | Column, den: str | Column, offset: float) -> Column:
    """``num / (den + offset)``, NULL when the shifted denominator is zero."""
    return F.try_divide(_col(num), _col(den) + F.lit(offset))


def _present(columns: Sequence[str | Column]) -> Column:
    return F.array_compact(F.array(*[_col(c).cast("double") for c in columns]))


def row_spread(columns: Sequence[str | Column]) -> Column:
    """Largest minus smallest present value of the row."""
    cols = [_col(c) for c in columns]
    return F.greatest(*cols) - F.least(*cols)


def row_mean(columns: Sequence[str | Column]) -> Column:
    """Mean of the present values of the row."""
    total = F.aggregate(_present(columns), F.lit(0.0), lambda acc, x: acc + x)
    return F.try_divide(total, F.size(_present(columns)))


def row_std(columns: Sequence[str | Column]) -> Column:
    """Sample deviation of the present values of the row, NULL for fewer than two."""
    values, mean = _present(columns), row_mean(columns)
    squares = F.aggregate(F.transform(values, lambda x: (x - mean) * (x - mean)),
                          F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(values) >= 2, F.sqrt(squares / (F.size(values) - 1)))


def clip(c: str | Column, low: float | Column, high: float | Column) -> Column:
    low = low if isinstance(low, Column) else F.lit(float(low))
    high = high if isinstance(high, Column) else F.lit(float(high))
    return F.when(_col(c).isNotNull(), F.greatest(low, F.least(_col(c), high)))


def rounded(c: str | Column, digits: int) -> Column:
    """``F.round`` of a double, bit for bit. Spark makes a decimal of every value; only one near the middle of two results needs that."""
    scale = 10.0 ** digits
    places = _col(c) * F.lit(scale)
    clear = (F.abs(places) < 1e9) & (F.abs(places - F.rint(places)) < 0.499999)
    return F.when(clear, F.rint(places) / F.lit(scale) + F.lit(0.0)).otherwise(F.round(_col(c), digits))


def alert_score(pred_h: str | Column, lead_hours: Column | float) -> Column:
    """1 = fault imminent, 0 = no urgency."""
    lead = lead_hours if isinstance(lead_hours, Column) else F.lit(float(lead_hours))
    return F.round(F.lit(1.0) - _col(pred_h) / lead, 3)


def guarded_ratio(num: Column, den: Column) -> Column:
    """``num / den`` and 0 when the denominator is 0."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def harmonic(a: Column, b: Column) -> Column:
    """F1 of two rates, 0 when both are 0."""
    return guarded_ratio(F.lit(2.0) * a * b, a + b)
