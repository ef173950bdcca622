"""Small frames and plain-Python restatements to compare with."""

from __future__ import annotations

import datetime as dt
import math

T0 = dt.datetime(2024, 1, 1)


def at(hours: float) -> dt.datetime:
    return T0 + dt.timedelta(hours=hours)


def telemetry(spark, rows, columns="v double"):
    """rows: (entity, hours, values...)"""
    return spark.createDataFrame([(e, at(h), *vals) for e, h, *vals in rows],
                                 f"entity_id int, ts timestamp, {columns}")


def faults(spark, rows):
    """rows: (entity, hours, family)"""
    return spark.createDataFrame([(e, at(h), f) for e, h, f in rows], "entity_id int, ts timestamp, family string")


def same(a, b, tol=1e-9):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) or isinstance(b, float):
        return math.isclose(a, b, rel_tol=tol, abs_tol=tol)
    return a == b


def quantile(values, q):
    xs = sorted(values)
    pos = q * (len(xs) - 1)
    lo = math.floor(pos)
    hi = math.ceil(pos)
    return xs[lo] + (xs[hi] - xs[lo]) * (pos - lo)
