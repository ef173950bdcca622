"""Rounding without a decimal for every value."""

import random
import struct

from pyspark.sql import functions as F

from leadtime.checks import windows
from leadtime.checks.registry import QUERIES
from leadtime.functions.scalars import rounded


def test_rounded_is_the_built_in_round_bit_for_bit(spark):
    rng = random.Random(2)
    values = [None, float("nan"), float("inf"), -float("inf"), 0.0, -0.0, 1e-300, 1e300, -1e17, 123456.78905, 0.00005, -0.00005, 0.00015, 2.5, -2.5, 1.00005,
              0.49999999999999994, -0.00004, 99999.99995, 1e5, 2.0 ** 53, 0.1 + 0.2, -1e-8, 1e-8]
    values += [rng.choice([1, -1]) * rng.random() * 10.0 ** rng.randrange(-7, 9) for _ in range(3000)]
    values += [k / 20000 + d for k in range(-500, 500) for d in (0.0, 1e-8, -1e-8, 1e-11, -1e-11)]  # middles and what is near them
    rows = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    bits = lambda x: None if x is None else struct.pack(">d", x)
    for digits in (4, 6, 0):
        for r in rows.select("v", rounded("v", digits).alias("a"), F.round("v", digits).alias("b")).collect():
            assert bits(r.a) == bits(r.b), (r, digits)


def test_no_decimal_is_made_for_every_feature(spark, sf, monkeypatch):
    """Each feature of the domain sensors is rounded through ``rounded``; the built-in is behind a condition."""
    asked = []
    monkeypatch.setattr(windows, "rounded", lambda c, digits, f=rounded: asked.append(digits) or f(c, digits))
    out = QUERIES["win_14_domain_sensors"](spark, sf)
    assert asked == [4] * (len(out.columns) - 2) and len(asked) > 700
