"""Numbers in messages are rounded by their exact binary value, half to even."""

import math
import random

import pytest
from pyspark.sql import functions as F

from trialmill.functions.text import decimals, percent


@pytest.mark.parametrize("digits", [0, 1, 2, 4])
def test_decimals_agree_with_exact_rounding(spark, digits):
    rnd = random.Random(digits)
    values = [0.0, 0.125, 0.375, 2.5, 3.5, 0.15, 0.25, 0.35, 12.15, 1.005, 2.675, -0.125, -2.5, 1e-9, -1e-9, 123456.785, 2.0**40 + 0.5]
    values += [rnd.randrange(20_001) / 20_000 for _ in range(2000)] + [rnd.randrange(-4000, 4000) / 80 for _ in range(2000)]
    values += [math.nextafter(k / 8, rnd.choice([-1e9, 1e9])) for k in range(200)] + [rnd.uniform(-1e6, 1e6) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [(r.v, r.t, r.p) for r in df.select("v", decimals(F.col("v"), digits).alias("t"), percent(F.col("v"), digits).alias("p")).collect()]
    assert [g for g in got if g[1:] != (f"{g[0]:.{digits}f}", f"{g[0]:.{digits}%}")] == []


def test_odd_values(spark):
    df = spark.createDataFrame([(None,), (math.inf,), (-math.inf,), (math.nan,)], "v double")
    assert [r.t for r in df.select(decimals(F.col("v"), 2).alias("t")).collect()] == [None, "inf", "-inf", "nan"]
