"""Positions within keys against a window over each key."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from trialmill.functions.ranks import positions


@pytest.mark.parametrize("coalesced", ["true", "false"])
def test_positions_equal_a_window(spark, coalesced):
    rnd = random.Random(2)
    rows = [(rnd.choice([1, 1, 1, 1, 2, None]), rnd.choice(["a", None]), rnd.randrange(10**6), "x") for _ in range(3000)]
    rows += [(9, "z", 1, "x")]
    df = spark.createDataFrame(rows, "k long, j string, v long, part string").repartition(5).drop("part")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesced)
    try:
        found = positions(df, ["k", "j"], [F.desc("v")])
        assert found.select("part").distinct().count() > 1 or coalesced == "true"
        got = found.select("k", "j", "v", "position", "rows_of_key").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    key = Window.partitionBy("k", "j")
    want = df.select("k", "j", "v", F.row_number().over(key.orderBy(F.desc("v"))).alias("p"), F.count(F.lit(1)).over(key).alias("n")).collect()
    order = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=order) == sorted(map(tuple, want), key=order)


def test_positions_of_no_rows(spark):
    df = spark.createDataFrame([], "k long, v long")
    assert positions(df, ["k"], [F.col("v")]).collect() == []
