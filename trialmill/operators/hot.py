"""An exact median that spreads every group, whatever its size, over many tasks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

BUCKETS = 1024


def value_bucket(value: Column) -> Column:
    """Monotone map of any double onto at most 2052 buckets; NaN is the largest value."""
    return (
        F.when(F.isnan(value), BUCKETS + 2)
        .when(value == float("inf"), BUCKETS + 1)
        .when(value == float("-inf"), -BUCKETS - 1)
        .otherwise(F.floor(value / (1.0 + F.abs(value)) * BUCKETS).cast("int"))
    )


def left_join_nullsafe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys that may be null; the keys of ``left`` stay."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys])
    return left.join(renamed, same, "left").drop(*[f"_r_{k}" for k in keys])


def spread_median(df: DataFrame, keys: list[str], value: str, alias: str) -> DataFrame:
    """Exact median per group without ever holding one group in one task.

    Equal values are combined first; a histogram of at most 2052 rows per group then tells which one
    or two buckets hold the middle ranks, and only rows of those buckets are ordered. Null values are
    left out: a group of nothing else gives no row.
    """
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_bucket", value_bucket(F.col(value)))
    )
    group = W.partitionBy(*keys)
    middle = (
        counted.groupBy(*keys, "_bucket")
        .agg(F.sum("_n").alias("_in_bucket"))
        .withColumn("_upto", F.sum("_in_bucket").over(group.orderBy("_bucket")))
        .withColumn("_total", F.sum("_in_bucket").over(group))
        .withColumn("_before", F.col("_upto") - F.col("_in_bucket"))
        .withColumn("_lo", F.floor((F.col("_total") - 1) / 2))
        .withColumn("_hi", F.floor(F.col("_total") / 2))
        .where(
            ((F.col("_before") <= F.col("_lo")) & (F.col("_lo") < F.col("_upto")))
            | ((F.col("_before") <= F.col("_hi")) & (F.col("_hi") < F.col("_upto")))
        )
        .select(*keys, "_bucket", "_before", "_lo", "_hi")
    )
    inside = W.partitionBy(*keys, "_bucket").orderBy(value)
    ranked = (
        left_join_nullsafe(counted, middle, [*keys, "_bucket"])
        .where(F.col("_before").isNotNull())
        .withColumn("_end", F.col("_before") + F.sum("_n").over(inside))
        .withColumn("_begin", F.col("_end") - F.col("_n"))
    )

    def at(rank: str) -> Column:
        return F.max(F.when((F.col("_begin") <= F.col(rank)) & (F.col(rank) < F.col("_end")), F.col(value)))

    return ranked.groupBy(*keys).agg(((at("_lo") + at("_hi")) / 2.0).alias(alias))
