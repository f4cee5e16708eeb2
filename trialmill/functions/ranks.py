"""Positions of rows within their key, without a window over a key's rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialmill.session import reliable_checkpoint

#: Bits that ``monotonically_increasing_id`` gives a row within its partition.
ROW_BITS = 33


def positions(
    rows: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[Column | str] | None = None,
    written: Callable[[DataFrame], DataFrame] = reliable_checkpoint,
) -> DataFrame:
    """The rows with ``position`` (1, 2, ... within their keys, by ``order``), ``rows_of_key`` and ``part``.

    Rows are dealt by ranges of (keys, order), so that a key with most of the rows spreads over partitions. A row's
    place in its partition, less that of its key's first row there, plus the key's rows in earlier partitions, is
    its position: what is counted and joined is one row per key and partition. ``columns`` are those to keep, of
    which the ones named in ``keys`` must be part; ``written`` cuts the lineage, as positions hold only for one run
    of the sort. Null keys are one key; rows that tie in ``order`` get adjacent positions. (key, ``part``) is a
    join key that no single key can crowd.
    """
    place = F.monotonically_increasing_id()
    dealt = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    kept = written(dealt.select(*(columns or rows.columns), place.alias("_at")))
    kept = kept.withColumn("part", F.shiftright("_at", ROW_BITS).cast("int"))
    blocks = kept.groupBy(*keys, "part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    key = Window.partitionBy(*keys)
    earlier = F.sum("_n").over(key.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("part").alias("_part"), "_first", F.coalesce(earlier, F.lit(0)).alias("_before"), F.sum("_n").over(key).alias("rows_of_key"))
    same = F.col("part") == F.col("_part")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    found = kept.join(blocks, same).withColumn("position", F.col("_at") - F.col("_first") + F.col("_before") + 1)
    return found.drop("_at", "_n", "_first", "_before", "_part", *(f"_{k}" for k in keys))
