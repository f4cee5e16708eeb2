"""Token usage and timings of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values
PHASES = ("pipeline", "prepare", "test", "evaluate", "analyze", "store")


def token_usage(calls: DataFrame, key: list[str]) -> DataFrame:
    """Tokens and calls per phase and per run (null phase); the run's model is the first, a phase's the last."""
    named = F.when(F.col("model") != "", F.col("model"))
    seq = F.when(named.isNotNull(), F.col("seq"))
    rolled = calls.groupingSets([[*key, "phase"], key], *key, "phase").agg(
        F.grouping("phase").alias("_level"),
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"),
        F.count(F.lit(1)).alias("call_count"),
        F.min_by(named, seq).alias("_first"),
        F.max_by(named, seq).alias("_last"),
    )
    return rolled.select(
        *key,
        "phase",
        "prompt_tokens",
        "completion_tokens",
        (F.col("prompt_tokens") + F.col("completion_tokens")).alias("total_tokens"),
        "call_count",
        F.when(F.col("_level") == 1, F.col("_first")).otherwise(F.col("_last")).alias("model_name"),
    )


def phase_durations(timings: DataFrame, key: list[str]) -> DataFrame:
    """Milliseconds per phase as columns; the phase that started last wins."""
    ms = F.floor((F.col("end_time") - F.col("start_time")) * 1000).cast("bigint")
    columns = [
        F.max_by(F.when(F.col("phase") == p, ms), F.when(F.col("phase") == p, F.col("start_time"))).alias(f"{p}_duration_ms")
        for p in PHASES
    ]
    return timings.groupBy(*key).agg(*columns)


def observability_rows(usage: DataFrame, durations: DataFrame, key: list[str]) -> DataFrame:
    """One metrics row per run that used tokens; zero totals become null."""
    runs = usage.where(F.col("phase").isNull() & (F.col("total_tokens") > 0))
    zero = F.lit(0).cast("bigint")
    return runs.join(durations, key, "left").select(
        *key,
        "model_name",
        *[f"{p}_duration_ms" for p in PHASES],
        F.nullif("prompt_tokens", zero).alias("total_prompt_tokens"),
        F.nullif("completion_tokens", zero).alias("total_completion_tokens"),
        "total_tokens",
        F.nullif("call_count", zero).alias("llm_calls_count"),
    )
