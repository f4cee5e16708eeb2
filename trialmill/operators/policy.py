"""Operational policy: resources, timeouts, error handling and logging of a submission."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialmill.operators.textscan import logging_suppression, swallowed_errors

# Fixed values
MAX_CPUS = 4
MAX_MEMORY_MB = 8192
MAX_TIMEOUT_SEC = 3600.0
DEFAULTS = {"cpus": 1, "memory_mb": 2048, "agent_timeout_sec": 600.0}
HIGH_PENALTY = 0.35
LOW_PENALTY = 0.15
SUB = "submission_name"


def resource_issues(metadata: DataFrame) -> DataFrame:
    """Undeclared fields (low) and requests beyond the limits (high).

    ``metadata``: submission_name, cpus, memory_mb, agent_timeout_sec (null: not declared) and
    optionally max_cpus, max_memory_mb, max_agent_timeout_sec.
    """
    have = set(metadata.columns)

    def limit(name: str, value):
        return F.coalesce(F.col(name), F.lit(value)) if name in have else F.lit(value)

    asked = {name: F.coalesce(F.col(name), F.lit(value)) for name, value in DEFAULTS.items()}
    wanted = F.array(*[F.lit(x) for x in DEFAULTS])
    declared = F.array_compact(F.array(*[F.when(F.col(x).isNotNull(), x) for x in DEFAULTS]))
    missing = F.array_except(wanted, declared)
    over = {
        "CPU request": asked["cpus"] > limit("max_cpus", MAX_CPUS),
        "Memory request": asked["memory_mb"] > limit("max_memory_mb", MAX_MEMORY_MB),
        "Agent timeout": asked["agent_timeout_sec"] > limit("max_agent_timeout_sec", MAX_TIMEOUT_SEC),
    }
    issues = [
        F.when(
            F.size(missing) > 0,
            F.struct(
                F.lit("low").alias("severity"),
                F.concat(F.lit("Resource fields not explicitly declared: "), F.array_join(missing, ", ")).alias("message"),
            ),
        )
    ]
    for what, broken in over.items():
        text = F.lit(f"{what} exceeds max allowed")
        issues.append(F.when(broken, F.struct(F.lit("high").alias("severity"), text.alias("message"))))
    return metadata.select(SUB, F.inline(F.array_compact(F.array(*issues))))


def operational_policy(submissions: DataFrame, metadata: DataFrame, files: DataFrame) -> DataFrame:
    """Verdict and score per submission; switched off (the default) it passes with 1.0.

    ``submissions``: submission_name, enabled. Each high issue costs 0.35 and each low one 0.15.
    """
    issues = reduce(
        lambda a, b: a.unionByName(b),
        [
            resource_issues(metadata),
            swallowed_errors(files).select(SUB, "severity", "message"),
            logging_suppression(files).select(SUB, "severity", "message"),
        ],
    )
    counted = issues.groupBy(SUB).agg(
        F.count_if(F.col("severity") == "high").alias("_high"), F.count_if(F.col("severity") == "low").alias("_low")
    )
    df = submissions.join(counted, SUB, "left")
    on = F.coalesce("enabled", F.lit(False))
    high = F.when(on, F.coalesce("_high", F.lit(0))).otherwise(0)
    low = F.when(on, F.coalesce("_low", F.lit(0))).otherwise(0)
    return df.select(
        SUB,
        (high == 0).alias("passed"),
        F.greatest(F.lit(0.0), 1.0 - (high * F.lit(HIGH_PENALTY) + low * F.lit(LOW_PENALTY))).alias("score"),
        high.cast("bigint").alias("high_issues"),
        low.cast("bigint").alias("low_issues"),
    )
