"""Gate policy, combination of gate results into a verdict, and scorecard counters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialmill.functions.stats import ratio
from trialmill.functions.text import decimals

# Fixed values
DEFAULT_MODE = "warn"
DEFAULT_COMBINATION = "all_pass"
DEFAULT_WEIGHT = 1.0
PASS_BAND = 0.7
WARN_BAND = 0.5
GATE_ORDER = (
    ("engine", "evaluation"),
    ("security", "security"),
    ("quality", "quality"),
    ("behavioral", "behavioral"),
)


def apply_gate_policy(
    rows: DataFrame, items: DataFrame, defaults: DataFrame | None = None, key: str = "submission_name"
) -> DataFrame:
    """Add mode, threshold, weight and push_fact to rows with a ``gate_name``.

    ``items``: key, gate_name, mode, threshold, weight, push_fact. ``defaults``: key, combination,
    default_mode. A gate without an item takes the default mode and weight 1. A size-checked broadcast
    is left to the optimizer, because both tables grow with the number of submissions.
    """
    own = items.select(
        key,
        "gate_name",
        F.col("mode").alias("_mode"),
        F.col("threshold").alias("policy_threshold"),
        F.col("weight").alias("_weight"),
        F.col("push_fact").alias("_push"),
    )
    joined = rows.join(own, [key, "gate_name"], "left")
    fallback = F.lit(DEFAULT_MODE)
    if defaults is not None:
        joined = joined.join(defaults.select(key, "combination", "default_mode"), key, "left").withColumn(
            "combination", F.coalesce("combination", F.lit(DEFAULT_COMBINATION))
        )
        fallback = F.coalesce("default_mode", F.lit(DEFAULT_MODE))
    return (
        joined.withColumn("mode", F.coalesce("_mode", fallback))
        .withColumn("weight", F.coalesce("_weight", F.lit(DEFAULT_WEIGHT)))
        .withColumn("push_fact", F.coalesce("_push", F.lit(False)))
        .drop("_mode", "_weight", "_push", "default_mode")
    )


def drop_disabled(
    gates: DataFrame, items: DataFrame, defaults: DataFrame | None = None, key: str = "submission_name"
) -> DataFrame:
    """Leave out gates whose implementation (``policy_key``) is switched off; engine gates always stay.

    A disabled *category* is not left out: its gate row says so and passes with score 1.0.
    """
    own = items.select(key, F.col("gate_name").alias("policy_key"), F.col("mode").alias("_own"))
    joined = gates.join(own, [key, "policy_key"], "left")
    mode = F.coalesce("_own", F.lit(DEFAULT_MODE))
    if defaults is not None:
        joined = joined.join(defaults.select(key, "default_mode"), key, "left")
        mode = F.coalesce("_own", "default_mode", F.lit(DEFAULT_MODE))
    return joined.where((mode != "disabled") | (F.col("gate_type") == "engine")).drop("_own", "default_mode")


def union_gates(*gates: DataFrame) -> DataFrame:
    """Gate rows of all engines and scanners; columns one producer lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), gates)


def gate_rank(gate_type: Column) -> Column:
    """Engines, security, quality, behavioural; add a registration number inside a type."""
    rank = F.lit(len(GATE_ORDER))
    for i, (kind, _) in reversed(list(enumerate(GATE_ORDER))):
        rank = F.when(gate_type == kind, F.lit(i)).otherwise(rank)
    return rank


def _names(condition: Column) -> Column:
    """Gate names of one run in gate order. A run has at most one row per registered gate."""
    ordered = F.array_sort(F.collect_list(F.when(condition, F.struct("gate_order", "gate_name"))))
    return F.array_join(F.transform(ordered, lambda g: g["gate_name"]), ", ")


def combine(gates: DataFrame, key: list[str], runs: DataFrame | None = None) -> DataFrame:
    """Verdict and counters per run from gate rows carrying ``combination``, ``mode`` and ``weight``.

    With ``runs`` (key and combination) given, runs without any gate appear too, as failed.
    """
    block, warn, ok = F.col("mode") == "block", F.col("mode") == "warn", F.col("passed")
    score, weight = F.col("score"), F.col("weight")
    totals = gates.groupBy(*key).agg(
        F.max("combination").alias("_combination"),
        F.count(F.lit(1)).alias("n_gates"),
        F.count_if(ok).alias("gates_passed"),
        F.count_if(~ok).alias("gates_failed"),
        F.count_if(block).alias("n_blocking"),
        F.count_if(block & ok).alias("blocking_gates_passed"),
        F.count_if(block & ~ok).alias("blocking_gates_failed"),
        F.count_if(warn & ~ok).alias("warning_gates_failed"),
        F.avg("score").alias("_mean"),
        F.sum(F.when(block, score * weight)).alias("_weighted"),
        F.sum(F.when(block, weight)).alias("_weights"),
        _names(block & ~ok).alias("_failed_blocking"),
        _names(warn & ~ok).alias("_failed_warning"),
        _names(block & ok).alias("_passed_blocking"),
        _names(block).alias("_blocking"),
    )
    if runs is not None:
        totals = runs.select(*key, F.col("combination").alias("_of_run")).join(totals, key, "left").withColumn(
            "_combination", F.coalesce("_combination", "_of_run")
        ).drop("_of_run")
    counters = ["n_gates", "gates_passed", "gates_failed", "n_blocking", "blocking_gates_passed",
                "blocking_gates_failed", "warning_gates_failed"]
    totals = totals.withColumns({c: F.coalesce(c, F.lit(0)) for c in counters})
    mean = F.when(F.col("n_blocking") == 0, F.col("_mean")).otherwise(
        ratio(F.col("_weighted"), F.col("_weights"), 0.0)
    )
    # sums arrive in any order, so the last bits are dropped before they meet the band limits
    totals = totals.withColumn("weighted_score", F.when(F.col("n_gates") > 0, F.round(mean, 12)))
    total = F.col("weighted_score")
    all_pass = F.col("_combination") == "all_pass"
    any_pass = F.col("_combination") == "any_pass"
    weighted = F.col("_combination") == "weighted"
    none = F.col("n_gates") == 0
    blocked = F.col("blocking_gates_failed") > 0
    warned = F.col("warning_gates_failed") > 0
    free = F.col("n_blocking") == 0
    let_through = F.col("blocking_gates_passed") > 0
    shown = decimals(total, 2)
    verdict = (
        F.when(none, "fail")
        .when(all_pass & blocked, "fail")
        .when(all_pass & warned, "warn")
        .when(all_pass, "pass")
        .when(any_pass & (free | let_through), "pass")
        .when(any_pass, "fail")
        .when(weighted & (total >= PASS_BAND), "pass")
        .when(weighted & (total >= WARN_BAND), "warn")
        .otherwise("fail")
    )
    reason = (
        F.when(none, "No gates evaluated")
        .when(all_pass & blocked, F.concat(F.lit("Blocking gates failed: "), "_failed_blocking"))
        .when(all_pass & warned, F.concat(F.lit("Warning gates failed: "), "_failed_warning"))
        .when(all_pass, "All gates passed")
        .when(any_pass & free, "No blocking gates configured")
        .when(any_pass & let_through, F.concat(F.lit("Blocking gates passed: "), "_passed_blocking"))
        .when(any_pass, F.concat(F.lit("No blocking gates passed: "), "_blocking"))
        .when(weighted & (total >= PASS_BAND), F.concat(F.lit("Weighted score "), shown, F.lit(" >= 0.70")))
        .when(weighted & (total >= WARN_BAND), F.concat(F.lit("Weighted score "), shown, F.lit(" between 0.50-0.70")))
        .when(weighted, F.concat(F.lit("Weighted score "), shown, F.lit(" < 0.50")))
        .otherwise(F.concat(F.lit("Unknown combination mode: "), "_combination"))
    )
    return totals.select(
        *key,
        F.col("_combination").alias("combination_mode"),
        verdict.alias("recommendation"),
        reason.alias("recommendation_reason"),
        *counters[1:3], *counters[4:6], "weighted_score",
    )
