"""Pairwise comparison of treatment and control runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialmill.functions.stats import ratio

# Fixed values
PAIRWISE_THRESHOLD = 0.5


def count_outcomes(cases: DataFrame, key: list[str]) -> DataFrame:
    """Wins, ties and errors per run from case rows with ``winner`` (A, B, tie) and ``error``."""
    failed = F.col("error").isNotNull() & (F.col("error") != "")
    return cases.groupBy(*key).agg(
        F.count_if(~failed & (F.col("winner") == "A")).alias("wins_a"),
        F.count_if(~failed & (F.col("winner") == "B")).alias("wins_b"),
        F.count_if(~failed & (F.col("winner") == "tie")).alias("ties"),
        F.count_if(failed).alias("errors"),
    )


def pairwise_outcome(counts: DataFrame, threshold: Column | float = PAIRWISE_THRESHOLD) -> DataFrame:
    """Win rate over wins, ties and errors. Only ties (no error) passes; missing counts are 0."""
    limit = threshold if isinstance(threshold, Column) else F.lit(threshold)
    df = counts.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("wins_a", "wins_b", "ties", "errors")})
    decisive = F.col("wins_a") + F.col("wins_b")
    df = df.withColumn("total", decisive + F.col("ties") + F.col("errors")).withColumn("decisive", decisive)
    all_ties = (F.col("decisive") == 0) & (F.col("ties") > 0) & (F.col("errors") == 0)
    return (
        df.withColumn("win_rate", ratio(F.col("wins_a"), F.col("total"), 0.0))
        .withColumn("all_ties", all_ties)
        .withColumn("passed", all_ties | (F.col("win_rate") >= limit))
        .withColumn("recommendation", F.when(F.col("passed"), "pass").otherwise("fail"))
    )


def pairwise_report(outcomes: DataFrame, runs: DataFrame, key: list[str]) -> DataFrame:
    """Report row: the treatment's rate is its win rate, the control's its wins over the total.

    ``runs``: key, variant, n_cases, mean_reward; the control run may be missing.
    """

    def side(variant: str) -> DataFrame:
        return runs.where(F.col("variant") == variant).select(
            *key, F.col("n_cases").alias(f"{variant}_n_trials"), F.col("mean_reward").alias(f"{variant}_mean_reward")
        )

    df = outcomes.join(side("treatment"), key).join(side("control"), key, "left")
    df = df.withColumn("control_n_trials", F.coalesce("control_n_trials", F.lit(0)))
    zero = F.lit(0)
    control_rate = ratio(F.col("wins_b"), F.col("total"), 0.0)
    return df.select(
        *key,
        "treatment_n_trials",
        F.col("wins_a").alias("treatment_n_passed"),
        F.greatest(F.col("treatment_n_trials") - F.col("wins_a"), zero).alias("treatment_n_failed"),
        F.col("win_rate").alias("treatment_pass_rate"),
        "treatment_mean_reward",
        "control_n_trials",
        F.col("wins_b").alias("control_n_passed"),
        F.greatest(F.col("control_n_trials") - F.col("wins_b"), zero).alias("control_n_failed"),
        control_rate.alias("control_pass_rate"),
        "control_mean_reward",
        (F.col("win_rate") - control_rate).alias("uplift"),
        (
            F.coalesce("treatment_mean_reward", F.lit(0.0)) - F.coalesce("control_mean_reward", F.lit(0.0))
        ).alias("mean_reward_gap"),
        "recommendation",
    )


def pairwise_findings(cases: DataFrame, key: list[str]) -> DataFrame:
    """Comparison errors (high) and cases the control won (medium)."""
    failed = F.col("error").isNotNull() & (F.col("error") != "")
    case = F.coalesce("case_id", F.lit("unknown"))
    return cases.where(failed | (F.col("winner") == "B")).select(
        *key,
        F.when(failed, "high").otherwise("medium").alias("severity"),
        F.when(failed, F.concat(F.lit("Case "), case, F.lit(" comparison error: "), F.col("error")))
        .otherwise(F.concat(F.lit("Case "), case, F.lit(": control beat treatment")))
        .alias("message"),
        case.alias("location"),
        F.when(failed, "aeh-pairwise-error").otherwise("aeh-control-wins").alias("rule_id"),
    )
