"""Variant summaries, A/B comparison and verdict of every run in one pass over its trials."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialmill.functions.stats import fisher_p, ratio, welch_p
from trialmill.operators.hot import left_join_nullsafe, spread_median

# Fixed values
VARIANTS = ("treatment", "control")
RUN_KEYS = ["submission_name", "pipeline_run_id", "eval_engine"]
RELIABLE_TRIALS = 15
SINGLE_VARIANT_THRESHOLD = 0.5


def passed(reward: Column) -> Column:
    """A trial passes when its reward is present and above 0."""
    return F.coalesce(reward > 0, F.lit(False))


def _counts(variant: str | None) -> list[Column]:
    """Aggregates of one variant; all of them combine on the map side."""
    reward = F.col("reward")
    mine = F.lit(True) if variant is None else F.col("variant") == variant
    head = "" if variant is None else f"{variant}_"
    value = F.when(mine, reward)
    return [
        F.count_if(mine).alias(f"{head}n_trials"),
        F.count_if(mine & passed(reward)).alias(f"{head}n_passed"),
        F.count_if(mine & reward.isNull()).alias(f"{head}n_errors"),
        F.avg(value).alias(f"{head}mean_reward"),
        F.stddev_samp(value).alias(f"{head}std_reward"),
    ]


def _derived(head: str) -> dict[str, Column]:
    n, ok, bad = (F.col(f"{head}{c}") for c in ("n_trials", "n_passed", "n_errors"))
    return {
        f"{head}n_failed": n - ok - bad,
        f"{head}pass_rate": ratio(ok, n, 0.0),
    }


def _summary_columns(head: str) -> list[str]:
    names = "n_trials n_passed n_failed n_errors pass_rate mean_reward median_reward std_reward"
    return [head + name for name in names.split()]


def variant_summary(trials: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Counts, pass rate over all trials, and mean, median and deviation over rewarded trials, per variant.

    One path for runs of any size: the aggregates have buffers of fixed size, and the median spreads each run.
    """
    keys = [*(keys or RUN_KEYS), "variant"]
    rows = trials.select(*keys, "reward")
    counts = rows.groupBy(*keys).agg(*_counts(None))
    both = left_join_nullsafe(counts, spread_median(rows, keys, "reward", "median_reward"), keys)
    return both.withColumns(_derived("")).select(*keys, *_summary_columns(""))


def paired_summary(trials: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per run with both variants side by side; a variant without trials has zero counts."""
    keys = keys or RUN_KEYS
    rows = trials.select(*keys, "variant", "reward")
    counts = rows.groupBy(*keys).agg(*[c for v in VARIANTS for c in _counts(v)])
    medians = spread_median(rows.where(F.col("variant").isin(*VARIANTS)), [*keys, "variant"], "reward", "_median")
    sides = medians.groupBy(*keys).agg(
        *[F.max(F.when(F.col("variant") == v, F.col("_median"))).alias(f"{v}_median_reward") for v in VARIANTS]
    )
    both = left_join_nullsafe(counts, sides, keys)
    for v in VARIANTS:
        both = both.withColumns(_derived(f"{v}_"))
    return both.select(*keys, *[c for v in VARIANTS for c in _summary_columns(f"{v}_")])


def ab_verdict(paired: DataFrame, threshold: Column | float = 0.0) -> DataFrame:
    """Uplift, gap, p-values and recommendation for paired summaries."""
    threshold = threshold if isinstance(threshold, Column) else F.lit(threshold)
    t = {c: F.col(f"treatment_{c}") for c in ("n_trials", "n_passed", "n_failed", "n_errors", "pass_rate",
                                              "mean_reward", "std_reward")}
    c = {k: F.col(f"control_{k}") for k in t}
    gap = t["mean_reward"] - c["mean_reward"]
    # rewards are added in any order, so the last bits are cut before the threshold
    primary = F.round(F.coalesce(F.col("mean_reward_gap"), F.col("uplift")), 12)
    empty_side = (t["n_trials"] == 0) | (c["n_trials"] == 0)
    nobody = (t["n_passed"] == 0) & (c["n_passed"] == 0)
    small = F.lit(False)
    for side in (t, c):
        small = small | ((side["n_trials"] > 0) & (side["n_trials"] < RELIABLE_TRIALS))
    return (
        paired.withColumn("uplift", t["pass_rate"] - c["pass_rate"])
        .withColumn("mean_reward_gap", gap)
        .withColumn(
            "ttest_p_value",
            welch_p(
                t["n_trials"] - t["n_errors"], t["mean_reward"], t["std_reward"] * t["std_reward"],
                c["n_trials"] - c["n_errors"], c["mean_reward"], c["std_reward"] * c["std_reward"],
            ),
        )
        .withColumn("fisher_p_value", fisher_p(t["n_passed"], t["n_failed"], c["n_passed"], c["n_failed"]))
        .withColumn("small_sample", small)
        .withColumn(
            "recommendation",
            F.when(empty_side | nobody | (primary < threshold), "fail").otherwise("pass"),
        )
    )


def analyse_ab_runs(trials: DataFrame, threshold: Column | float = 0.0, keys: list[str] | None = None) -> DataFrame:
    """Trials of all runs to one analysed row per run."""
    return ab_verdict(paired_summary(trials, keys), threshold)


def analyse_single_runs(trials: DataFrame, threshold: float = 0.0, keys: list[str] | None = None) -> DataFrame:
    """Single-variant verdict: mean reward against the threshold, 0.5 where none is set."""
    keys = keys or RUN_KEYS
    floor = threshold if threshold > 0 else SINGLE_VARIANT_THRESHOLD
    summary = variant_summary(trials.withColumn("variant", F.lit("treatment")), keys)
    mean = F.round(F.coalesce(F.col("mean_reward"), F.lit(0.0)), 12)
    ok = (F.col("n_trials") > 0) & (F.col("n_passed") > 0) & (mean >= floor)
    return (
        summary.withColumn("uplift", F.col("pass_rate"))
        .withColumn("mean_reward_gap", F.col("mean_reward"))
        .withColumn("small_sample", (F.col("n_trials") > 0) & (F.col("n_trials") < RELIABLE_TRIALS))
        .withColumn("recommendation", F.when(ok, "pass").otherwise("fail"))
    )


def quick_mean(results: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Quick mean reward: a nested reward of 0 falls through to the flat one, missing counts as 0."""
    keys = keys or RUN_KEYS
    reward = F.coalesce(F.nullif("nested_reward", F.lit(0.0)), "flat_reward", F.lit(0.0))
    return results.groupBy(*keys).agg(F.coalesce(F.avg(reward), F.lit(0.0)).alias("mean_reward"))
