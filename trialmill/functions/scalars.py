"""Small rules on single values and on edge-case grading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialmill.functions.stats import ratio

# Fixed values
EDGE_CASE_THRESHOLD = 0.5


def trial_reward(doc: Column) -> Column:
    """Nested reward first, else the flat one; null where neither is present."""
    return F.coalesce(
        F.try_variant_get(doc, "$.verifier_result.rewards.reward", "double"),
        F.try_variant_get(doc, "$.verifier_result.reward", "double"),
    )


def case_of_trial(trial_dir: Column) -> Column:
    return F.split_part(trial_dir, F.lit("__"), F.lit(1))


def content_key(raw: Column) -> Column:
    """Run key from the content where no run id is given."""
    return F.concat(F.lit("content-"), F.substring(F.sha2(raw, 256), 1, 16))


def edge_case_results(cases: DataFrame, gradings: DataFrame, key: list[str]) -> DataFrame:
    """Passed over total of each case's gradings; a corrupt file or no total fails with 0.0.

    ``cases`` lists every case, so one without gradings still appears.
    """
    totals = gradings.groupBy(*key).agg(
        F.sum("n_passed").alias("_p"), F.sum("n_total").alias("_t"), F.bool_or("corrupt").alias("_bad")
    )
    good = ~F.coalesce("_bad", F.lit(False)) & (F.coalesce("_t", F.lit(0)) > 0)
    score = F.when(good, ratio(F.col("_p"), F.col("_t"), 0.0)).otherwise(0.0)
    return cases.join(totals, key, "left").select(
        *key, (good & (score >= EDGE_CASE_THRESHOLD)).alias("passed"), score.alias("score")
    )
