"""Gate policies and certification policies: own, named profile, defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialmill.operators.certify import CHECK_IDS, DEFAULT_PROFILE, LEVELS, PROFILES

ITEM_SCHEMA = "submission_name string, gate_name string, mode string, threshold double, weight double, push_fact boolean"


def available_profiles() -> list[str]:
    return list(PROFILES)


def load_profile(name: str | None = None) -> dict[str, tuple[str, ...]]:
    """Checks per level; an unknown profile or check raises."""
    chosen = name or DEFAULT_PROFILE
    if chosen not in PROFILES:
        raise ValueError(f"Unknown certification profile '{chosen}'. Available: {available_profiles()}")
    for level in LEVELS:
        bad = [c for c in PROFILES[chosen][level] if c not in CHECK_IDS]
        if bad:
            raise ValueError(f"Invalid check ids {bad}")
    return PROFILES[chosen]


def gate_policy_items(policies: DataFrame) -> DataFrame:
    """Policy items from submissions' JSON policies (submission_name, policy VARIANT)."""
    items = policies.select(
        "submission_name", F.explode(F.try_variant_get("policy", "$.gates", "map<string,variant>")).alias("gate_name", "_i")
    )
    return items.select(
        "submission_name",
        "gate_name",
        F.coalesce(F.try_variant_get("_i", "$.mode", "string"), F.lit("warn")).alias("mode"),
        F.try_variant_get("_i", "$.threshold", "double").alias("threshold"),
        F.coalesce(F.try_variant_get("_i", "$.weight", "double"), F.lit(1.0)).alias("weight"),
        F.coalesce(F.try_variant_get("_i", "$.push_fact", "boolean"), F.lit(False)).alias("push_fact"),
    )


def gate_policy_defaults(policies: DataFrame) -> DataFrame:
    return policies.select(
        "submission_name",
        F.coalesce(F.try_variant_get("policy", "$.combination", "string"), F.lit("all_pass")).alias("combination"),
        F.coalesce(F.try_variant_get("policy", "$.default_mode", "string"), F.lit("warn")).alias("default_mode"),
    )


def empty_items(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ITEM_SCHEMA)
