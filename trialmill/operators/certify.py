"""Three-level certification of every run from its gate rows and run facts.

The gate rows of a run fold into one row by plain numeric aggregates (one shuffle on the run key, hash
aggregation, map-side combine); all checks, levels and the hierarchy are then columns of that row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trialmill.functions.stats import ratio

# Fixed values
LEVELS = ("foundational", "trusted", "certified")
FOUNDATIONAL_CHECKS = (
    "valid_skill_structure",
    "basic_security_validation",
    "basic_execution_validation",
    "content_quality_review",
    "metadata_compliance",
)
TRUSTED_CHECKS = (
    "evaluation_assets",
    "advanced_security_validation",
    "functional_validation",
    "instruction_quality",
    "operational_policy_compliance",
)
CERTIFIED_CHECKS = (
    "enterprise_structure_validation",
    "enterprise_security_review",
    "enterprise_behavioral_testing",
    "advanced_agent_validation",
)
UNASSIGNED_CHECKS = (
    "registry_governance",
    "efficiency_cost_profiling",
    "data_privacy_pii_handling",
    "continuous_optimization",
    "safety_toxicity_bias_guardrails",
    "resilience_chaos_testing",
)
CHECK_IDS = FOUNDATIONAL_CHECKS + TRUSTED_CHECKS + CERTIFIED_CHECKS + UNASSIGNED_CHECKS
DEFAULT_CHECKS = {
    "foundational": FOUNDATIONAL_CHECKS,
    "trusted": TRUSTED_CHECKS,
    "certified": CERTIFIED_CHECKS,
}
DEFAULT_PROFILE = "skill"
PROFILES = {
    "skill": {
        "foundational": FOUNDATIONAL_CHECKS,
        "trusted": (
            "evaluation_assets",
            "functional_validation",
            "instruction_quality",
            "operational_policy_compliance",
        ),
        "certified": (
            "enterprise_structure_validation",
            "enterprise_behavioral_testing",
            "advanced_agent_validation",
        ),
    },
    "mcp_server": {
        "foundational": ("valid_skill_structure", "basic_security_validation", "metadata_compliance"),
        "trusted": ("evaluation_assets", "functional_validation"),
        "certified": ("enterprise_structure_validation", "enterprise_security_review"),
    },
    "plugin": {
        "foundational": ("valid_skill_structure", "basic_security_validation", "metadata_compliance"),
        "trusted": ("evaluation_assets", "advanced_security_validation", "functional_validation"),
        "certified": ("enterprise_structure_validation", "enterprise_security_review"),
    },
    "agent": {
        "foundational": (
            "valid_skill_structure",
            "basic_security_validation",
            "basic_execution_validation",
            "metadata_compliance",
        ),
        "trusted": (
            "evaluation_assets",
            "functional_validation",
            "instruction_quality",
            "operational_policy_compliance",
        ),
        "certified": ("enterprise_structure_validation", "advanced_agent_validation"),
    },
    "full": {
        "foundational": FOUNDATIONAL_CHECKS,
        "trusted": TRUSTED_CHECKS,
        "certified": (
            "enterprise_structure_validation",
            "enterprise_security_review",
            "advanced_agent_validation",
        ),
    },
}
THRESHOLDS = {
    "advanced_agent_validation": 0.8,
    "advanced_security_validation": 0.9,
    "instruction_quality": 0.7,
}
BEHAVIOR_WEIGHTS = {"consistency": 0.3, "edge_case": 0.3, "stability": 0.2, "failure_mode": 0.2}
CONSISTENCY_THRESHOLD = 0.3
STABILITY_THRESHOLD = 0.1
STABILITY_RUNS = 3
EDGE_CASE_THRESHOLD = 0.5
FAILURE_MODE_THRESHOLD = 0.5
MIN_ACTIVE_SUB_CHECKS = 2

_PASS_BIT = 1 << 52  # above any gate order


def profile_table(spark: SparkSession) -> DataFrame:
    """Profiles as a small table: profile and the checks of each level."""
    rows = [(name, *[list(levels[x]) for x in LEVELS]) for name, levels in PROFILES.items()]
    fields = ", ".join(f"{x}_checks array<string>" for x in LEVELS)
    return spark.createDataFrame(rows, f"profile string, {fields}")


def profile_checks(profile: Column | str) -> dict[str, Column]:
    """Required checks per level for a profile column, null where the profile is null."""
    name = F.lit(profile) if isinstance(profile, str) else profile
    chosen = {}
    for level in LEVELS:
        checks = F.lit(None).cast("array<string>")
        for known, levels in PROFILES.items():
            checks = F.when(name == known, F.array(*[F.lit(c) for c in levels[level]])).otherwise(checks)
        unknown = F.raise_error(F.concat(F.lit("unknown certification profile: "), name)).cast("array<string>")
        known_name = name.isNull() | name.isin(*PROFILES)
        chosen[level] = F.when(known_name, checks).otherwise(unknown)
    return chosen


def resolve_policy(runs: DataFrame, own: DataFrame | None, profile: Column | str | None = None) -> DataFrame:
    """Required checks per level and thresholds per check.

    A submission's own policy comes first, then the named profile, then the defaults. ``own`` has one
    row per submission: ``<level>_checks`` and ``<level>_thresholds`` (maps) for the three levels.
    For thresholds the higher level wins.
    """
    df = runs
    has_own = F.lit(False)
    if own is not None:
        df = df.join(own.withColumn("_own", F.lit(True)), "submission_name", "left")
        has_own = F.coalesce("_own", F.lit(False))
    by_profile = profile_checks(profile) if profile is not None else {x: F.lit(None) for x in LEVELS}
    for level in LEVELS:
        default = F.array(*[F.lit(c) for c in DEFAULT_CHECKS[level]])
        from_profile = F.coalesce(by_profile[level].cast("array<string>"), default)
        mine = F.coalesce(F.col(f"{level}_checks"), default) if own is not None else default
        df = df.withColumn(f"required_{level}", F.when(has_own, mine).otherwise(from_profile))
    for check, value in THRESHOLDS.items():
        overrides = [F.col(f"{x}_thresholds").getItem(check) for x in reversed(LEVELS)] if own is not None else []
        df = df.withColumn(f"threshold_{check}", F.coalesce(*overrides, F.lit(value)))
    drop = ["_own", *[f"{x}_checks" for x in LEVELS], *[f"{x}_thresholds" for x in LEVELS]] if own is not None else []
    return df.drop(*drop)


def invalid_check_ids(own: DataFrame) -> DataFrame:
    """Check ids of submissions' own policies that do not exist, and thresholds outside [0, 1]."""
    none = F.array().cast("array<string>")
    asked = F.flatten(
        F.array(
            *[F.coalesce(F.col(f"{x}_checks"), none) for x in LEVELS],
            *[F.coalesce(F.map_keys(F.col(f"{x}_thresholds")), none) for x in LEVELS],
        )
    )
    values = F.flatten(
        F.array(*[F.coalesce(F.map_values(F.col(f"{x}_thresholds")), F.array().cast("array<double>")) for x in LEVELS])
    )
    return own.select(
        "submission_name",
        F.array_except(asked, F.array(*[F.lit(c) for c in CHECK_IDS])).alias("invalid_ids"),
        F.exists(values, lambda v: (v < 0.0) | (v > 1.0)).alias("threshold_out_of_range"),
    ).where((F.size("invalid_ids") > 0) | F.col("threshold_out_of_range"))


def gate_checks() -> dict[str, tuple[str, Column, Column]]:
    """check id -> (gate type, passed, score) over gate rows with their run's thresholds."""
    score, ok, found = F.col("score"), F.col("passed"), F.col("findings_count")
    advanced = ok & (score >= F.col("threshold_advanced_security_validation"))
    return {
        "basic_execution_validation": ("engine", ok, score),
        "functional_validation": ("engine", ok, score),
        "advanced_agent_validation": ("engine", score >= F.col("threshold_advanced_agent_validation"), score),
        "basic_security_validation": ("security", ok, score),
        "advanced_security_validation": ("security", advanced, score),
        "enterprise_security_review": (
            "security",
            advanced & (found == 0),
            F.greatest(F.lit(0.0), 1.0 - found * F.lit(0.1)),
        ),
        "content_quality_review": ("quality", ok, score),
        "instruction_quality": ("quality", score >= F.col("threshold_instruction_quality"), score),
    }


def merge_gate_checks(gates: DataFrame, key: list[str]) -> DataFrame:
    """One row per run; per check the first failing gate result, else the first passing one.

    Rank and result are packed into numbers so that the aggregation hashes on primitive buffers. A
    ``gate_order`` that would not fit beside the result raises.
    """
    order = F.when(F.col("gate_order").between(0, _PASS_BIT - 1), F.col("gate_order")).when(
        F.col("gate_order").isNotNull(), F.raise_error(F.lit("gate_order out of range")).cast("bigint")
    )
    aggregates = []
    for check, (kind, ok, score) in gate_checks().items():
        rank = F.when(
            F.col("gate_type") == kind,
            F.when(ok, F.lit(_PASS_BIT)).otherwise(F.lit(0).cast("bigint")) + order,
        )
        aggregates += [F.min(rank).alias(f"_rank_{check}"), F.min_by(score, rank).alias(f"_score_{check}")]
    return gates.groupBy(*key).agg(*aggregates)


def _result(passed: Column, score: Column, source: Column | None = None) -> Column:
    return F.struct(
        passed.alias("passed"),
        score.cast("double").alias("score"),
        (F.lit(None).cast("string") if source is None else source).alias("source_gate"),
    )


def _flag(passed: Column) -> Column:
    ok = F.coalesce(passed, F.lit(False))
    return _result(ok, F.when(ok, 1.0).otherwise(0.0))


def behavior_sub_checks() -> dict[str, tuple[Column, Column, Column]]:
    """sub-check -> (has data, passed, score)."""
    std, variance, runs = F.col("std_reward"), F.col("score_variance"), F.col("stability_runs")
    total, good = F.col("edge_total"), F.col("edge_passed")
    failure = F.col("failure_mode_score")
    limit = F.coalesce("failure_mode_threshold", F.lit(FAILURE_MODE_THRESHOLD))

    def calm(x: Column, threshold: float) -> Column:
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - 0.5 * (x / threshold)))

    drift = F.coalesce(variance, F.lit(0.0))
    share = ratio(good, total)
    return {
        "consistency": (std.isNotNull(), std <= CONSISTENCY_THRESHOLD, calm(std, CONSISTENCY_THRESHOLD)),
        "edge_case": (F.coalesce(total, F.lit(0)) > 0, share >= EDGE_CASE_THRESHOLD, share),
        "stability": (
            F.coalesce(runs, F.lit(0)) >= STABILITY_RUNS,
            drift <= STABILITY_THRESHOLD,
            calm(drift, STABILITY_THRESHOLD),
        ),
        "failure_mode": (failure.isNotNull(), failure >= limit, failure),
    }


def behavior_composite(facts: DataFrame) -> DataFrame:
    """Weighted score over sub-checks with data; passes when at least two have data and none of them fails."""
    weight = score = F.lit(0.0)
    active = F.lit(0)
    clean = F.lit(True)
    df = facts
    for name, (known, ok, value) in behavior_sub_checks().items():
        w = BEHAVIOR_WEIGHTS[name]
        weight = weight + F.when(known, w).otherwise(0.0)
        score = score + F.when(known, value * w).otherwise(0.0)
        active = active + F.when(known, 1).otherwise(0)
        clean = clean & F.when(known, ok).otherwise(True)
    return df.withColumns(
        {
            "behavior_active": active,
            "behavior_score": F.coalesce(F.try_divide(score, weight), F.lit(0.0)),
            "behavior_passed": (active >= MIN_ACTIVE_SUB_CHECKS) & clean,
        }
    )


def sub_check_rows(facts: DataFrame, key: list[str]) -> DataFrame:
    """One row per run and sub-check; without data a sub-check passes with 1.0 and does not count."""
    entries = [
        F.struct(
            F.lit(name).alias("sub_check"),
            known.alias("has_data"),
            F.when(known, ok).otherwise(True).alias("passed"),
            F.when(known, value).otherwise(1.0).alias("score"),
        )
        for name, (known, ok, value) in behavior_sub_checks().items()
    ]
    return facts.select(*key, F.inline(F.array(*entries)))


def certify(runs: DataFrame, gates: DataFrame, key: list[str]) -> DataFrame:
    """One row per run: ``checks`` (map), one struct per level and the highest level reached.

    ``runs`` come from :func:`resolve_policy` and carry validation_passed, metadata_valid,
    has_eval_assets, operational_passed/score (null: not evaluated) and the behavioural inputs.
    """
    thresholds = [f"threshold_{c}" for c in THRESHOLDS]
    with_limits = gates.select(
        *key, "gate_order", "gate_type", "passed", "score", "findings_count"
    ).join(runs.select(*key, *thresholds), key)
    df = behavior_composite(runs).join(merge_gate_checks(with_limits, key), key, "left")
    results: dict[str, Column] = {
        "valid_skill_structure": _flag(F.col("validation_passed")),
        "metadata_compliance": _flag(F.col("metadata_valid")),
        "evaluation_assets": _flag(F.col("has_eval_assets")),
        "enterprise_structure_validation": _flag(F.col("validation_passed")),
        "operational_policy_compliance": _result(
            F.coalesce("operational_passed", F.lit(False)), F.coalesce("operational_score", F.lit(0.0))
        ),
        "enterprise_behavioral_testing": _result(F.col("behavior_passed"), F.col("behavior_score")),
        "registry_governance": _flag(F.lit(False)),
        "continuous_optimization": _flag(F.lit(False)),
    }
    names = {"engine": "evaluation", "security": "security", "quality": "quality"}
    for check, (kind, _, _) in gate_checks().items():
        rank = F.col(f"_rank_{check}")
        results[check] = F.when(
            rank.isNotNull(), _result(rank >= _PASS_BIT, F.col(f"_score_{check}"), F.lit(names[kind]))
        )
    entries = []
    for check, result in results.items():
        entries += [F.lit(check), result]
    df = df.withColumn("checks", F.map_filter(F.create_map(*entries), lambda _, r: r.isNotNull()))
    df = df.drop(*[c for c in df.columns if c.startswith(("_rank_", "_score_"))])
    missing = _result(F.lit(False), F.lit(0.0))
    for level in LEVELS:
        df = df.withColumn(
            f"{level}_checks",
            F.transform(
                f"required_{level}",
                lambda c: F.struct(
                    c.alias("check_id"), F.coalesce(F.try_element_at("checks", c), missing).alias("result")
                ),
            ),
        )
    lower = F.lit(True)
    for level in LEVELS:
        evaluated = F.col(f"{level}_checks")
        n = F.size(evaluated)
        good = F.size(F.filter(evaluated, lambda c: c["result"]["passed"]))
        failed = F.transform(F.filter(evaluated, lambda c: ~c["result"]["passed"]), lambda c: c["check_id"])
        total = F.aggregate(evaluated, F.lit(0.0), lambda acc, c: acc + c["result"]["score"])
        lower = lower & (n > 0) & (good == n)
        df = df.withColumn(
            level,
            F.struct(
                lower.alias("passed"),
                n.alias("checks_total"),
                good.alias("checks_passed"),
                (n - good).alias("checks_failed"),
                ratio(total, n, 0.0).alias("overall_score"),
                F.when(good < n, failed).alias("failed_checks"),
            ),
        )
    highest = (
        F.when(F.col("certified.passed"), "certified")
        .when(F.col("trusted.passed"), "trusted")
        .when(F.col("foundational.passed"), "foundational")
        .otherwise("none")
    )
    return df.withColumn("highest_level", highest)


def certification_rows(certified: DataFrame, key: list[str]) -> DataFrame:
    """Three rows per run, one per level; ``failed_checks`` is null when nothing failed."""
    entries = [F.struct(F.lit(x).alias("level"), F.lit(i).alias("level_rank"), F.col(x).alias("r"))
               for i, x in enumerate(LEVELS)]
    return certified.select(*key, F.inline(F.array(*entries))).select(*key, "level", "level_rank", "r.*")


def check_rows(certified: DataFrame, key: list[str]) -> DataFrame:
    """Long table of evaluated checks per run."""
    return certified.select(*key, F.explode("checks").alias("check_id", "r")).select(*key, "check_id", "r.*")


def behavioral_inputs(runs: DataFrame, gates: DataFrame, key: list[str], variance: DataFrame | None = None) -> DataFrame:
    """Deviation from the report and counts of the first behavioural gate that has any.

    With ``variance`` (per submission, off by default) the stability inputs are filled from history.
    """
    first = (
        gates.where((F.col("gate_type") == "behavioral") & F.col("edge_total").isNotNull())
        .groupBy(*key)
        .agg(
            F.min_by("edge_total", "gate_order").alias("edge_total"),
            F.min_by("edge_passed", "gate_order").alias("edge_passed"),
        )
    )
    df = runs.join(first, key, "left")
    if variance is None:
        return df.withColumns(
            {"score_variance": F.lit(None).cast("double"), "stability_runs": F.lit(None).cast("bigint")}
        )
    history = variance.select("submission_name", "score_variance", F.col("run_count").alias("stability_runs"))
    return df.join(history, "submission_name", "left")
