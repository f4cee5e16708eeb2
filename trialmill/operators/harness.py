"""Harness runs: per-case judge values of mixed type, held as VARIANT.

Whether ``1`` passes depends on its JSON type (an integer 1 is the lowest grade, a float 1.0 a full
score), so values stay VARIANT until they are judged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialmill.functions.stats import let, ratio
from trialmill.functions.text import decimals, percent

# Fixed values
HARNESS_THRESHOLD = 0.5


def kind_of(v: Column) -> Column:
    """``bool``, ``int``, ``float``, ``object`` or ``other``; the value's schema is worked out once."""

    def name(x: Column) -> Column:
        schema = x["schema"]
        return (
            F.when(schema == "BOOLEAN", "bool")
            .when(schema == "BIGINT", "int")
            .when(schema.startswith("DECIMAL") | schema.isin("DOUBLE", "FLOAT"), "float")
            .when(schema.startswith("OBJECT"), "object")
            .otherwise("other")
        )

    return F.when(v.isNull(), "other").otherwise(let({"schema": F.schema_of_variant(v)}, name))


def numeric_passes(kind: Column, value: Column) -> Column:
    """Integers 1 to 5 and floats in (1, 5] pass from 3; everything else from 0.5."""
    graded = ((kind == "int") & value.between(1.0, 5.0)) | ((kind == "float") & (value > 1.0) & (value <= 5.0))
    return F.when(graded, value >= 3.0).otherwise(value >= 0.5)


def judge_passes(kind: Column, flag: Column, value: Column) -> Column:
    return F.when(kind == "bool", flag).when(kind.isin("int", "float"), numeric_passes(kind, value)).otherwise(False)


def judge_rows(cases: DataFrame, key: list[str], per_case: str = "per_case") -> DataFrame:
    """Cases and their judge entries as rows: case_id, judge, is_object, kind, flag, value, error.

    A case that is not an object, or is empty, keeps one row without a judge. ``judged_by`` names the
    entry that alone decides the findings of its case, null where the judges do.
    """
    members = "map<string,variant>"
    df = cases.select(*key, F.explode(F.try_variant_get(per_case, "$", members)).alias("case_id", "_case"))
    df = df.withColumn("_kind", kind_of(F.col("_case"))).withColumn(
        "_judges", F.when(F.col("_kind") == "object", F.try_variant_get("_case", "$", members))
    )
    df = df.withColumn(
        "judged_by",
        F.when(F.map_contains_key("_judges", "reward"), "reward").when(
            F.map_contains_key("_judges", "mean_reward"), "mean_reward"
        ),
    ).select(*key, "case_id", "judged_by", F.explode_outer("_judges").alias("judge", "_entry"))
    df = df.withColumn("_kind", kind_of(F.col("_entry"))).withColumn("is_object", F.col("_kind") == "object")
    inner = F.try_variant_get("_entry", "$.value", "variant")
    df = df.withColumn("_inner", F.when(F.col("is_object"), inner)).withColumn(
        "_value", F.coalesce("_inner", "_entry")
    )
    df = df.withColumn(
        "kind", F.when(F.col("_inner").isNull(), F.col("_kind")).otherwise(kind_of(F.col("_inner")))
    )
    return df.select(
        *key, "case_id", "judged_by", "judge", "is_object", "kind",
        F.when(F.col("kind") == "bool", F.try_variant_get("_value", "$", "boolean")).alias("flag"),
        F.when(F.col("kind").isin("int", "float"), F.try_variant_get("_value", "$", "double")).alias("value"),
        F.when(F.col("is_object"), F.try_variant_get("_entry", "$.error", "string")).alias("error"),
    )


def case_rewards(judges: DataFrame, key: list[str]) -> DataFrame:
    """Reward and pass flag per case.

    Reward: the case's own ``reward``, else the mean of numeric values, else 1.0 or 0.0 by its flags,
    else null. A case passes when any wrapped judge value passes.
    """
    own = (F.col("judge") == "reward") & F.col("kind").isin("int", "float", "bool")
    other = F.coalesce(F.col("judge") != "reward", F.lit(False))
    own_value = F.coalesce(F.col("value"), F.col("flag").cast("double"))
    return judges.groupBy(*key, "case_id").agg(
        F.coalesce(
            F.max(F.when(own, own_value)),
            F.avg(F.when(other, F.col("value"))),
            F.bool_or(F.when(other, F.col("flag"))).cast("double"),
        ).alias("reward"),
        F.coalesce(
            F.bool_or(F.col("is_object") & judge_passes(F.col("kind"), F.col("flag"), F.col("value"))), F.lit(False)
        ).alias("case_passed"),
    )


def single_run_report(
    runs: DataFrame, cases: DataFrame, key: list[str], threshold: Column | float = HARNESS_THRESHOLD
) -> DataFrame:
    """Pass rate over cases and the mean reward against the threshold; a null mean fails."""
    limit = threshold if isinstance(threshold, Column) else F.lit(threshold)
    counted = cases.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("case_passed")).alias("_ok")
    )
    df = runs.join(counted, key, "left").withColumns(
        {"total_cases": F.coalesce("_n", F.lit(0)), "passed_cases": F.coalesce("_ok", F.lit(0))}
    )
    rate = ratio(F.col("passed_cases"), F.col("total_cases"), 0.0)
    return df.select(
        *key,
        "total_cases",
        "passed_cases",
        (F.col("total_cases") - F.col("passed_cases")).alias("failed_cases"),
        rate.alias("pass_rate"),
        "mean_reward",
        rate.alias("uplift"),
        F.coalesce("mean_reward", F.lit(0.0)).alias("mean_reward_gap"),
        F.when(F.coalesce(F.col("mean_reward") >= limit, F.lit(False)), "pass").otherwise("fail").alias("recommendation"),
    )


def merge_run_files(summaries: DataFrame, results: DataFrame, key: list[str]) -> DataFrame:
    """Mean reward, mode and execution data; the result file's mean wins whenever its key exists."""
    s = summaries.select(*key, F.col("doc").alias("_s"))
    r = results.select(*key, F.col("doc").alias("_r"))
    joined = s.join(r, key, "left")
    has = F.coalesce(
        F.array_contains(F.map_keys(F.try_variant_get("_r", "$", "map<string,variant>")), "mean_reward"), F.lit(False)
    )
    summary_has = F.array_contains(F.map_keys(F.try_variant_get("_s", "$", "map<string,variant>")), "mean_reward")
    from_summary = F.when(summary_has, F.try_variant_get("_s", "$.mean_reward", "double")).otherwise(0.0)
    return joined.select(
        *key,
        F.when(has, F.try_variant_get("_r", "$.mean_reward", "double")).otherwise(from_summary).alias("mean_reward"),
        F.when(F.try_variant_get("_s", "$.pairwise", "variant").isNotNull(), "pairwise").otherwise("single").alias("mode"),
        F.try_variant_get("_s", "$.per_case", "variant").alias("per_case"),
        F.try_variant_get("_s", "$.pairwise", "variant").alias("pairwise"),
        F.try_variant_get("_s", "$.judges", "variant").alias("judges"),
        F.try_variant_get("_r", "$.duration_s", "double").alias("duration_s"),
        F.try_variant_get("_r", "$.cost_usd", "decimal(12,6)").alias("cost_usd"),
        F.to_json(F.try_variant_get("_r", "$.token_usage", "variant")).alias("tokens"),
    )


def single_run_findings(judges: DataFrame, key: list[str]) -> DataFrame:
    """Low rewards, judge errors, false verdicts and low grades of single runs.

    A case with its own ``reward`` or ``mean_reward`` is judged by that number alone.
    """
    own = judges.where((F.col("judge") == F.col("judged_by")) & ~F.col("is_object") & (F.col("value") < 0.5))
    low = own.select(
        *key,
        F.when(F.col("value") < 0.25, "high").otherwise("medium").alias("severity"),
        F.concat(F.lit("Case "), "case_id", F.lit(" scored low: reward="), decimals(F.col("value"), 2)).alias("message"),
        F.col("case_id").alias("location"),
        F.lit("aeh-low-reward").alias("rule_id"),
    )
    nested = judges.where(F.col("is_object") & F.col("judged_by").isNull())
    failed = F.col("error").isNotNull() & (F.col("error") != "")
    numeric = F.col("kind").isin("int", "float")
    low_grade = numeric & ~numeric_passes(F.col("kind"), F.col("value"))
    worst = F.when(F.col("kind") == "int", F.col("value") < 2).otherwise(F.col("value") < 0.25)
    head = F.concat(F.lit("Case "), "case_id", F.lit(" judge '"), "judge", F.lit("' "))
    shown = F.when(F.col("kind") == "int", F.col("value").cast("bigint").cast("string")).otherwise(
        F.col("value").cast("string")
    )
    no = F.coalesce(~F.col("flag"), F.lit(False))
    rest = nested.where(failed | no | F.coalesce(low_grade, F.lit(False))).select(
        *key,
        F.when(failed, "high").when(no, "medium").when(worst, "high").otherwise("medium").alias("severity"),
        F.when(failed, F.concat(head, F.lit("error: "), "error"))
        .when(no, F.concat(head, F.lit("failed")))
        .otherwise(F.concat(head, F.lit("scored low: "), shown))
        .alias("message"),
        F.concat_ws("/", "case_id", "judge").alias("location"),
        F.when(failed, "aeh-judge-error").when(no, "aeh-judge-failed").otherwise("aeh-low-score").alias("rule_id"),
    )
    return low.unionByName(rest)


def judge_summary(judges: Column) -> Column:
    """``name=80%`` from a pass rate, ``name=0.80`` from a mean or a bare number, joined by commas."""
    entries = F.map_entries(F.try_variant_get(judges, "$", "map<string,variant>"))

    def shown(e: Column) -> Column:
        rate = F.try_variant_get(e["value"], "$.pass_rate", "double")
        mean = F.try_variant_get(e["value"], "$.mean", "double")
        bare = F.when(kind_of(e["value"]) != "object", F.try_variant_get(e["value"], "$", "double"))
        text = F.coalesce(percent(rate, 0), decimals(F.coalesce(mean, bare), 2))
        return F.when(
            rate.isNotNull() | mean.isNotNull() | bare.isNotNull(), F.concat(e["key"], F.lit("="), text)
        )

    return F.array_join(F.array_compact(F.transform(entries, shown)), ", ")
