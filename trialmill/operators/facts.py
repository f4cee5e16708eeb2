"""Payload rows for alerts, gate facts and certification facts. Nothing is sent anywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialmill.functions.text import decimals, percent
from trialmill.operators.certify import LEVELS

# Fixed values
MODEL_LABELS = (
    ("claude-sonnet", "Claude Sonnet 4.6 (vertex_ai)"),
    ("claude-haiku", "Claude Haiku 3.5 (vertex_ai)"),
)


def model_label(model: Column) -> Column:
    label = F.when(model == "", None)
    for prefix, text in MODEL_LABELS:
        label = label.when(model.startswith(prefix), text)
    return label.otherwise(model)


def change_url(base: str, repository: Column, number: Column) -> Column:
    """Link to a change request when both parts are given."""
    return F.when((repository != "") & (number != ""), F.concat(F.lit(base), repository, F.lit("/pull/"), number))


def _mark(text: Column) -> Column:
    return F.struct(F.lit("mrkdwn").alias("type"), text.alias("text"))


def alert_payload(results: DataFrame, run_url: str | None = None) -> DataFrame:
    """Chat message per degradation row; baseline fields only where there is a previous score."""
    engine = F.upper(F.coalesce("eval_engine", F.lit("unknown")))
    header = F.concat(
        F.when(F.col("degraded"), "🚨 [").otherwise("✅ ["), engine,
        F.when(F.col("degraded"), "] Performance Degradation Detected").otherwise("] Monitoring Pass"),
    )
    run = F.coalesce("current_run_id", F.lit("N/A"))
    linked = run if run_url is None else F.when(run == "N/A", run).otherwise(F.concat(F.lit(f"<{run_url}|"), run, F.lit(">")))

    def shown(score: Column) -> Column:
        return F.coalesce(percent(score, 1), F.lit("N/A"))

    basic = [
        _mark(F.concat(F.lit("*Skill:*\n"), "submission_name")),
        _mark(F.concat(F.lit("*Run ID:*\n"), linked)),
        _mark(F.concat(F.lit("*Score:*\n"), shown(F.col("current_score")))),
    ]
    baseline = [
        _mark(F.concat(F.lit("*Baseline:*\n"), shown(F.col("previous_score")))),
        _mark(F.concat(F.lit("*Ratio:*\n"), F.coalesce(decimals(F.col("ratio"), 2), F.lit("N/A")))),
        _mark(F.concat(F.lit("*Threshold:*\n"), F.col("threshold").cast("string"))),
    ]
    fields = F.when(F.col("previous_score").isNotNull(), F.array(*basic, *baseline)).otherwise(F.array(*basic))
    text = F.struct(F.lit("plain_text").alias("type"), header.alias("text"), F.lit(True).alias("emoji"))
    blocks = [
        F.to_json(F.struct(F.lit("header").alias("type"), text.alias("text"))),
        F.to_json(F.struct(F.lit("section").alias("type"), fields.alias("fields"))),
        F.to_json(F.struct(F.lit("context").alias("type"), F.array(_mark(F.col("message"))).alias("elements"))),
    ]
    if run_url is not None:
        button = F.struct(
            F.lit("button").alias("type"),
            F.struct(F.lit("plain_text").alias("type"), F.lit("View Pipeline Run").alias("text")).alias("text"),
            F.lit(run_url).alias("url"),
        )
        blocks.append(F.to_json(F.struct(F.lit("actions").alias("type"), F.array(button).alias("elements"))))
    payload = F.concat(F.lit('{"blocks":['), F.concat_ws(",", *blocks), F.lit("]}"))
    return results.select("submission_name", "current_run_id", header.alias("header"), payload.alias("payload"))


def fact_ref(prefix: str, gate_name: Column, policy_key: Column) -> Column:
    """Prefix and gate name, with the implementation where it differs from the gate name."""
    plain = F.concat(F.lit(prefix), gate_name)
    return F.when((policy_key != "") & (policy_key != gate_name), F.concat(plain, F.lit("_"), policy_key)).otherwise(plain)


def _facts(ref: Column, entity: str, data: Column) -> Column:
    fact = F.struct(ref.alias("factRef"), F.lit(entity).alias("entityRef"), data.alias("data"))
    return F.to_json(F.struct(F.array(fact).alias("facts")))


def gate_facts(gates: DataFrame, key: list[str], prefix: str, entity: str) -> DataFrame:
    """One payload per gate whose policy pushes its result."""
    ref = fact_ref(prefix, F.col("gate_name"), F.col("policy_key"))
    data = F.struct(
        "gate_name", "passed", "score", "mode",
        (F.coalesce("message", F.lit("")) if "message" in gates.columns else F.lit("")).alias("message"),
    )
    return gates.where("push_fact").select(*key, ref.alias("fact_ref"), _facts(ref, entity, data).alias("payload"))


def certification_facts(certified: DataFrame, key: list[str], prefix: str, entity: str) -> DataFrame:
    """Four payloads per run: each level and a summary.

    A level whose checks all pass but that is held back by a lower one says so.
    """
    entries = []

    def entry(level: str, ref: Column, reason: Column, data: Column) -> Column:
        return F.struct(
            F.lit(level).alias("level"), ref.alias("fact_ref"), reason.alias("failure_reason"),
            _facts(ref, entity, data).alias("payload"),
        )

    summary = [F.col("highest_level")]
    for level in LEVELS:
        r = F.col(level)
        held = ~r["passed"] & (r["checks_total"] > 0) & (r["checks_passed"] == r["checks_total"])
        reason = F.when(held, "prerequisite_level_failed")
        data = F.struct(
            F.lit(level).alias("level"), r["passed"].alias("passed"), r["checks_passed"].alias("checks_passed"),
            r["checks_total"].alias("checks_total"), r["overall_score"].alias("overall_score"),
            F.col(f"{level}_checks").alias("checks"), reason.alias("failure_reason"),
        )
        entries.append(entry(level, F.lit(f"{prefix}{level}"), reason, data))
        summary += [r["passed"].alias(f"{level}_passed"), r["overall_score"].alias(f"{level}_score")]
    none = F.lit(None).cast("string")
    entries.append(entry("summary", F.lit(f"{prefix}certification"), none, F.struct(*summary)))
    return certified.select(*key, F.inline(F.array(*entries)))


def push_outcomes(results: DataFrame, key: list[str]) -> DataFrame:
    return results.groupBy(*key).agg(
        F.count_if("success").alias("pushed"), F.count_if(~F.col("success")).alias("failed")
    )


def summary_rows(reports: DataFrame, scorecards: DataFrame, key: list[str]) -> DataFrame:
    """Summary per run; the scorecard's verdict goes before the report's."""
    card = scorecards.select(
        *key, F.nullif("recommendation", F.lit("")).alias("_card"), "recommendation_reason", "gates_passed", "gates_failed"
    )
    verdict = F.upper(F.coalesce("_card", "recommendation", F.lit("unknown")))
    return reports.join(card, key, "left").withColumn("recommendation", verdict).drop("_card")
