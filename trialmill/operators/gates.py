"""Gate results from engine reports, scan documents, reviews and edge cases.

Every gate is a function from a table of runs to a table of gate rows. The artifacts of a run are
JSON documents kept as VARIANT; a document belongs to one run and is judged inside its own row, so a
gate costs one join on the run key at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialmill.functions.stats import ratio

# Fixed values
SEVERITIES = ("critical", "high", "medium", "low", "info")
SEVERITY_WEIGHTS = {"critical": 0.0, "high": 0.25, "medium": 0.5, "low": 0.75, "info": 0.9}
AB_THRESHOLD = 0.0
SINGLE_THRESHOLD = 0.5
TASK_RUN_THRESHOLD = 0.7
HARNESS_THRESHOLD = 0.5
REVIEW_THRESHOLD = 0.6
EDGE_CASE_THRESHOLD = 0.5
FINDING = "struct<severity:string,message:string,location:string,rule_id:string>"


def clamp(x: Column) -> Column:
    """Score limited to [0, 1]; null stays null."""
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)))


def severity_of(raw: Column) -> Column:
    """Lower-cased and trimmed; missing or unknown severities count as info."""
    s = F.lower(F.trim(raw))
    return F.when(s.isin(*SEVERITIES), s).otherwise("info")


def _text(v: Column, *paths: str) -> Column:
    return F.coalesce(*[F.try_variant_get(v, p, "string") for p in paths])


def artifact_state(text: Column, parsed: Column) -> Column:
    return F.when(text.isNull(), "absent").when(parsed.isNull(), "corrupt").otherwise("ok")


def parse_artifact(df: DataFrame, text: str, doc: str = "doc") -> DataFrame:
    """Parse a JSON artifact to VARIANT and tell absent, corrupt and readable ones apart."""
    parsed = df.withColumn(doc, F.try_parse_json(text))
    return parsed.withColumn("artifact_state", artifact_state(F.col(text), F.col(doc)))


def findings_of(doc: Column) -> Column:
    """Findings of a scan document with their alternative field names resolved."""
    items = F.coalesce(F.try_variant_get(doc, "$.findings", "array<variant>"), F.array().cast("array<variant>"))
    return F.transform(
        items,
        lambda f: F.struct(
            severity_of(_text(f, "$.severity")).alias("severity"),
            F.coalesce(_text(f, "$.message", "$.description"), F.lit("")).alias("message"),
            _text(f, "$.file_path", "$.location.file").alias("location"),
            F.coalesce(_text(f, "$.rule_id", "$.id"), F.lit("unknown")).alias("rule_id"),
        ),
    )


def count_severity(findings: Column, severity: str) -> Column:
    return F.size(F.filter(findings, lambda f: f["severity"] == severity))


def severity_counts(findings: Column) -> Column:
    """All five severities are present as keys."""
    pairs = []
    for s in SEVERITIES:
        pairs += [F.lit(s), count_severity(findings, s)]
    return F.create_map(*pairs)


def severity_score(findings: Column) -> Column:
    """Mean weight of the findings, 1.0 without any."""
    total = sum((count_severity(findings, s) * F.lit(w) for s, w in SEVERITY_WEIGHTS.items()), F.lit(0.0))
    return ratio(total, F.size(findings), 1.0)


def _gate(df: DataFrame, key: list[str], gate_type: str, gate_name: str, policy_key: Column, order: int,
          passed: Column, score: Column, threshold: Column | None, findings: Column | None) -> DataFrame:
    none = F.array().cast(f"array<{FINDING}>")
    kept = [c for c in ("combination", "weight", "push_fact") if c in df.columns]
    rows = df.select(
        *key,
        F.lit(order).alias("gate_order"),
        F.lit(gate_type).alias("gate_type"),
        F.lit(gate_name).alias("gate_name"),
        policy_key.alias("policy_key"),
        passed.alias("passed"),
        score.cast("double").alias("score"),
        F.col("mode"),
        (F.lit(None).cast("double") if threshold is None else threshold).alias("threshold"),
        (none if findings is None else F.coalesce(findings, none)).alias("findings"),
        *kept,
    )
    return rows.withColumn("findings_count", F.size("findings"))


def ab_gate(runs: DataFrame, key: list[str], order: int = 0) -> DataFrame:
    """Gap (uplift where there is no gap) against the policy threshold; score is the treatment mean."""
    threshold = F.coalesce("policy_threshold", F.lit(AB_THRESHOLD))
    gap = F.round(F.coalesce("mean_reward_gap", "uplift", F.lit(0.0)), 12)
    score = clamp(F.coalesce("treatment_mean_reward", F.lit(0.0)))
    return _gate(runs, key, "engine", "evaluation", F.col("eval_engine"), order, gap >= threshold, score, threshold, None)


def single_gate(runs: DataFrame, key: list[str], order: int = 0) -> DataFrame:
    """Treatment mean against the threshold, 0.5 by default."""
    threshold = F.coalesce("policy_threshold", F.lit(SINGLE_THRESHOLD))
    mean = F.coalesce("treatment_mean_reward", F.lit(0.0))
    return _gate(runs, key, "engine", "evaluation", F.col("eval_engine"), order, F.round(mean, 12) >= threshold, clamp(mean), threshold, None)


def task_run_gate(runs: DataFrame, key: list[str], order: int = 0) -> DataFrame:
    """Share of passed tasks against 0.7, for rows of :func:`trialmill.operators.taskrun.task_run_totals`.

    The findings themselves are rows of :func:`task_findings`; here only their number is kept, so a run
    with very many tasks is never gathered.
    """
    threshold = F.coalesce("policy_threshold", F.lit(TASK_RUN_THRESHOLD))
    score = F.col("overall_score")
    counted = runs.withColumn("_found", (F.col("failed_tasks") + F.col("error_tasks")).cast("int"))
    gate = _gate(counted, [*key, "_found"], "engine", "evaluation", F.col("eval_engine"), order, score >= threshold,
                 score, threshold, None)
    return gate.withColumn("findings_count", F.col("_found")).drop("_found")


def task_findings(tasks: DataFrame, key: list[str]) -> DataFrame:
    """Failed (medium) and errored (high) tasks."""
    status = F.col("status")
    named = F.concat(F.lit("Task "), status, F.lit(": "), F.coalesce("task_name", F.lit("unknown")))
    return tasks.where(status.isin("failed", "error")).select(
        *key,
        F.when(status == "error", "high").otherwise("medium").alias("severity"),
        F.coalesce(F.nullif("error_message", F.lit("")), named).alias("message"),
        F.col("task_id").alias("location"),
        F.concat(F.lit("mcpchecker-"), status).alias("rule_id"),
    )


def harness_gate(runs: DataFrame, key: list[str], order: int = 0) -> DataFrame:
    """Mean reward against 0.5; a missing reward fails with score 0."""
    threshold = F.coalesce("policy_threshold", F.lit(HARNESS_THRESHOLD))
    mean = F.col("mean_reward")
    passed = F.coalesce(mean >= threshold, F.lit(False))
    findings = F.col("findings") if "findings" in runs.columns else None
    return _gate(runs, key, "engine", "evaluation", F.col("eval_engine"), order, passed,
                 F.coalesce(mean, F.lit(0.0)), threshold, findings)


def pairwise_gate(runs: DataFrame, key: list[str], order: int = 0) -> DataFrame:
    """Win rate against 0.5 for rows of :func:`trialmill.operators.pairwise.pairwise_outcome`."""
    threshold = F.coalesce("policy_threshold", F.lit(HARNESS_THRESHOLD))
    passed = F.col("all_ties") | (F.col("win_rate") >= threshold)
    findings = F.col("findings") if "findings" in runs.columns else None
    return _gate(runs, key, "engine", "evaluation", F.col("eval_engine"), order, passed, F.col("win_rate"), threshold, findings)


def scan_gate(artifacts: DataFrame, key: list[str], gate_type: str, policy_key: str, order: int) -> DataFrame:
    """Scan document gate for rows with mode, artifact_state and doc.

    Disabled passes with 1.0; an absent document fails only where the gate blocks; a corrupt one always
    fails; otherwise a blocking gate fails on critical or high findings.
    """
    df = artifacts.withColumn("_found", findings_of(F.col("doc")))
    found = F.col("_found")
    mode, state = F.col("mode"), F.col("artifact_state")
    serious = count_severity(found, "critical") + count_severity(found, "high")
    off, block = mode == "disabled", mode == "block"
    passed = (
        F.when(off, True)
        .when(state == "absent", ~block)
        .when(state == "corrupt", False)
        .otherwise(~block | (serious == 0))
    )
    score = (
        F.when(off, 1.0)
        .when(state == "absent", F.when(block, 0.0).otherwise(1.0))
        .when(state == "corrupt", 0.0)
        .otherwise(severity_score(found))
    )
    findings = F.when(~off & (state == "ok"), found)
    return _gate(df, key, gate_type, gate_type, F.lit(policy_key), order, passed, score, None, findings)


def review_dimensions(docs: DataFrame, key: list[str]) -> DataFrame:
    """One row per reviewed dimension with its severity band."""
    rows = docs.select(*key, F.try_variant_get("doc", "$.dimensions", "map<string,variant>").alias("_dims")).select(
        *key, F.explode("_dims").alias("dimension", "_dim")
    )
    score = F.coalesce(F.try_variant_get("_dim", "$.score", "double"), F.lit(0.0))
    return rows.select(
        *key,
        "dimension",
        score.alias("score"),
        F.coalesce(F.try_variant_get("_dim", "$.finding", "string"), F.lit("")).alias("finding"),
        dimension_severity(score).alias("severity"),
    )


def dimension_severity(score: Column) -> Column:
    """Bands at 0.4, 0.6 and 0.8."""
    return F.when(score < 0.4, "high").when(score < 0.6, "medium").when(score < 0.8, "low").otherwise("info")


def dimension_scores(doc: Column) -> Column:
    """Map of dimension name to score."""
    dims = F.try_variant_get(doc, "$.dimensions", "map<string,variant>")
    return F.transform_values(dims, lambda _, d: F.coalesce(F.try_variant_get(d, "$.score", "double"), F.lit(0.0)))


def review_gate(artifacts: DataFrame, key: list[str], order: int = 20) -> DataFrame:
    """Blocking compares the overall score with the threshold; warning heeds only an explicit fail."""
    doc, mode, state = F.col("doc"), F.col("mode"), F.col("artifact_state")
    threshold = F.coalesce("policy_threshold", F.lit(REVIEW_THRESHOLD))
    overall = F.coalesce(F.try_variant_get(doc, "$.overall_score", "double"), F.lit(0.0))
    verdict = F.coalesce(F.try_variant_get(doc, "$.recommendation", "string"), F.lit("fail"))
    dims = F.map_entries(F.try_variant_get(doc, "$.dimensions", "map<string,variant>"))
    read = F.transform(
        dims,
        lambda d: F.struct(
            d["key"].alias("name"),
            F.coalesce(F.try_variant_get(d["value"], "$.score", "double"), F.lit(0.0)).alias("score"),
            F.coalesce(F.try_variant_get(d["value"], "$.finding", "string"), F.lit("")).alias("text"),
        ),
    )
    findings = F.transform(
        F.filter(read, lambda d: (d["score"] < 0.6) & (d["text"] != "")),
        lambda d: F.struct(
            dimension_severity(d["score"]).alias("severity"),
            F.concat(d["name"], F.lit(": "), d["text"]).alias("message"),
            d["name"].alias("location"),
            F.concat(F.lit("quality-"), d["name"]).alias("rule_id"),
        ),
    )
    off, block = mode == "disabled", mode == "block"
    passed = (
        F.when(off, True).when(state == "absent", ~block).when(state == "corrupt", False)
        .when(block, overall >= threshold).otherwise(verdict != "fail")
    )
    score = (
        F.when(off, 1.0).when(state == "absent", F.when(block, 0.0).otherwise(1.0))
        .when(state == "corrupt", 0.0).otherwise(overall)
    )
    return _gate(artifacts, key, "quality", "quality", F.lit("llm-review"), order, passed, score,
                 F.when(~off & (state == "ok"), threshold), F.when(~off & (state == "ok"), findings))


def edge_case_gate(artifacts: DataFrame, key: list[str], order: int = 30) -> DataFrame:
    """Share of passed edge cases; the threshold is the policy's, 0.5 where that is 0 or unset."""
    doc, mode, state = F.col("doc"), F.col("mode"), F.col("artifact_state")
    cases = F.coalesce(
        F.try_variant_get(doc, "$.edge_case_results", "array<variant>"), F.array().cast("array<variant>")
    )
    total = F.size(cases)
    good = F.size(F.filter(cases, lambda c: F.coalesce(F.try_variant_get(c, "$.passed", "boolean"), F.lit(False))))
    threshold = F.coalesce(F.nullif("policy_threshold", F.lit(0.0)), F.lit(EDGE_CASE_THRESHOLD))
    share = ratio(good, total, 1.0)
    off, block = mode == "disabled", mode == "block"
    judged = ~off & (state == "ok") & (total > 0)
    passed = (
        F.when(off, True).when(state == "absent", ~block).when(state == "corrupt", False)
        .when(total == 0, True).otherwise((mode == "warn") | (share >= threshold))
    )
    score = (
        F.when(off, 1.0).when(state == "absent", F.when(block, 0.0).otherwise(1.0))
        .when(state == "corrupt", 0.0).otherwise(share)
    )
    rows = _gate(artifacts.withColumn("_total", F.when(judged, total)).withColumn("_good", F.when(judged, good)),
                 [*key, "_total", "_good"], "behavioral", "behavioral", F.lit("edge-case"), order, passed, score,
                 F.when(judged, threshold), None)
    return rows.withColumnRenamed("_total", "edge_total").withColumnRenamed("_good", "edge_passed")
