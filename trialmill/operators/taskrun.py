"""Task runs of tool servers: two file layouts to one table of tasks, and run totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialmill.functions.stats import ratio

# Fixed values
PASS_THRESHOLD = 0.7
STATUS_WORDS = {
    "passed": ("passed", "pass", "success"),
    "failed": ("failed", "fail", "failure"),
    "error": ("error", "exception"),
    "skipped": ("skipped", "skip"),
}


def first_text(v: Column, *names: str) -> Column:
    """First present field; fields are looked up by name at the top of ``v``."""
    return F.coalesce(*[F.try_variant_get(v, f"$.{n}", "string") for n in names])


def first_filled(v: Column, *paths: str) -> Column:
    """First list that is present and not empty, else an empty list."""
    none = F.array().cast("array<variant>")
    lists = [F.try_variant_get(v, p, "array<variant>") for p in paths]
    return F.coalesce(*[F.when(F.size(x) > 0, x) for x in lists], none)


def task_status(task: Column) -> Column:
    """``taskPassed`` decides where present, else the status word; unknown words are errors."""
    passed = F.try_variant_get(task, "$.taskPassed", "boolean")
    word = F.lower(F.try_variant_get(task, "$.status", "string"))
    status = F.when(passed, "passed").when(~passed, "failed")
    for name, words in STATUS_WORDS.items():
        status = status.when(word.isin(*words), name)
    return status.otherwise("error")


def tool_calls(task: Column) -> Column:
    calls = first_filled(task, "$.callHistory.ToolCalls", "$.callHistory", "$.toolCalls")
    return F.transform(
        calls,
        lambda c: F.struct(
            F.coalesce(first_text(c, "serverName", "server", "mcpServer"), F.lit("unknown")).alias("server"),
            F.coalesce(first_text(c, "name", "tool", "toolName"), F.lit("unknown")).alias("tool_name"),
            F.to_json(
                F.coalesce(
                    F.try_variant_get(c, "$.request.Params.arguments", "variant"),
                    F.try_variant_get(c, "$.arguments", "variant"),
                    F.try_variant_get(c, "$.params", "variant"),
                )
            ).alias("arguments"),
            F.coalesce(F.try_variant_get(c, "$.success", "boolean"), F.lit(True)).alias("success"),
        ),
    )


def judge_results(task: Column) -> Column:
    judges = first_filled(task, "$.llmJudgeResults", "$.verifyResults", "$.assertionResults")

    def flag(j: Column) -> Column:
        names = ("passed", "success", "assertionPassed")
        return F.coalesce(*[F.try_variant_get(j, f"$.{n}", "boolean") for n in names], F.lit(False))

    return F.transform(
        judges,
        lambda j: F.struct(
            F.coalesce(first_text(j, "type", "checkType", "assertionType"), F.lit("contains")).alias("check_type"),
            F.coalesce(first_text(j, "expected", "description"), F.lit("")).alias("expected"),
            flag(j).alias("passed"),
            first_text(j, "reason", "message", "details").alias("reason"),
        ),
    )


def extract_tasks(outputs: DataFrame, key: list[str], doc: str = "doc") -> DataFrame:
    """One row per task of every output document, whichever layout it has."""
    tasks = outputs.select(
        *key, F.posexplode(first_filled(F.col(doc), "$.taskResults", "$.results")).alias("task_no", "_task")
    )
    t = F.col("_task")
    judged = F.size(F.filter("judge_results", lambda j: j["passed"]))
    return (
        tasks.withColumn("task_id", F.coalesce(first_text(t, "taskId", "taskPath", "name"), F.lit("unknown")))
        .withColumn("task_name", F.coalesce(first_text(t, "taskName", "name"), F.col("task_id")))
        .withColumn("status", task_status(t))
        .withColumn("tool_call_records", tool_calls(t))
        .withColumn("tool_calls", F.size("tool_call_records"))
        .withColumn("judge_results", judge_results(t))
        .withColumn("llm_judge_passed", judged)
        .withColumn("llm_judge_total", F.size("judge_results"))
        .withColumn("llm_judge_pass_rate", ratio(F.col("llm_judge_passed"), F.col("llm_judge_total")))
        .withColumn(
            "duration_ms",
            F.coalesce(F.try_variant_get(t, "$.durationMs", "bigint"), F.try_variant_get(t, "$.duration", "bigint")),
        )
        .withColumn("error_message", first_text(t, "error", "errorMessage"))
        .withColumn("agent_response", first_text(t, "agentResponse", "response", "taskOutput"))
        .drop("_task")
    )


def task_run_totals(outputs: DataFrame, tasks: DataFrame, key: list[str], doc: str = "doc") -> DataFrame:
    """Counters, score (passed over total, 0.0 without tasks), duration and verdict per run."""

    def n(status: str) -> Column:
        return F.count_if(F.col("status") == status).alias(f"{status}_tasks")

    counted = tasks.groupBy(*key).agg(
        n("passed"), n("failed"), n("error"), n("skipped"),
        F.count(F.lit(1)).alias("total_tasks"),
        F.sum(F.nullif("duration_ms", F.lit(0))).alias("_summed"),
    )
    d = F.col(doc)
    given = F.nullif(first_text(d, "evalName", "name"), F.lit(""))
    names = F.try_variant_get(d, "$.summary.evals.names", "array<variant>")
    heads = outputs.select(
        *key,
        F.try_variant_get(d, "$.totalDurationMs", "bigint").alias("_given"),
        F.coalesce(
            given, F.when(F.size(names) > 0, F.concat("submission_name", F.lit("-eval"))), F.lit("unknown")
        ).alias("eval_name"),
    )
    counters = ["passed_tasks", "failed_tasks", "error_tasks", "skipped_tasks", "total_tasks"]
    df = heads.join(counted, key, "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in counters})
    df = df.withColumn("overall_score", ratio(F.col("passed_tasks"), F.col("total_tasks"), 0.0))
    return df.select(
        *key, "eval_name", "overall_score", *counters,
        F.coalesce("_given", "_summed").alias("total_duration_ms"),
        F.when(F.col("overall_score") >= PASS_THRESHOLD, "pass").otherwise("fail").alias("recommendation"),
    )
