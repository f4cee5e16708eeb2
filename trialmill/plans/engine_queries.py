"""Queries on harness runs, task runs, stored trajectories and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from trialmill.functions import scalars
from trialmill.operators import gates, harness, metrics, taskrun, trajectory
from trialmill.plans import relations as rel
from trialmill.plans.registry import Registry, rounded

registry = Registry()
RUN = ["run_id"]


def judge_documents(spark, sf):
    """One harness summary per order whose single case has judge values of every kind."""
    k = F.col("o_orderkey")
    grade = (k % 6).cast("string")
    share = F.format_string("%.2f", (k % 60) / 10.0)
    case = (
        F.when(k % 7 == 0, "{}")
        .when(k % 7 == 1, F.concat(F.lit('{"reward":'), F.format_string("%.2f", (k % 100) / 100.0), F.lit("}")))
        .when(k % 7 == 2, F.concat(F.lit('{"j1":{"value":'), grade, F.lit('},"j2":{"value":false}}')))
        .when(k % 7 == 3, F.concat(F.lit('{"j1":{"value":'), share, F.lit("}}")))
        .when(k % 7 == 4, F.concat(F.lit('{"j1":{"value":true},"j2":{"value":'), F.when(k % 2 == 0, "true").otherwise("false"), F.lit("}}")))
        .when(k % 7 == 5, F.concat(F.lit('{"j1":{"value":false,"error":"'), F.when(k % 2 == 0, "").otherwise("boom"), F.lit('"}}')))
        .otherwise(F.concat(F.lit('{"j1":'), grade, F.lit(',"j2":'), share, F.lit("}")))
    )
    return rel.table(spark, sf, "orders").select(
        k.alias("run_id"),
        F.parse_json(F.concat(F.lit('{"c1":'), case, F.lit("}"))).alias("per_case"),
        F.when(k % 11 != 0, (k % 100) / 100.0).alias("mean_reward"),
    )


# the same cases as plain columns: integer grade, float share, flags
JUDGED = """js AS (SELECT o_orderkey AS k, o_orderkey % 7 AS form, o_orderkey % 6 AS grade, (o_orderkey % 60) / 10.0 AS share,
    (o_orderkey % 100) / 100.0 AS own, o_orderkey % 2 = 0 AS even,
    CASE WHEN o_orderkey % 6 BETWEEN 1 AND 5 THEN o_orderkey % 6 >= 3 ELSE o_orderkey % 6 >= 0.5 END AS grade_ok,
    CASE WHEN (o_orderkey % 60) / 10.0 > 1 AND (o_orderkey % 60) / 10.0 <= 5 THEN (o_orderkey % 60) / 10.0 >= 3
         ELSE (o_orderkey % 60) / 10.0 >= 0.5 END AS share_ok,
    CASE WHEN o_orderkey % 11 <> 0 THEN (o_orderkey % 100) / 100.0 END AS mean_reward FROM orders)"""


@registry.add(
    "case_rewards",
    f"""WITH {JUDGED} SELECT k AS run_id, 'c1' AS case_id,
        CASE form WHEN 0 THEN NULL WHEN 1 THEN own WHEN 2 THEN grade WHEN 3 THEN share WHEN 4 THEN 1.0 WHEN 5 THEN 0.0
          ELSE ((grade + share) / 2) END::DOUBLE AS reward,
        CASE form WHEN 2 THEN grade_ok WHEN 3 THEN share_ok WHEN 4 THEN true ELSE false END AS case_passed FROM js""",
)
def case_rewards(spark, sf):
    return rounded(harness.case_rewards(harness.judge_rows(judge_documents(spark, sf), RUN), RUN))


@registry.add(
    "harness_report",
    f"""WITH {JUDGED}, c AS (SELECT k, mean_reward, CASE form WHEN 2 THEN grade_ok WHEN 3 THEN share_ok WHEN 4 THEN true ELSE false END AS ok FROM js)
        SELECT k AS run_id, 1 AS total_cases, ok::INT AS passed_cases, 1 - ok::INT AS failed_cases, ok::INT::DOUBLE AS pass_rate,
          mean_reward::DOUBLE AS mean_reward, ok::INT::DOUBLE AS uplift, coalesce(mean_reward, 0.0)::DOUBLE AS mean_reward_gap,
          CASE WHEN mean_reward >= 0.5 THEN 'pass' ELSE 'fail' END AS recommendation FROM c""",
)
def harness_report(spark, sf):
    docs = judge_documents(spark, sf)
    cases = harness.case_rewards(harness.judge_rows(docs, RUN), RUN)
    return rounded(harness.single_run_report(docs.drop("per_case"), cases, RUN))


@registry.add(
    "harness_findings",
    f"""WITH {JUDGED} SELECT run_id, location, severity, rule_id FROM (
        SELECT k AS run_id, 'c1' AS location, CASE WHEN own < 0.25 THEN 'high' ELSE 'medium' END AS severity, 'aeh-low-reward' AS rule_id
          FROM js WHERE form = 1 AND own < 0.5
        UNION ALL SELECT k, 'c1/j1', CASE WHEN grade < 2 THEN 'high' ELSE 'medium' END, 'aeh-low-score' FROM js WHERE form = 2 AND NOT grade_ok
        UNION ALL SELECT k, 'c1/j2', 'medium', 'aeh-judge-failed' FROM js WHERE form = 2 OR (form = 4 AND NOT even)
        UNION ALL SELECT k, 'c1/j1', CASE WHEN share < 0.25 THEN 'high' ELSE 'medium' END, 'aeh-low-score' FROM js WHERE form = 3 AND NOT share_ok
        UNION ALL SELECT k, 'c1/j1', CASE WHEN even THEN 'medium' ELSE 'high' END, CASE WHEN even THEN 'aeh-judge-failed' ELSE 'aeh-judge-error' END
          FROM js WHERE form = 5)""",
)
def harness_findings(spark, sf):
    return harness.single_run_findings(harness.judge_rows(judge_documents(spark, sf), RUN), RUN).drop("message")


@registry.add(
    "harness_gate",
    f"""WITH {JUDGED} SELECT k AS run_id, coalesce(mean_reward >= 0.5, false) AS passed, coalesce(mean_reward, 0.0)::DOUBLE AS score FROM js""",
)
def harness_gate(spark, sf):
    runs = judge_documents(spark, sf).withColumns(
        {"mode": F.lit("warn"), "policy_threshold": F.lit(None).cast("double"), "eval_engine": F.lit("aeh")}
    )
    return rounded(gates.harness_gate(runs, RUN).select("run_id", "passed", "score"))


@registry.add(
    "label_case_pass",
    """SELECT doc_id AS run_id, count(*) AS n, bool_or(quality = 1 OR toxic = 0) AS case_passed FROM labels GROUP BY ALL""",
)
def label_case_pass(spark, sf):
    docs = rel.table(spark, sf, "labels").select(
        F.col("doc_id").alias("run_id"),
        F.parse_json(
            F.concat(
                F.lit('{"c":{"quality":{"value":'), (F.col("quality") == 1).cast("string"),
                F.lit('},"clean":{"value":'), (F.col("toxic") == 0).cast("string"), F.lit("}}}"),
            )
        ).alias("per_case"),
    )
    cases = harness.case_rewards(harness.judge_rows(docs, RUN), RUN)
    return cases.groupBy("run_id").agg(F.count(F.lit(1)).alias("n"), F.bool_or("case_passed").alias("case_passed"))


def merged_inputs(spark, sf):
    k = F.col("o_orderkey")
    orders = rel.table(spark, sf, "orders")
    summary = F.concat(F.lit('{"run_id":"r"'), F.when(k % 3 == 0, ',"mean_reward":0.25').otherwise(""),
                       F.when(k % 4 == 0, ',"pairwise":{"wins_a":1}').otherwise(""), F.lit("}"))
    result = F.concat(F.lit('{"duration_s":1.5'), F.when(k % 5 == 0, ',"mean_reward":null').when(k % 5 == 1, ',"mean_reward":0.75').otherwise(""), F.lit("}"))
    summaries = orders.select(k.alias("run_id"), F.parse_json(summary).alias("doc"))
    results = orders.where(k % 2 == 0).select(k.alias("run_id"), F.parse_json(result).alias("doc"))
    return summaries, results


@registry.add(
    "harness_run_files",
    """SELECT o_orderkey AS run_id, CASE WHEN o_orderkey % 4 = 0 THEN 'pairwise' ELSE 'single' END AS mode,
         CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 2 = 0 AND o_orderkey % 5 = 1 THEN 0.75
              WHEN o_orderkey % 3 = 0 THEN 0.25 ELSE 0.0 END::DOUBLE AS mean_reward,
         CASE WHEN o_orderkey % 2 = 0 THEN 1.5 END::DOUBLE AS duration_s FROM orders""",
)
def harness_run_files(spark, sf):
    return harness.merge_run_files(*merged_inputs(spark, sf), RUN).select("run_id", "mode", "mean_reward", "duration_s")


def task_documents(spark, sf):
    """One tool-server output per part: task lists in both layouts, built from the part's number."""
    k = F.col("p_partkey")
    words = F.array(*[F.lit(w) for w in ("PASS", "failure", "exception", "Skip", "odd")])

    def legacy(n):
        return F.concat(
            F.lit('{"taskId":"t'), n.cast("string"), F.lit('","status":"'), F.element_at(words, ((k + n) % 5 + 1).cast("int")),
            F.lit('","durationMs":'), ((k + n) % 4 * 100).cast("string"), F.lit(',"toolCalls":[{"server":"s","tool":"x"}],"llmJudgeResults":['),
            F.when((k + n) % 2 == 0, '{"type":"a","passed":true},{"type":"b","passed":false}').otherwise(""), F.lit("]}"),
        )

    def current(n):
        return F.concat(
            F.lit('{"taskPath":"t'), n.cast("string"), F.lit('","taskName":"n","taskPassed":'), ((k + n) % 3 == 0).cast("string"),
            F.lit(',"callHistory":{"ToolCalls":[{"name":"x","request":{"Params":{"arguments":{"a":1}}}},{"name":"y"}]},"assertionResults":[{"assertionPassed":true}]}'),
        )

    ids = F.sequence(F.lit(1), (k % 4 + 1).cast("int"))
    old = F.concat(F.lit('{"evalName":"e","taskResults":['), F.array_join(F.transform(ids, legacy), ","), F.lit("]}"))
    new = F.concat(
        F.lit('{"totalDurationMs":77,"summary":{"evals":{"names":["q"]}},"results":['), F.array_join(F.transform(ids, current), ","), F.lit("]}")
    )
    return rel.table(spark, sf, "part").select(
        k.alias("run_id"), F.concat(F.lit("sub-"), k).alias("submission_name"),
        F.try_parse_json(F.when(k % 10 == 9, '{"evalName":"none"}').when(k % 2 == 0, old).otherwise(new)).alias("doc"),
    )


TASKS = """parts AS (SELECT DISTINCT p_partkey AS k FROM part),
  tasks AS (SELECT k, n, CASE WHEN k % 2 = 0 THEN CASE (k + n) % 5 WHEN 0 THEN 'passed' WHEN 1 THEN 'failed' WHEN 3 THEN 'skipped' ELSE 'error' END
      ELSE CASE WHEN (k + n) % 3 = 0 THEN 'passed' ELSE 'failed' END END AS status,
    CASE WHEN k % 2 = 0 THEN (k + n) % 4 * 100 END AS duration, CASE WHEN k % 2 = 0 THEN 1 ELSE 2 END AS calls,
    CASE WHEN k % 2 = 0 THEN CASE WHEN (k + n) % 2 = 0 THEN 2 ELSE 0 END ELSE 1 END AS jt,
    CASE WHEN k % 2 = 0 THEN CASE WHEN (k + n) % 2 = 0 THEN 1 ELSE 0 END ELSE 1 END AS jp
    FROM (SELECT k, unnest(range(1, k % 4 + 2)) AS n FROM parts WHERE k % 10 <> 9))"""


@registry.add(
    "task_results",
    f"""WITH {TASKS} SELECT k AS run_id, 't' || n AS task_id, CASE WHEN k % 2 = 0 THEN 't' || n ELSE 'n' END AS task_name, status,
        calls::INT AS tool_calls, duration::BIGINT AS duration_ms, jp::INT AS llm_judge_passed, jt::INT AS llm_judge_total,
        CASE WHEN jt > 0 THEN jp / jt END AS llm_judge_pass_rate, CASE WHEN k % 2 = 1 THEN '{{"a":1}}' END AS arguments FROM tasks""",
)
def task_results(spark, sf):
    tasks = taskrun.extract_tasks(task_documents(spark, sf), RUN)
    return tasks.select(
        "run_id", "task_id", "task_name", "status", "tool_calls", "duration_ms", "llm_judge_passed", "llm_judge_total",
        "llm_judge_pass_rate", F.element_at("tool_call_records", 1)["arguments"].alias("arguments"),
    )


@registry.add(
    "task_run_totals",
    f"""WITH {TASKS}, t AS (SELECT k, count(*) FILTER (WHERE status = 'passed') AS p, count(*) FILTER (WHERE status = 'failed') AS f,
          count(*) FILTER (WHERE status = 'error') AS e, count(*) FILTER (WHERE status = 'skipped') AS s, count(*) AS n,
          sum(nullif(duration, 0)) AS d FROM tasks GROUP BY ALL)
        SELECT parts.k AS run_id, 'sub-' || parts.k AS submission_name,
          CASE WHEN parts.k % 10 = 9 THEN 'none' WHEN parts.k % 2 = 0 THEN 'e' ELSE 'sub-' || parts.k || '-eval' END AS eval_name,
          (coalesce(p / n, 0.0)) AS overall_score, coalesce(p, 0) AS passed_tasks, coalesce(f, 0) AS failed_tasks,
          coalesce(e, 0) AS error_tasks, coalesce(s, 0) AS skipped_tasks, coalesce(n, 0) AS total_tasks,
          CASE WHEN parts.k % 10 = 9 THEN NULL WHEN parts.k % 2 = 1 THEN 77 ELSE d END::BIGINT AS total_duration_ms,
          CASE WHEN p / n >= 0.7 THEN 'pass' ELSE 'fail' END AS recommendation FROM parts LEFT JOIN t USING (k)""",
)
def task_run_totals(spark, sf):
    docs = task_documents(spark, sf)
    key = ["run_id", "submission_name"]
    return rounded(taskrun.task_run_totals(docs, taskrun.extract_tasks(docs, key), key))


@registry.add(
    "task_run_gate",
    f"""WITH {TASKS}, t AS (SELECT k, count(*) FILTER (WHERE status = 'passed') / count(*) AS score,
          count(*) FILTER (WHERE status IN ('failed', 'error')) AS n FROM tasks GROUP BY ALL)
        SELECT k AS run_id, score >= 0.7 AS passed, (score) AS score, n::INT AS findings_count FROM t""",
)
def task_run_gate(spark, sf):
    docs = task_documents(spark, sf)
    key = ["run_id", "submission_name"]
    tasks = taskrun.extract_tasks(docs, key)
    runs = taskrun.task_run_totals(docs, tasks, key).where("total_tasks > 0").withColumns(
        {"eval_engine": F.lit("mcpchecker"), "mode": F.lit("warn"), "policy_threshold": F.lit(None).cast("double")}
    )
    return rounded(gates.task_run_gate(runs, RUN).select("run_id", "passed", "score", "findings_count"))


@registry.add(
    "task_run_findings",
    f"""WITH {TASKS} SELECT k AS run_id, 't' || n AS location, CASE status WHEN 'error' THEN 'high' ELSE 'medium' END AS severity,
          'mcpchecker-' || status AS rule_id, 'Task ' || status || ': ' || CASE WHEN k % 2 = 0 THEN 't' || n ELSE 'n' END AS message
        FROM tasks WHERE status IN ('failed', 'error')""",
)
def task_run_findings(spark, sf):
    return gates.task_findings(taskrun.extract_tasks(task_documents(spark, sf), RUN), RUN)


def stored_responses(spark, sf):
    """One stored response per conversation, its turns as history messages with a thought and a tool call."""
    turns = rel.table(spark, sf, "conversations")
    role = F.when(F.col("role") == "assistant", "agent").otherwise(F.col("role"))
    part = F.to_json(F.struct(F.lit("text").alias("kind"), "text"))
    thought = F.lit('{"kind":"text","text":"thinking","metadata":{"adk_thought":true}}')
    call = F.concat(
        F.lit('{"kind":"data","metadata":{"adk_type":"function_call"},"data":{"id":"c'), "turn",
        F.lit('","name":"look","args":{"n":'), "turn", F.lit("}}}"),
    )
    parts = F.when(role == "agent", F.concat_ws(",", part, thought, call)).otherwise(part)
    message = F.concat(F.lit('{"role":"'), role, F.lit('","parts":['), parts, F.lit("]}"))
    history = F.transform(F.array_sort(F.collect_list(F.struct("turn", message.alias("m")))), lambda t: t["m"])
    docs = turns.groupBy("conv_id").agg(history.alias("history"), F.count("text").alias("n"), F.sum(F.length("text")).alias("chars"))
    counts = F.struct(
        F.col("chars").alias("promptTokenCount"), F.col("n").alias("candidatesTokenCount"),
        F.when(F.col("conv_id") % 2 == 0, F.col("n") * 3).alias("cachedContentTokenCount"),
    )
    usage = F.concat(F.lit(',"metadata":'), F.to_json(F.struct(counts.alias("adk_usage_metadata"))))
    return docs.select(
        F.col("conv_id").alias("run_id"), F.lit("do it").alias("instruction"),
        F.parse_json(F.concat(F.lit('{"history":['), F.array_join("history", ","), F.lit("]"), usage, F.lit("}"))).alias("doc"),
    )


@registry.add(
    "trajectory_steps",
    """WITH t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS step_id FROM conversations WHERE role IN ('user', 'assistant'))
       SELECT conv_id AS run_id, step_id::INT AS step_id, CASE role WHEN 'assistant' THEN 'agent' ELSE role END AS source,
         regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS message, CASE role WHEN 'assistant' THEN 'thinking' END AS reasoning_content,
         CASE role WHEN 'assistant' THEN 'c' || turn || ':look:{"n":' || turn || '}' END AS call FROM t""",
)
def trajectory_steps(spark, sf):
    steps = trajectory.trajectory_steps(stored_responses(spark, sf), RUN)
    call = F.element_at("tool_calls", 1)
    return steps.select(
        "run_id", "step_id", "source", "message", "reasoning_content",
        F.concat_ws(":", call["tool_call_id"], call["function_name"], call["arguments"]).alias("_c"), "tool_calls",
    ).select("run_id", "step_id", "source", "message", "reasoning_content", F.when(F.col("tool_calls").isNotNull(), F.col("_c")).alias("call"))


@registry.add(
    "trajectory_totals",
    """SELECT conv_id AS run_id, count(*) FILTER (WHERE role IN ('user', 'assistant')) AS total_steps,
         sum(length(text))::BIGINT AS total_prompt_tokens, count(text) AS total_completion_tokens, CASE WHEN conv_id % 2 = 0 THEN count(text) * 3 END AS total_cached_tokens
       FROM conversations GROUP BY conv_id""",
)
def trajectory_totals(spark, sf):
    docs = stored_responses(spark, sf)
    return trajectory.trajectory_totals(docs, trajectory.trajectory_steps(docs, RUN), RUN)


def model_calls(spark, sf):
    return rel.table(spark, sf, "events").select(
        F.concat(F.lit("sub-"), "user_id").alias("run_id"),
        F.col("event_type").alias("phase"),
        F.col("event_id").alias("seq"),
        F.floor("value").cast("bigint").alias("prompt_tokens"),
        F.floor(F.col("value") / 2).cast("bigint").alias("completion_tokens"),
        F.when(F.col("event_id") % 5 == 0, "").otherwise(F.concat(F.lit("m"), F.col("event_id") % 3)).alias("model"),
    )


CALLS = """calls AS (SELECT 'sub-' || user_id AS run_id, event_type AS phase, event_id AS seq, floor(value)::BIGINT AS p,
    floor(value / 2)::BIGINT AS c, CASE WHEN event_id % 5 <> 0 THEN 'm' || (event_id % 3) END AS model FROM events)"""


@registry.add(
    "token_usage",
    f"""WITH {CALLS} SELECT run_id, phase, sum(p)::BIGINT AS prompt_tokens, sum(c)::BIGINT AS completion_tokens,
          (sum(p) + sum(c))::BIGINT AS total_tokens, count(*) AS call_count, arg_max(model, seq) AS model_name FROM calls GROUP BY run_id, phase
        UNION ALL SELECT run_id, NULL, sum(p)::BIGINT, sum(c)::BIGINT, (sum(p) + sum(c))::BIGINT, count(*), arg_min(model, seq) FROM calls GROUP BY run_id""",
)
def token_usage(spark, sf):
    return metrics.token_usage(model_calls(spark, sf), RUN)


def timings(spark, sf):
    names = F.array(*[F.lit(p) for p in metrics.PHASES])
    begin = F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000.0
    return rel.table(spark, sf, "events").select(
        F.concat(F.lit("sub-"), "user_id").alias("run_id"),
        F.element_at(names, (F.col("event_id") % 6 + 1).cast("int")).alias("phase"),
        begin.alias("start_time"),
        (begin + F.col("event_id") % 100).alias("end_time"),
    )


@registry.add(
    "observability_rows",
    f"""WITH {CALLS}, u AS (SELECT run_id, arg_min(model, seq) AS model_name, sum(p)::BIGINT AS total_prompt_tokens,
          nullif(sum(c), 0)::BIGINT AS total_completion_tokens, (sum(p) + sum(c))::BIGINT AS total_tokens, count(*) AS llm_calls_count
          FROM calls GROUP BY run_id HAVING sum(p) + sum(c) > 0),
        d AS (SELECT 'sub-' || user_id AS run_id, {', '.join(f"arg_max(event_id % 100 * 1000, ts) FILTER (WHERE event_id % 6 = {i}) AS {p}_duration_ms" for i, p in enumerate(metrics.PHASES))}
          FROM events GROUP BY ALL)
        SELECT u.*, d.* EXCLUDE (run_id) FROM u LEFT JOIN d USING (run_id)""",
)
def observability_rows(spark, sf):
    rows = metrics.observability_rows(
        metrics.token_usage(model_calls(spark, sf), RUN), metrics.phase_durations(timings(spark, sf), RUN), RUN
    )
    # clock values carry microseconds, which a double difference may miss by one millisecond
    near = {f"{p}_duration_ms": (F.round(F.col(f"{p}_duration_ms") / 1000.0) * 1000).cast("bigint") for p in metrics.PHASES}
    return rows.withColumns(near)


@registry.add(
    "edge_case_results",
    """WITH g AS (SELECT l_suppkey AS s, l_partkey % 50 AS c, l_quantity::INT % 5 AS passed, l_quantity::INT % 5 + l_linenumber % 3 AS total,
          l_partkey % 50 = 7 AND l_linenumber = 7 AS corrupt FROM lineitem),
        a AS (SELECT s, c, sum(passed) AS p, sum(total) AS t, bool_or(corrupt) AS bad FROM g GROUP BY ALL)
        SELECT s AS submission, c AS case_id, coalesce(NOT bad AND t > 0 AND p / t >= 0.5, false) AS passed,
          (CASE WHEN bad OR t = 0 THEN 0.0 ELSE p / t END) AS score FROM a""",
)
def edge_case_results(spark, sf):
    quantity = F.col("l_quantity").cast("int") % 5
    files = rel.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("submission"), (F.col("l_partkey") % 50).alias("case_id"),
        quantity.alias("n_passed"), (quantity + F.col("l_linenumber") % 3).alias("n_total"),
        ((F.col("l_partkey") % 50 == 7) & (F.col("l_linenumber") == 7)).alias("corrupt"),
    )
    cases = files.select("submission", "case_id").distinct()
    return rounded(scalars.edge_case_results(cases, files, ["submission", "case_id"]))
