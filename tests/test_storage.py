import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from trialmill.operators import metrics, reviews, summary, taskrun, trajectory
from trialmill.sinks import tables
from trialmill.sources import config, files
from trialmill.streaming.degradation import degradation_stream
from trialmill.streaming.ingest import ingest_stream, report_stream


def write(root, contents):
    for path, text in contents.items():
        target = root / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(text)


def reward(x):
    return json.dumps({"verifier_result": {"rewards": {"reward": x}}})


def test_trial_files_from_disk(spark, tmp_path):
    write(tmp_path, {
        "r1/treatment/job/t1/result.json": reward(1.0), "r1/treatment/job/t2/result.json": "{oops", "r1/treatment/job/result.json": "{}",
        "r1/control/job/t3/result.json": json.dumps({"verifier_result": {"reward": 0.5}}), "r1/a2a-eval/j/t4/result.json": reward(1),
        "r2/a2a-eval/j/t5/result.json": reward(0.0), "r2/a2a-eval/j/t6/result.json": '{"verifier_result":"x"}',
    })
    got = sorted((r.pipeline_run_id, r.variant, r.trial_name, r.reward) for r in files.trial_rows(files.read_files(spark, str(tmp_path), "*.json")).collect())
    assert got == sorted([
        ("r1", "control", "t3", 0.5), ("r1", "treatment", "t1", 1.0), ("r1", "treatment", "t2", None),
        ("r2", "treatment", "t5", 0.0), ("r2", "treatment", "t6", None),
    ], key=lambda x: x[:3])


def test_edge_cases_without_gradings_appear(spark, tmp_path):
    from trialmill.functions.scalars import edge_case_results

    write(tmp_path, {
        "r/one/iteration-1/e/with_skill/grading.json": '{"summary":{"passed":1,"total":2}}',
        "r/two/iteration-1/e/with_skill/grading.json": "{", "r/three/notes.txt": "x",
    })
    cases, gradings = files.edge_case_gradings(files.read_files(spark, str(tmp_path), "*"))
    got = {r.name: (r.passed, r.score) for r in edge_case_results(cases, gradings, ["pipeline_run_id", "name"]).collect()}
    assert got == {"one": (True, 0.5), "two": (False, 0.0), "three": (False, 0.0)}


def test_unreadable_gradings_are_error_trials_and_iterations_stand_below_the_run(spark):
    rows = [
        ("r/iteration-1/e/with_skill/grading.json", '{"summary":{"pass_rate":0.5}}'), ("r/iteration-2/e/with_skill/grading.json", "{"),
        ("r/iteration-1/e/without_skill/grading.json", '{"summary":{}}'), ("r/x/iteration-1/e/with_skill/grading.json", '{"summary":{"pass_rate":1.0}}'),
        ("r/iteration-3/e/with_skill/grading.json", '{"summary":{"pass_rate":1.0}}'),
    ]
    got = {r.trial_name: r.reward for r in files.grading_rows(spark.createDataFrame(rows, "path string, content string"), 2).collect()}
    assert got == {"iteration-1-treatment": 0.5, "iteration-2-treatment": None, "iteration-1-control": 0.0}


def test_thresholds_of_metadata_are_bounded_by_indentation(spark):
    texts = {
        "own": "name: x\ngate_policy:\n  evaluation:\n    mode: warn\n    threshold: 0.4\n", "short": "gate_policy:\n  evaluation:\n    threshold: .9",
        "exponent": "gate_policy:\r\n\r\n  evaluation:  # why\r\n\r\n    threshold: 1e-1 # low\r\n", "quoted": "gate_policy:\n evaluation:\n  threshold: '0.25'\n",
        "after": "gate_policy:\n  security:\n    threshold: 0.3\n    rules:\n      - a\n  evaluation:\n    limits:\n      threshold: 0.1\n    threshold: 0.6\n",
        "other": "gate_policy:\n  evaluation:\n    mode: warn\n  cisco2:\n    threshold: 0.3\n", "nested": "gate_policy:\n  evaluation:\n    limits:\n      threshold: 0.1\n",
        "none": "name: x\n", "elsewhere": "gates:\n  evaluation:\n    threshold: 0.3\n", "flow": "gate_policy: {evaluation: {threshold: 0.75}}\n",
        "inner flow": "gate_policy:\n  evaluation: {threshold: 0.75}\n", "word": "gate_policy:\n  evaluation:\n    threshold: high\n", "null": None,
    }
    rows = [(k, "metadata.yaml", v) for k, v in texts.items()]
    df = files.metadata_thresholds(spark.createDataFrame(rows, "submission_name string, file_path string, content string"), 0.5)
    got = {r.submission_name: (r.threshold, r.threshold_state) for r in df.collect()}
    own = {"own": 0.4, "short": 0.9, "exponent": 0.1, "quoted": 0.25, "after": 0.6}
    default = dict.fromkeys(("other", "nested", "none", "elsewhere", "null"), (0.5, "default"))
    odd = dict.fromkeys(("flow", "inner flow", "word"), (None, "not understood"))
    assert got == {k: (v, "own") for k, v in own.items()} | default | odd


def report(name, rewards, **extra):
    trials = [{"trial_name": f"t{i}", "reward": x, "passed": True} for i, x in enumerate(rewards)]
    return json.dumps({"submission_name": name, "provenance": {"eval_engine": "harbor"},
                       "summary": {"recommendation": "pass", "uplift": 0.1, "treatment": {"n_trials": len(rewards), "pass_rate": 0.5}, "control": {}},
                       "trials": {"treatment": trials, "control": []}, **extra})


def parsed(spark, rows):
    return spark.createDataFrame(rows, "pipeline_run_id string, artifact_text string").withColumn("doc", F.try_parse_json("artifact_text"))


def test_storing_twice_adds_nothing(spark, tmp_path):
    folder = str(tmp_path / "history")
    docs = parsed(spark, [("a", report("s", [1.0, None])), (None, report("t", [0.0])), ("a", report("s", [1.0, None])), ("bad", "{")])
    for _ in range(2):
        tables.store_runs(tables.report_runs(docs), tables.report_trials(docs), folder)
    runs = spark.read.parquet(f"{folder}/evaluation_runs")
    stored = {r.submission_name: r.pipeline_run_id for r in runs.collect()}
    assert stored["s"] == "a" and stored["t"].startswith("content-") and len(stored["t"]) == 24 and runs.count() == 2
    trials = spark.read.parquet(f"{folder}/trials")
    assert sorted((r.trial_name, r.reward, r.passed) for r in trials.where("pipeline_run_id = 'a'").collect()) == [("t0", 1.0, True), ("t1", None, False)]


def test_scans_are_skipped_on_their_own(spark, tmp_path):
    scans = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 3)], "pipeline_run_id string, scanner string, n int")
    tables.store_scans(scans.where("pipeline_run_id = 'a'"), str(tmp_path))
    tables.store_scans(scans, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/security_scans").count() == 3


def test_upsert_replaces_counters_only(spark):
    schema = "pipeline_run_id string, scanner string, scan_mode string, created_at string, passed boolean, findings_count int, critical_count int, high_count int, seq int"
    old = spark.createDataFrame([("a", "x", "warn", "d1", True, 1, 0, 0, 1)], schema)
    new = spark.createDataFrame([("a", "x", "block", "d2", False, 5, 1, 2, 2), ("b", "x", "warn", "d2", True, 0, 0, 0, 2)], schema)
    got = {r.pipeline_run_id: r for r in tables.upsert_scans(old, new).collect()}
    assert (got["a"].scan_mode, got["a"].created_at, got["a"].findings_count, got["a"].passed) == ("warn", "d1", 5, False)
    assert got["b"].findings_count == 0


def test_report_stream_stores_each_run_once(spark, tmp_path):
    write(tmp_path / "in", {"r1/report.json": report("s", [1.0]), "r2/report.json": report("t", [0.5])})
    folder, state = str(tmp_path / "out"), str(tmp_path / "state")
    for i in range(2):
        query = ingest_stream(report_stream(spark, str(tmp_path / "in")), folder, state, once=True)
        query.awaitTermination(120)
        write(tmp_path / "in", {"r3/report.json": report("u", [0.5])})
    runs = spark.read.parquet(f"{folder}/evaluation_runs")
    assert sorted(r.pipeline_run_id for r in runs.collect()) == ["r1", "r2", "r3"]


RUN = "submission_name string, eval_engine string, pipeline_run_id string, created_at timestamp, treatment_pass_rate double"


def test_degradation_stream_equals_the_batch_answer(spark, tmp_path):
    from trialmill.operators.history import degradation, score_variance

    start = dt.datetime(2026, 1, 1)
    scores = {"a": [0.9, 0.8, 0.3, 0.3, 0.9, 0.91], "b": [0.0, 0.0, 0.5], "c": [1.0]}
    rows = [(n, "harbor", f"{n}{i}", start + dt.timedelta(days=i), x) for n, xs in scores.items() for i, x in enumerate(xs)]
    source = str(tmp_path / "runs")
    spark.createDataFrame(rows[:4] + rows[6:7], RUN).coalesce(1).write.parquet(source)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    late = ("a", "harbor", "late", start - dt.timedelta(days=1), 0.1)
    for batch in (None, rows[4:6] + rows[7:] + [late]):
        if batch:
            spark.createDataFrame(batch, RUN).coalesce(1).write.mode("append").parquet(source)
        stream = degradation_stream(spark.readStream.schema(RUN).parquet(source))
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
        query.awaitTermination(180)
    got = {r.current_run_id: r for r in spark.read.parquet(out).collect()}
    assert len(got) == len(rows) + 1 and got["late"].late and not got["a5"].late
    runs = spark.createDataFrame(rows, RUN)
    for r in degradation(runs, by=("submission_name", "eval_engine")).collect():
        mine = got[r.current_run_id]
        assert (mine.degraded, mine.previous_run_id, mine.ratio) == (r.degraded, r.previous_run_id, r.ratio)
    for r in score_variance(runs, by=("submission_name", "eval_engine")).collect():
        last = got[f"{r.submission_name}{len(scores[r.submission_name]) - 1}"]
        assert last.score_variance == pytest.approx(r.score_variance) and last.run_count == r.run_count


def test_degradation_stream_places_late_runs_and_runs_without_score(spark, tmp_path):
    """Two shuffled batches: the second's newest run gets the batch answer though its predecessor came late."""
    from trialmill.operators.history import degradation, score_variance

    start = dt.datetime(2026, 1, 1)
    scores = {"a": [0.9, 0.8, 0.7, 0.2], "b": [0.5, None, 0.5], "c": [0.4, 0.0, 0.3], "d": [None, 0.6]}
    rows = {(n, i): (n, "ase", f"{n}{i}", start + dt.timedelta(days=i), x) for n, xs in scores.items() for i, x in enumerate(xs)}
    source, out, state = (str(tmp_path / x) for x in ("runs", "out", "state"))
    first = [("a", 1), ("a", 0), ("b", 1), ("c", 0), ("d", 1)]
    for batch in (first, [k for k in reversed(rows) if k not in first and k != ("a", 3)], [("a", 3)]):
        spark.createDataFrame([rows[k] for k in batch], RUN).coalesce(1).write.mode("append").parquet(source)
        stream = degradation_stream(spark.readStream.schema(RUN).parquet(source))
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
        query.awaitTermination(180)
    got = {r.current_run_id: r for r in spark.read.parquet(out).collect()}
    assert len(got) == len(rows)
    assert {k for k, r in got.items() if r.late} == {"b0", "d0"}
    runs = spark.createDataFrame(list(rows.values()), RUN)
    answers = {r.submission_name: r for r in degradation(runs, by=("submission_name", "eval_engine")).collect()}
    spreads = {r.submission_name: r for r in score_variance(runs, by=("submission_name", "eval_engine")).collect()}
    for n in "abc":
        r, mine = answers[n], got[answers[n].current_run_id]
        assert (mine.degraded, mine.previous_run_id, mine.previous_score, mine.ratio) == (r.degraded, r.previous_run_id, r.previous_score, r.ratio)
        assert mine.score_variance == pytest.approx(spreads[n].score_variance) and mine.run_count == spreads[n].run_count
    assert got["b1"].current_score is None and got["b2"].previous_score is None and got["b2"].score_variance == 0.0
    assert got["d1"].previous_run_id is None and got["d0"].ratio is None


def test_profiles_and_policies(spark):
    assert config.available_profiles() == ["skill", "mcp_server", "plugin", "agent", "full"]
    assert config.load_profile()["trusted"][0] == "evaluation_assets"
    with pytest.raises(ValueError):
        config.load_profile("x")
    df = spark.sql("""SELECT 's' AS submission_name, parse_json('{"default_mode":"block","gates":{"evaluation":{"threshold":0.2,"push_fact":true}}}') AS policy""")
    item = config.gate_policy_items(df).first()
    assert (item.gate_name, item.mode, item.threshold, item.weight, item.push_fact) == ("evaluation", "warn", 0.2, 1.0, True)
    assert config.gate_policy_defaults(df).first().combination == "all_pass"


def test_both_task_layouts(spark):
    legacy = {"evalName": "e", "taskResults": [{"taskId": "a", "status": "PASS", "durationMs": 5, "toolCalls": [{"server": "s"}]},
                                               {"taskId": "b", "status": "weird", "error": "x"}, {"name": "c"}]}
    current = {"results": [{"taskPath": "p", "taskPassed": False, "callHistory": {"ToolCalls": []}, "toolCalls": [{"tool": "t", "success": False}]}]}
    rows = [("l", "s", json.dumps(legacy)), ("c", "s", json.dumps(current)), ("n", "s", "{}")]
    docs = spark.createDataFrame(rows, "run string, submission_name string, t string").withColumn("doc", F.parse_json("t"))
    tasks = taskrun.extract_tasks(docs, ["run", "submission_name"])
    got = {(r.run, r.task_id): (r.status, r.tool_calls, r.error_message) for r in tasks.collect()}
    assert got == {("l", "a"): ("passed", 1, None), ("l", "b"): ("error", 0, "x"), ("l", "c"): ("error", 0, None), ("c", "p"): ("failed", 1, None)}
    totals = {r.run: (r.overall_score, r.total_duration_ms, r.eval_name, r.recommendation) for r in taskrun.task_run_totals(docs, tasks, ["run", "submission_name"]).collect()}
    assert totals["l"] == (pytest.approx(1 / 3), 5, "e", "fail") and totals["n"] == (0.0, None, "unknown", "fail")


def test_trajectory_without_history(spark):
    doc = {"artifacts": [{"parts": [{"kind": "text", "text": "hello"}]}], "status": {"message": {"parts": [
        {"kind": "data", "metadata": {"type": "function_response"}, "data": {"id": "c1", "response": {"a": 1}}}]}}}
    df = spark.createDataFrame([("r", "do", json.dumps(doc))], "run string, instruction string, t string").withColumn("doc", F.parse_json("t"))
    user, agent = trajectory.trajectory_steps(df, ["run"]).orderBy("step_id").collect()
    assert (user.source, user.message) == ("user", "do")
    assert agent.message == "hello" and agent.observations[0].content == '{"a":1}' and agent.observations[0].source_call_id == "c1"


def test_token_usage_and_durations(spark):
    calls = spark.createDataFrame([("r", "p", 1, 10, 5, None), ("r", "p", 2, 1, 1, "m1"), ("r", "q", 3, 0, 2, "m2"), ("z", "p", 1, 0, 0, None)],
                                  "run string, phase string, seq int, prompt_tokens long, completion_tokens long, model string")
    usage = metrics.token_usage(calls, ["run"])
    got = {(r.run, r.phase): (r.total_tokens, r.call_count, r.model_name) for r in usage.collect()}
    assert got[("r", "p")] == (17, 2, "m1") and got[("r", None)] == (19, 3, "m1")
    times = spark.createDataFrame([("r", "test", 1.0, 3.5), ("r", "test", 5.0, 6.0)], "run string, phase string, start_time double, end_time double")
    rows = metrics.observability_rows(usage, metrics.phase_durations(times, ["run"]), ["run"]).collect()
    assert [(r.run, r.test_duration_ms, r.total_tokens) for r in rows] == [("r", 1000, 19)]


@pytest.mark.parametrize(
    "answer, passed, issues",
    [('{"pass": true}', True, []), ('x {"pass": false, "issues": "one"} y', False, ["one"]), ("It will FAIL but looks good", False, ["It will FAIL but looks good"]),
     ("approved", True, []), ("hm", True, []), ("{broken fail", False, ["{broken fail"])],
)
def test_reviewer_answers(spark, answer, passed, issues):
    v = spark.createDataFrame([(answer,)], "a string").select(reviews.parse_verdict(F.col("a")).alias("v")).first().v
    assert (v.passed, v.issues) == (passed, issues)


def test_quick_mean_lets_zero_fall_through(spark):
    df = spark.createDataFrame([("r", 0.0, 0.4), ("r", 0.8, None), ("r", None, None)], "run string, nested_reward double, flat_reward double")
    assert summary.quick_mean(df, ["run"]).first().mean_reward == pytest.approx(0.4)


def test_limits_are_unset_by_default(spark):
    found = spark.createDataFrame([("s", i, "low", "r", "m" * 80) for i in range(30)], "scan string, finding_no int, severity string, rule_id string, message string")
    every, some = reviews.shown_findings(found, ["scan"]).collect(), reviews.shown_findings(found, ["scan"], 20, 60).collect()
    assert (len(every), every[0].more, len(every[0].message)) == (30, 0, 80) and (len(some), some[0].more, len(some[0].message)) == (20, 10, 60)
    cases = spark.createDataFrame([("s", f"c{i}") for i in range(5)], "sub string, case_id string")
    assert reviews.first_cases(cases, ["sub"]).count() == 5 and reviews.first_cases(cases, ["sub"], 3).count() == 3
    texts = spark.createDataFrame([("s", "a.md", "x" * 6), ("s", "b.md", "x" * 6), ("s", "c.md", "x")], "submission_name string, file_path string, content string")
    assert [r.chars_upto for r in reviews.review_input(texts).orderBy("file_path").collect()] == [6, 12, 13]
    assert reviews.review_input(texts, 10).count() == 1
    long = spark.createDataFrame([("y" * 5000,)], "t string")
    sizes = long.select(F.length(reviews.quality_criteria(F.col("t"))).alias("a"), F.length(reviews.quality_criteria(F.col("t"), 3000)).alias("b")).first()
    assert (sizes.a, sizes.b) == (5000, 3000)
    outcomes = spark.createDataFrame([(f"p{i:03}", "error") for i in range(80)], "path string, outcome string")
    assert tables.last_errors(outcomes).count() == 80 and tables.last_errors(outcomes, 50).count() == 50


def test_criteria_of_a_long_text_of_other_headings(spark):
    import time

    other = "## x\n" * 40_000
    headed = "a\n## Workflow\n one\n## x\n## z Workflow \n two\n\n## Else\nthree"
    df = spark.createDataFrame([(other,), (headed,), (None,), ("---\nn: x\n---\n## Common Issues",)], "t string")
    start = time.time()
    assert [r[0] for r in df.select(reviews.quality_criteria(F.col("t"))).collect()] == [other, "## Workflow\n one\n## x\n## z Workflow\ntwo", None, "## Common Issues"]
    assert time.time() - start < 30  # linear in the text


def test_submission_files_are_read_by_many_tasks(spark, tmp_path):
    from trialmill.plans import submission_queries

    spark.range(100).selectExpr("id AS p_partkey").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    assert submission_queries.part_files(spark, str(tmp_path)).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
