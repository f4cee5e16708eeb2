import json

import pytest
from pyspark.sql import functions as F

from trialmill.operators import certify, gates, harness, pairwise, scorecard

GATE = "run string, gate_order long, gate_type string, gate_name string, passed boolean, score double, mode string, weight double, combination string"


def card(spark, combination, *rows):
    data = [("r", i, "engine", name, ok, score, mode, weight, combination) for i, (name, ok, score, mode, weight) in enumerate(rows)]
    return scorecard.combine(spark.createDataFrame(data, GATE), ["run"]).first()


@pytest.mark.parametrize(
    "combination, rows, verdict, reason",
    [
        ("all_pass", [("e", True, 1.0, "block", 1.0), ("s", True, 1.0, "warn", 1.0)], "pass", "All gates passed"),
        ("all_pass", [("e", False, 0.0, "block", 1.0), ("s", False, 0.0, "block", 1.0)], "fail", "Blocking gates failed: e, s"),
        ("all_pass", [("e", True, 1.0, "block", 1.0), ("s", False, 0.0, "warn", 1.0)], "warn", "Warning gates failed: s"),
        ("any_pass", [("e", False, 0.0, "warn", 1.0)], "pass", "No blocking gates configured"),
        ("any_pass", [("e", False, 0.0, "block", 1.0), ("s", True, 1.0, "block", 1.0)], "pass", "Blocking gates passed: s"),
        ("any_pass", [("e", False, 0.0, "block", 1.0)], "fail", "No blocking gates passed: e"),
        ("weighted", [("e", True, 0.9, "block", 2.0), ("s", True, 0.3, "block", 1.0)], "pass", "Weighted score 0.70 >= 0.70"),
        ("weighted", [("e", True, 0.6, "block", 1.0), ("s", True, 0.0, "warn", 1.0)], "warn", "Weighted score 0.60 between 0.50-0.70"),
        ("weighted", [("e", True, 0.6, "warn", 1.0), ("s", True, 0.2, "warn", 1.0)], "fail", "Weighted score 0.40 < 0.50"),
        ("weighted", [("e", True, 0.6, "block", 0.0)], "fail", "Weighted score 0.00 < 0.50"),
    ],
)
def test_verdicts(spark, combination, rows, verdict, reason):
    got = card(spark, combination, *rows)
    assert (got.recommendation, got.recommendation_reason) == (verdict, reason)


def scan(spark, mode, text):
    df = spark.createDataFrame([("r", mode, text)], "run string, mode string, artifact_text string")
    return gates.scan_gate(gates.parse_artifact(df, "artifact_text"), ["run"], "security", "cisco", 10).first()


def found(*severities):
    return json.dumps({"findings": [{"severity": s} for s in severities]})


@pytest.mark.parametrize(
    "mode, text, passed, score",
    [
        ("disabled", None, True, 1.0), ("warn", None, True, 1.0), ("block", None, False, 0.0),
        ("warn", "{", False, 0.0), ("block", found(), True, 1.0), ("block", found("High "), False, 0.25),
        ("warn", found("critical"), True, 0.0), ("block", found("medium", "weird"), True, 0.7), ("block", "{}", True, 1.0),
    ],
)
def test_scan_gate(spark, mode, text, passed, score):
    row = scan(spark, mode, text)
    assert row.passed is passed and row.score == pytest.approx(score)


def test_finding_fields_have_fallbacks_and_a_text_location_is_ignored(spark):
    text = json.dumps({"findings": [{"id": "x", "description": "d", "location": {"file": "f"}}, {"location": "here"}]})
    a, b = scan(spark, "warn", text).findings
    assert (a.rule_id, a.message, a.location, a.severity) == ("x", "d", "f", "info")
    assert (b.rule_id, b.location) == ("unknown", None)


def test_edge_case_gate_threshold_zero_counts_as_unset(spark):
    text = json.dumps({"edge_case_results": [{"passed": True}, {"passed": False}, {"passed": False}]})
    df = spark.createDataFrame(
        [("a", "block", 0.0, text), ("b", "block", 0.3, text), ("c", "warn", 0.9, text), ("d", "block", 0.9, '{"edge_case_results":[]}')],
        "run string, mode string, policy_threshold double, artifact_text string",
    )
    got = {r.run: (r.passed, round(r.score, 4)) for r in gates.edge_case_gate(gates.parse_artifact(df, "artifact_text"), ["run"]).collect()}
    assert got == {"a": (False, 0.3333), "b": (True, 0.3333), "c": (True, 0.3333), "d": (True, 1.0)}


@pytest.mark.parametrize(
    "value, ok", [("true", True), ("false", False), ("1", False), ("1.0", True), ("3", True), ("2", False), ("2.9", False), ("3.0", True),
                  ("0.5", True), ("0.49", False), ("0", False), ("7", True), ("6.5", True), ("-1", False)],
)
def test_judge_values_depend_on_their_json_type(spark, value, ok):
    df = spark.sql(f"""SELECT 'r' AS run, parse_json('{{"c":{{"j":{{"value":{value}}}}}}}') AS per_case""")
    row = harness.case_rewards(harness.judge_rows(df, ["run"]), ["run"]).first()
    assert row.case_passed is ok


@pytest.mark.parametrize(
    "case, reward", [('{"reward":0.9,"j":{"value":1}}', 0.9), ("{}", None), ('{"a":{"value":true},"b":{"value":3}}', 3.0),
                     ('{"a":{"value":false},"b":true}', 1.0), ('{"a":2,"b":{"value":4}}', 3.0), ('"text"', None), ('{"a":{"note":"x"}}', None)],
)
def test_case_rewards(spark, case, reward):
    df = spark.sql(f"""SELECT 'r' AS run, parse_json('{{"c":{case}}}') AS per_case""")
    row = harness.case_rewards(harness.judge_rows(df, ["run"]), ["run"]).first()
    assert row.reward == reward


@pytest.mark.parametrize(
    "counts, passed, rate", [((3, 1, 0, 0), True, 0.75), ((0, 0, 4, 0), True, 0.0), ((0, 0, 4, 1), False, 0.0), ((0, 0, 0, 3), False, 0.0),
                             ((1, 0, 1, 1), False, 1 / 3), ((0, 0, 0, 0), False, 0.0), ((1, 1, 0, 0), True, 0.5)],
)
def test_pairwise(spark, counts, passed, rate):
    row = pairwise.pairwise_outcome(spark.createDataFrame([counts], "wins_a long, wins_b long, ties long, errors long")).first()
    assert row.passed is passed and row.win_rate == pytest.approx(rate)


def certified(spark, gate_rows, profile=None, **facts):
    base = {"scorecard_id": "r", "submission_name": "s", "validation_passed": True, "metadata_valid": True, "has_eval_assets": True,
            "operational_passed": True, "operational_score": 1.0, "std_reward": 0.1, "score_variance": None, "stability_runs": None,
            "edge_total": 4, "edge_passed": 4, "failure_mode_score": None, "failure_mode_threshold": None, **facts}
    schema = ("scorecard_id string, submission_name string, validation_passed boolean, metadata_valid boolean, has_eval_assets boolean, "
              "operational_passed boolean, operational_score double, std_reward double, score_variance double, stability_runs long, "
              "edge_total int, edge_passed int, failure_mode_score double, failure_mode_threshold double")
    runs = spark.createDataFrame([tuple(base.values())], schema)
    gates_df = spark.createDataFrame([("r", i, *g) for i, g in enumerate(gate_rows)],
                                     "scorecard_id string, gate_order long, gate_type string, passed boolean, score double, findings_count int")
    return certify.certify(certify.resolve_policy(runs, None, profile), gates_df, ["scorecard_id"]).first()


GOOD = [("engine", True, 0.9, 0), ("security", True, 1.0, 0), ("quality", True, 0.8, 0)]


def test_everything_passes(spark):
    assert certified(spark, GOOD).highest_level == "certified"


def test_first_failing_gate_replaces_a_passing_one(spark):
    row = certified(spark, [*GOOD, ("security", False, 0.2, 3), ("security", False, 0.1, 1)])
    check = row.checks["basic_security_validation"]
    assert check.passed is False and check.score == 0.2 and row.highest_level == "none"


def test_a_missing_gate_fails_its_checks(spark):
    row = certified(spark, GOOD[:2])
    assert row.highest_level == "none" and row.foundational.failed_checks == ["content_quality_review"]


def test_hierarchy_holds_back_higher_levels(spark):
    row = certified(spark, GOOD, has_eval_assets=False)
    assert row.highest_level == "foundational" and row.certified.passed is False
    assert row.certified.checks_passed == row.certified.checks_total


def test_profiles(spark):
    assert certified(spark, GOOD[:2], "mcp_server").highest_level == "certified"
    with pytest.raises(Exception, match="unknown certification profile"):
        certified(spark, GOOD, "nothing")


def test_behaviour_needs_two_sub_checks(spark):
    alone = certified(spark, GOOD, edge_total=0)
    assert alone.checks["enterprise_behavioral_testing"].passed is False and alone.behavior_active == 1
    drift = certified(spark, GOOD, score_variance=0.2, stability_runs=3)
    assert drift.behavior_passed is False
    assert drift.behavior_score == pytest.approx((0.3 * (1 - 0.5 / 3) + 0.3 * 1.0 + 0.2 * 0.0) / 0.8)
    early = certified(spark, GOOD, score_variance=0.2, stability_runs=2)
    assert early.behavior_passed is True


def test_gate_checks_fold_by_hash_aggregation(spark):
    df = spark.createDataFrame([("r", 1, "engine", True, 0.5, 0)], "run string, gate_order long, gate_type string, passed boolean, score double, findings_count int")
    for c in certify.THRESHOLDS:
        df = df.withColumn(f"threshold_{c}", F.lit(0.5))
    plan = certify.merge_gate_checks(df, ["run"])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
