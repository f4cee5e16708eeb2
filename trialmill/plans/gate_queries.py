"""Queries on gates, verdicts and certification."""

from __future__ import annotations

from pyspark.sql import functions as F

from trialmill.operators import certify, gates, harness, pairwise, scorecard
from trialmill.plans import relations as rel
from trialmill.plans.registry import Registry, rounded
from trialmill.sinks import tables

registry = Registry()
ID = ["scorecard_id"]

ITEMS = """items AS (
  SELECT o_orderkey AS scorecard_id, 'evaluation' AS gate_name, CASE WHEN o_orderkey % 5 < 3 THEN 'block' ELSE 'warn' END AS mode,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 0.55 END::DOUBLE AS threshold, (1.0 + o_orderkey % 3)::DOUBLE AS weight,
         o_orderkey % 2 = 0 AS push_fact FROM orders WHERE o_orderkey % 3 <> 0
  UNION ALL
  SELECT o_orderkey, 'security', CASE WHEN o_orderkey % 10 = 0 THEN 'disabled' ELSE 'block' END, NULL, 2.0, false
  FROM orders WHERE o_orderkey % 2 = 0)"""
CARDS = """cards AS (
  SELECT o_orderkey AS scorecard_id, 'sub-' || o_custkey AS submission_name,
         CASE o_orderstatus WHEN 'F' THEN 'all_pass' WHEN 'O' THEN 'any_pass' ELSE 'weighted' END AS combination,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'block' WHEN '2-HIGH' THEN 'disabled' ELSE 'warn' END AS default_mode
  FROM orders)"""
GATES = """gates AS (
  SELECT l_orderkey AS scorecard_id, l_linenumber::BIGINT * 100000000000000 + l_partkey * 1000000 + round(l_extendedprice * 100)::BIGINT % 1000000 AS gate_order, k.gate_type,
         CASE k.gate_type WHEN 'engine' THEN 'evaluation' ELSE k.gate_type END AS gate_name,
         l_returnflag <> 'R' AS passed, greatest(0.0, 1.0 - l_discount * 5) AS score,
         CASE WHEN l_quantity > 40 THEN 2 ELSE 0 END AS findings_count,
         CASE WHEN k.gate_type = 'behavioral' THEN trunc(l_quantity)::INT END AS edge_total,
         CASE WHEN k.gate_type = 'behavioral' THEN trunc(l_quantity * (1.0 - l_tax * 8))::INT END AS edge_passed
  FROM lineitem, LATERAL (SELECT CASE l_linenumber % 4 WHEN 0 THEN 'behavioral' WHEN 1 THEN 'engine' WHEN 2 THEN 'security'
                          ELSE 'quality' END AS gate_type) k)"""
JUDGED = """judged AS (
  SELECT g.*, c.combination, coalesce(i.mode, c.default_mode, 'warn') AS mode, coalesce(i.weight, 1.0) AS weight,
         i.threshold AS policy_threshold, coalesce(i.push_fact, false) AS push_fact
  FROM gates g LEFT JOIN cards c USING (scorecard_id) LEFT JOIN items i USING (scorecard_id, gate_name))"""


def judged_gates(spark, sf):
    return scorecard.apply_gate_policy(
        rel.gate_rows(spark, sf), rel.policy_items(spark, sf), rel.scorecards(spark, sf), key="scorecard_id"
    )


@registry.add(
    "gate_policy",
    f"WITH {ITEMS}, {CARDS}, {GATES}, {JUDGED} SELECT scorecard_id, gate_order, gate_name, mode, weight, "
    "policy_threshold, push_fact, combination FROM judged",
)
def gate_policy(spark, sf):
    return judged_gates(spark, sf).select(
        "scorecard_id", "gate_order", "gate_name", "mode", "weight", "policy_threshold", "push_fact", "combination"
    )


@registry.add(
    "facts_to_push",
    f"WITH {ITEMS}, {CARDS}, {GATES}, {JUDGED} SELECT gate_type, count(*) AS n, count(DISTINCT scorecard_id) AS n_cards "
    "FROM judged WHERE push_fact GROUP BY ALL",
)
def facts_to_push(spark, sf):
    return (
        judged_gates(spark, sf).where("push_fact").groupBy("gate_type")
        .agg(F.count(F.lit(1)).alias("n"), F.countDistinct("scorecard_id").alias("n_cards"))
    )


@registry.add(
    "scorecard_verdict",
    f"""WITH {ITEMS}, {CARDS}, {GATES}, {JUDGED}, t AS (
        SELECT c.scorecard_id, c.combination, count(j.gate_type) AS n,
               count(*) FILTER (WHERE passed) AS gates_passed, count(*) FILTER (WHERE NOT passed) AS gates_failed,
               count(*) FILTER (WHERE mode = 'block') AS nb,
               count(*) FILTER (WHERE mode = 'block' AND passed) AS blocking_gates_passed,
               count(*) FILTER (WHERE mode = 'block' AND NOT passed) AS blocking_gates_failed,
               count(*) FILTER (WHERE mode = 'warn' AND NOT passed) AS wf,
               coalesce(sum(score * weight) FILTER (WHERE mode = 'block') / sum(weight) FILTER (WHERE mode = 'block'),
                        avg(score)) AS w,
               string_agg(gate_name, ', ' ORDER BY gate_order) FILTER (WHERE mode = 'block' AND NOT passed) AS fb,
               string_agg(gate_name, ', ' ORDER BY gate_order) FILTER (WHERE mode = 'warn' AND NOT passed) AS fw,
               string_agg(gate_name, ', ' ORDER BY gate_order) FILTER (WHERE mode = 'block' AND passed) AS pb,
               string_agg(gate_name, ', ' ORDER BY gate_order) FILTER (WHERE mode = 'block') AS ab
        FROM cards c LEFT JOIN judged j USING (scorecard_id) GROUP BY ALL)
        SELECT scorecard_id, combination AS combination_mode, gates_passed, gates_failed, blocking_gates_passed,
               blocking_gates_failed, (w) + 0.0 AS weighted_score,
               CASE WHEN n = 0 THEN 'fail'
                    WHEN combination = 'all_pass' THEN CASE WHEN fb IS NOT NULL THEN 'fail' WHEN fw IS NOT NULL THEN 'warn' ELSE 'pass' END
                    WHEN combination = 'any_pass' THEN CASE WHEN nb = 0 OR pb IS NOT NULL THEN 'pass' ELSE 'fail' END
                    WHEN round(w, 12) >= 0.7 THEN 'pass' WHEN round(w, 12) >= 0.5 THEN 'warn' ELSE 'fail' END AS recommendation,
               CASE WHEN n = 0 THEN 'No gates evaluated'
                    WHEN combination = 'all_pass' THEN CASE WHEN fb IS NOT NULL THEN 'Blocking gates failed: ' || fb
                         WHEN fw IS NOT NULL THEN 'Warning gates failed: ' || fw ELSE 'All gates passed' END
                    WHEN combination = 'any_pass' THEN CASE WHEN nb = 0 THEN 'No blocking gates configured'
                         WHEN pb IS NOT NULL THEN 'Blocking gates passed: ' || pb ELSE 'No blocking gates passed: ' || ab END
                    ELSE printf('Weighted score %.2f ', round(w, 12)) || CASE WHEN round(w, 12) >= 0.7 THEN '>= 0.70' WHEN round(w, 12) >= 0.5 THEN 'between 0.50-0.70' ELSE '< 0.50' END END AS reason
        FROM t""",
)
def scorecard_verdict(spark, sf):
    cards = rel.scorecards(spark, sf)
    df = scorecard.combine(judged_gates(spark, sf), ID, cards)
    return rounded(df.withColumnRenamed("recommendation_reason", "reason"))


@registry.add(
    "enabled_gates",
    f"""WITH {CARDS}, {GATES}, off AS (SELECT o_orderkey AS scorecard_id FROM orders WHERE o_orderkey % 6 = 0)
        SELECT gate_type, count(*) AS n FROM gates g JOIN cards c USING (scorecard_id) LEFT JOIN off o USING (scorecard_id)
        WHERE gate_type = 'engine' OR (coalesce(CASE WHEN gate_type = 'security' AND o.scorecard_id IS NOT NULL THEN 'disabled' END,
              default_mode) <> 'disabled') GROUP BY ALL""",
)
def enabled_gates(spark, sf):
    items = rel.table(spark, sf, "orders").where("o_orderkey % 6 = 0").select(
        F.col("o_orderkey").alias("scorecard_id"), F.lit("cisco").alias("gate_name"), F.lit("disabled").alias("mode")
    )
    named = rel.gate_rows(spark, sf).withColumn(
        "policy_key", F.when(F.col("gate_type") == "security", "cisco").otherwise(F.col("gate_type"))
    )
    kept = scorecard.drop_disabled(named, items, rel.scorecards(spark, sf), key="scorecard_id")
    return kept.groupBy("gate_type").agg(F.count(F.lit(1)).alias("n"))


FINDINGS = """raw AS (SELECT l_orderkey AS scorecard_id, l_linenumber AS ln, CASE l_linenumber % 6 WHEN 0 THEN 'critical' WHEN 1 THEN 'high'
    WHEN 2 THEN 'medium' WHEN 3 THEN 'low' ELSE 'info' END AS severity FROM lineitem),
  sums AS (SELECT scorecard_id, count(*) AS n, count(*) FILTER (WHERE severity IN ('critical', 'high')) AS serious,
    avg(CASE severity WHEN 'critical' THEN 0.0 WHEN 'high' THEN 0.25 WHEN 'medium' THEN 0.5 WHEN 'low' THEN 0.75 ELSE 0.9 END) AS s
    FROM raw GROUP BY ALL),
  arts AS (SELECT o_orderkey AS scorecard_id, CASE o_orderstatus WHEN 'F' THEN 'block' WHEN 'O' THEN 'warn' ELSE 'disabled' END AS mode,
    CASE WHEN o_orderkey % 13 = 5 THEN 'absent' WHEN o_orderkey % 11 = 3 THEN 'corrupt' ELSE 'ok' END AS state,
    coalesce(n, 0) AS n, coalesce(serious, 0) AS serious, coalesce(s, 1.0) AS s
    FROM orders LEFT JOIN sums ON scorecard_id = o_orderkey)"""


@registry.add(
    "scan_gate",
    f"""WITH {FINDINGS} SELECT scorecard_id, mode,
        CASE WHEN mode = 'disabled' THEN true WHEN state = 'absent' THEN mode <> 'block' WHEN state = 'corrupt' THEN false
             ELSE mode <> 'block' OR serious = 0 END AS passed,
        (CASE WHEN mode = 'disabled' THEN 1.0 WHEN state = 'absent' THEN CASE mode WHEN 'block' THEN 0.0 ELSE 1.0 END
             WHEN state = 'corrupt' THEN 0.0 ELSE s END)::DOUBLE AS score,
        CASE WHEN mode <> 'disabled' AND state = 'ok' THEN n ELSE 0 END AS findings_count FROM arts""",
)
def scan_gate(spark, sf):
    docs = gates.parse_artifact(rel.scan_documents(spark, sf), "artifact_text")
    df = gates.scan_gate(docs, ID, "security", "cisco", 10)
    return rounded(df.select("scorecard_id", "mode", "passed", "score", "findings_count"))


@registry.add(
    "scan_severity_counts",
    f"""WITH {FINDINGS} SELECT scorecard_id,
        {', '.join(f"count(*) FILTER (WHERE severity = '{s}') AS n_{s}" for s in gates.SEVERITIES)},
        count(*) FILTER (WHERE ln % 2 = 0) AS n_a_file, count(*) FILTER (WHERE ln % 3 <> 0) AS n_described
        FROM arts LEFT JOIN raw USING (scorecard_id) WHERE state = 'ok' GROUP BY ALL""",
)
def scan_severity_counts(spark, sf):
    docs = gates.parse_artifact(rel.scan_documents(spark, sf), "artifact_text").where("artifact_state = 'ok'")
    df = docs.withColumn("findings", gates.findings_of(F.col("doc")))
    counts = gates.severity_counts(F.col("findings"))
    return df.select(
        "scorecard_id",
        *[counts[s].alias(f"n_{s}") for s in gates.SEVERITIES],
        F.size(F.filter("findings", lambda f: f["location"] == "a.md")).alias("n_a_file"),
        F.size(F.filter("findings", lambda f: f["message"] == "d")).alias("n_described"),
    )


REVIEWS = """revs AS (SELECT o_orderkey AS k, CASE o_orderstatus WHEN 'F' THEN 'block' WHEN 'O' THEN 'warn' ELSE 'disabled' END AS mode,
    CASE WHEN o_orderkey % 17 = 2 THEN 'absent' WHEN o_orderkey % 19 = 4 THEN 'corrupt' ELSE 'ok' END AS state,
    (o_orderkey % 100) / 100.0 AS clarity, ((o_orderkey % 100) * 7 % 100) / 100.0 AS safety,
    CASE WHEN o_orderkey % 9 = 0 THEN 0.75 ELSE 0.6 END AS t,
    CASE o_orderkey % 4 WHEN 0 THEN 'fail' WHEN 1 THEN 'warn' ELSE 'pass' END AS rec FROM orders)"""


@registry.add(
    "review_gate",
    f"""WITH {REVIEWS} SELECT k AS scorecard_id, mode,
        CASE WHEN mode = 'disabled' THEN true WHEN state = 'absent' THEN mode <> 'block' WHEN state = 'corrupt' THEN false
             WHEN mode = 'block' THEN (clarity + safety) / 2 >= t ELSE rec <> 'fail' END AS passed,
        (CASE WHEN mode = 'disabled' THEN 1.0 WHEN state = 'absent' THEN CASE mode WHEN 'block' THEN 0.0 ELSE 1.0 END
             WHEN state = 'corrupt' THEN 0.0 ELSE (clarity + safety) / 2 END)::DOUBLE AS score,
        CASE WHEN mode <> 'disabled' AND state = 'ok' THEN t END::DOUBLE AS threshold,
        CASE WHEN mode <> 'disabled' AND state = 'ok' THEN (clarity < 0.6)::INT + (safety < 0.6 AND k % 5 <> 0)::INT ELSE 0 END
        AS findings_count FROM revs""",
)
def review_gate(spark, sf):
    docs = gates.parse_artifact(rel.review_documents(spark, sf), "artifact_text")
    return rounded(
        gates.review_gate(docs, ID).select("scorecard_id", "mode", "passed", "score", "threshold", "findings_count")
    )


@registry.add(
    "review_dimensions",
    f"""WITH {REVIEWS}, d AS (SELECT k, 'clarity' AS dimension, clarity AS score FROM revs WHERE state = 'ok'
        UNION ALL SELECT k, 'safety', safety FROM revs WHERE state = 'ok')
        SELECT k AS scorecard_id, dimension, (score)::DOUBLE AS score, CASE WHEN score < 0.4 THEN 'high'
          WHEN score < 0.6 THEN 'medium' WHEN score < 0.8 THEN 'low' ELSE 'info' END AS severity FROM d""",
)
def review_dimensions(spark, sf):
    docs = gates.parse_artifact(rel.review_documents(spark, sf), "artifact_text")
    return rounded(gates.review_dimensions(docs, ID).select("scorecard_id", "dimension", "score", "severity"))


@registry.add(
    "edge_case_gate",
    """WITH e AS (SELECT o_orderkey AS k, CASE o_orderstatus WHEN 'F' THEN 'block' WHEN 'O' THEN 'warn' ELSE 'disabled' END AS mode,
          CASE WHEN o_orderkey % 17 = 2 THEN 'absent' WHEN o_orderkey % 19 = 4 THEN 'corrupt' ELSE 'ok' END AS state,
          o_orderkey % 5 AS total, CASE WHEN o_orderkey % 3 = 1 THEN 0.7 ELSE 0.5 END AS t,
          len(list_filter(range(1, o_orderkey % 5 + 1), lambda i: (o_orderkey + i) % 3 <> 0)) AS good FROM orders)
        SELECT k AS scorecard_id, CASE WHEN mode = 'disabled' THEN true WHEN state = 'absent' THEN mode <> 'block'
            WHEN state = 'corrupt' THEN false WHEN total = 0 THEN true ELSE mode = 'warn' OR good / total >= t END AS passed,
          (CASE WHEN mode = 'disabled' THEN 1.0 WHEN state = 'absent' THEN CASE mode WHEN 'block' THEN 0.0 ELSE 1.0 END
            WHEN state = 'corrupt' THEN 0.0 WHEN total = 0 THEN 1.0 ELSE good / total END)::DOUBLE AS score,
          CASE WHEN mode <> 'disabled' AND state = 'ok' AND total > 0 THEN total END::INT AS edge_total,
          CASE WHEN mode <> 'disabled' AND state = 'ok' AND total > 0 THEN good END::INT AS edge_passed FROM e""",
)
def edge_case_gate(spark, sf):
    docs = gates.parse_artifact(rel.edge_case_documents(spark, sf), "artifact_text")
    return rounded(
        gates.edge_case_gate(docs, ID).select("scorecard_id", "passed", "score", "edge_total", "edge_passed")
    )


@registry.add(
    "engine_gates",
    """WITH r AS (SELECT o_orderkey AS k, o_orderkey % 2 AS s, CASE WHEN o_orderkey % 5 <> 0 THEN (o_totalprice % 400 - 200) / 100 END AS gap,
          (o_totalprice % 100 - 50) / 100 AS uplift, CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice % 150 / 100 END AS mean,
          CASE WHEN o_orderkey % 3 <> 0 THEN CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 0.55 END END AS t FROM orders)
        SELECT k AS scorecard_id, CASE s WHEN 0 THEN 'harbor' ELSE 'a2a' END AS policy_key,
          CASE s WHEN 0 THEN coalesce(gap, uplift) >= coalesce(t, 0.0) ELSE coalesce(mean, 0) >= coalesce(t, 0.5) END AS passed,
          (greatest(0, least(1, coalesce(mean, 0)))) + 0.0 AS score,
          coalesce(t, CASE s WHEN 0 THEN 0.0 ELSE 0.5 END)::DOUBLE AS threshold FROM r""",
)
def engine_gates(spark, sf):
    number, price = F.col("o_orderkey"), F.col("o_totalprice")
    runs = rel.table(spark, sf, "orders").select(
        number.alias("scorecard_id"),
        F.lit("evaluation").alias("gate_name"),
        F.when(number % 2 == 0, "harbor").otherwise("a2a").alias("eval_engine"),
        F.when(number % 5 != 0, (price % 400 - 200) / 100).alias("mean_reward_gap"),
        ((price % 100 - 50) / 100).alias("uplift"),
        F.when(number % 11 != 0, price % 150 / 100).alias("treatment_mean_reward"),
    )
    with_policy = scorecard.apply_gate_policy(runs, rel.policy_items(spark, sf), key="scorecard_id")
    both = scorecard.union_gates(
        gates.ab_gate(with_policy.where("eval_engine = 'harbor'"), ID),
        gates.single_gate(with_policy.where("eval_engine = 'a2a'"), ID),
    )
    return rounded(both.select("scorecard_id", "policy_key", "passed", "score", "threshold"))


CASES = """cases AS (SELECT 'sub-' || o_custkey AS submission_name, o_orderkey AS case_id,
    CASE WHEN o_orderpriority <> '1-URGENT' THEN CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'B' ELSE 'tie' END END AS winner,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'timeout' END AS error FROM orders),
  o AS (SELECT submission_name, count(*) FILTER (WHERE error IS NULL AND winner = 'A') AS wins_a,
    count(*) FILTER (WHERE error IS NULL AND winner = 'B') AS wins_b, count(*) FILTER (WHERE error IS NULL AND winner = 'tie') AS ties,
    count(*) FILTER (WHERE error IS NOT NULL) AS errors, count(*) AS total FROM cases GROUP BY ALL)"""


def pairwise_cases(spark, sf):
    urgent, status = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderstatus")
    return rel.table(spark, sf, "orders").select(
        F.concat(F.lit("sub-"), "o_custkey").alias("submission_name"),
        F.col("o_orderkey").cast("string").alias("case_id"),
        F.when(~urgent, F.when(status == "F", "A").when(status == "O", "B").otherwise("tie")).alias("winner"),
        F.when(urgent, "timeout").alias("error"),
    )


@registry.add(
    "pairwise_outcome",
    f"""WITH {CASES} SELECT submission_name, wins_a, wins_b, ties, errors, total, (wins_a / total) AS win_rate,
        (wins_a + wins_b = 0 AND ties > 0 AND errors = 0) OR wins_a / total >= 0.5 AS passed FROM o""",
)
def pairwise_outcome(spark, sf):
    counts = pairwise.count_outcomes(pairwise_cases(spark, sf), ["submission_name"])
    return rounded(pairwise.pairwise_outcome(counts).drop("decisive", "all_ties", "recommendation"))


@registry.add(
    "pairwise_gate",
    f"""WITH {CASES}, t AS (SELECT *, CASE WHEN substr(submission_name, 5)::INT % 3 = 0 THEN 0.3 ELSE 0.5 END::DOUBLE AS threshold,
          CASE WHEN substr(submission_name, 5)::INT % 2 = 0 THEN 'block' ELSE 'warn' END AS mode FROM o)
        SELECT submission_name, 'engine' AS gate_type, 'evaluation' AS gate_name, 'harness' AS policy_key, mode, threshold, wins_a / total AS score,
        (wins_a + wins_b = 0 AND ties > 0 AND errors = 0) OR wins_a / total >= threshold AS passed FROM t""",
)
def pairwise_gate(spark, sf):
    number = F.substring("submission_name", 5, 20).cast("int")
    found = pairwise.pairwise_outcome(pairwise.count_outcomes(pairwise_cases(spark, sf), ["submission_name"])).select(
        "*", F.lit("harness").alias("eval_engine"), F.when(number % 2 == 0, "block").otherwise("warn").alias("mode"),
        F.when(number % 3 == 0, 0.3).alias("policy_threshold"),
    )
    rows = gates.pairwise_gate(found, ["submission_name"])
    return rounded(rows.select("submission_name", "gate_type", "gate_name", "policy_key", "mode", "threshold", "score", "passed"))


@registry.add(
    "pairwise_report",
    f"""WITH {CASES}, p AS (SELECT 'sub-' || c_custkey AS submission_name, 20 + c_custkey % 5 AS tn,
          CASE WHEN c_custkey % 3 <> 0 THEN c_custkey % 10 END AS cn, (c_custkey % 100) / 100.0 AS tm,
          CASE WHEN c_custkey % 3 <> 0 THEN 0.25 END AS cm FROM customer)
        SELECT submission_name, tn AS treatment_n_trials, wins_a AS treatment_n_passed, greatest(tn - wins_a, 0) AS treatment_n_failed,
          coalesce(cn, 0) AS control_n_trials, wins_b AS control_n_passed, greatest(coalesce(cn, 0) - wins_b, 0) AS control_n_failed,
          (wins_a / total) AS treatment_pass_rate, (wins_b / total) AS control_pass_rate,
          (wins_a / total - wins_b / total) + 0.0 AS uplift, tm::DOUBLE AS treatment_mean_reward, cm::DOUBLE AS control_mean_reward,
          (tm - coalesce(cm, 0.0))::DOUBLE AS mean_reward_gap,
          CASE WHEN (wins_a + wins_b = 0 AND ties > 0 AND errors = 0) OR wins_a / total >= 0.5 THEN 'pass' ELSE 'fail' END AS recommendation
        FROM o JOIN p USING (submission_name)""",
)
def pairwise_report(spark, sf):
    key = F.col("c_custkey")
    customers = rel.table(spark, sf, "customer")
    name = F.concat(F.lit("sub-"), key).alias("submission_name")
    treatment = customers.select(
        name, F.lit("treatment").alias("variant"), (20 + key % 5).alias("n_cases"), ((key % 100) / 100.0).alias("mean_reward")
    )
    control = customers.where(key % 3 != 0).select(
        name, F.lit("control").alias("variant"), (key % 10).alias("n_cases"), F.lit(0.25).alias("mean_reward")
    )
    counts = pairwise.count_outcomes(pairwise_cases(spark, sf), ["submission_name"])
    outcome = pairwise.pairwise_outcome(counts)
    return rounded(pairwise.pairwise_report(outcome, treatment.unionByName(control), ["submission_name"]))


@registry.add(
    "pairwise_findings",
    f"""WITH {CASES} SELECT submission_name, case_id::VARCHAR AS location,
        CASE WHEN error IS NOT NULL THEN 'high' ELSE 'medium' END AS severity,
        CASE WHEN error IS NOT NULL THEN 'aeh-pairwise-error' ELSE 'aeh-control-wins' END AS rule_id
        FROM cases WHERE error IS NOT NULL OR winner = 'B'""",
)
def pairwise_findings(spark, sf):
    return pairwise.pairwise_findings(pairwise_cases(spark, sf), ["submission_name"]).drop("message")


FACTS = """facts AS (SELECT o_orderkey AS k, 'sub-' || o_custkey AS submission_name, o_custkey AS c,
    CASE o_orderkey % 6 WHEN 0 THEN 'skill' WHEN 1 THEN 'mcp_server' WHEN 2 THEN 'plugin' WHEN 3 THEN 'agent' WHEN 4 THEN 'full' END AS profile,
    o_orderkey % 8 <> 0 AS valid, o_orderkey % 9 <> 0 AS meta, o_orderkey % 7 <> 0 AS assets,
    o_orderkey % 10 > 1 AS op, CASE WHEN o_orderkey % 10 <> 0 THEN 1.0 - (o_orderkey % 3) * 0.15 ELSE 0.0 END AS op_score,
    CASE WHEN o_orderkey % 4 <> 0 THEN (o_orderkey % 50) / 100.0 END AS std,
    CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 6 >= 3 THEN (o_orderkey % 20) / 100.0 END AS var,
    CASE WHEN o_orderkey % 5 = 0 THEN (o_orderkey % 100) / 100.0 END AS fm, CASE WHEN o_orderkey % 15 = 0 THEN 0.3 ELSE 0.5 END AS fmt
  FROM orders),
  edge AS (SELECT scorecard_id AS k, first(edge_total ORDER BY gate_order) AS et, first(edge_passed ORDER BY gate_order) AS ep
    FROM gates WHERE gate_type = 'behavioral' AND edge_total IS NOT NULL GROUP BY ALL),
  sub AS (SELECT k, 'consistency' AS sub_check, std IS NOT NULL AS has_data, std <= 0.3 AS ok,
            greatest(0.0, least(1.0, 1.0 - 0.5 * (std / 0.3))) AS s, 0.3 AS w FROM facts
    UNION ALL SELECT k, 'edge_case', coalesce(et, 0) > 0, ep / et >= 0.5, ep / et, 0.3 FROM facts LEFT JOIN edge USING (k)
    UNION ALL SELECT k, 'stability', var IS NOT NULL, var <= 0.1, greatest(0.0, least(1.0, 1.0 - 0.5 * (var / 0.1))), 0.2 FROM facts
    UNION ALL SELECT k, 'failure_mode', fm IS NOT NULL, fm >= fmt, fm, 0.2 FROM facts)"""


def certification_facts(spark, sf):
    runs = rel.certification_runs(spark, sf)
    inputs = certify.behavioral_inputs(runs.drop("score_variance", "stability_runs"), rel.gate_rows(spark, sf), ID)
    return inputs.drop("score_variance", "stability_runs").join(
        runs.select("scorecard_id", "score_variance", "stability_runs"), "scorecard_id"
    )


@registry.add(
    "behavior_sub_checks",
    f"""WITH {GATES}, {FACTS} SELECT k AS scorecard_id, sub_check, has_data,
        CASE WHEN has_data THEN ok ELSE true END AS passed, (CASE WHEN has_data THEN s ELSE 1.0 END) + 0.0 AS score FROM sub""",
)
def behavior_sub_checks(spark, sf):
    return rounded(certify.sub_check_rows(certification_facts(spark, sf), ID))


@registry.add(
    "behavior_composite",
    f"""WITH {GATES}, {FACTS} SELECT k AS scorecard_id, count(*) FILTER (WHERE has_data)::INT AS behavior_active,
        (coalesce(sum(s * w) FILTER (WHERE has_data) / sum(w) FILTER (WHERE has_data), 0.0)) + 0.0 AS behavior_score,
        count(*) FILTER (WHERE has_data) >= 2 AND count(*) FILTER (WHERE has_data AND NOT ok) = 0 AS behavior_passed
        FROM sub GROUP BY ALL""",
)
def behavior_composite(spark, sf):
    df = certify.behavior_composite(certification_facts(spark, sf))
    return rounded(df.select("scorecard_id", "behavior_active", "behavior_score", "behavior_passed"))


def sql_list(names):
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


def required_sql(level):
    whens = " ".join(f"WHEN profile = '{p}' THEN {sql_list(x[level])}" for p, x in certify.PROFILES.items())
    return f"CASE {whens} ELSE {sql_list(certify.DEFAULT_CHECKS[level])} END"


CHECKS = f"""own AS (SELECT DISTINCT c_custkey AS c, CASE WHEN c_custkey % 20 = 0 THEN ['basic_security_validation', 'data_privacy_pii_handling']
       ELSE ['basic_security_validation'] END AS f, CASE WHEN c_custkey % 30 = 0 THEN []::VARCHAR[] END AS z,
       CASE WHEN c_custkey % 20 = 0 THEN 0.9 ELSE 0.2 END AS ti, 0.4 AS ta FROM customer WHERE c_mktsegment = 'BUILDING'),
  pol AS (SELECT facts.*, coalesce(ti, 0.7) AS t_instr, coalesce(ta, 0.8) AS t_agent,
    CASE WHEN own.c IS NOT NULL THEN f ELSE {required_sql('foundational')} END AS rf,
    CASE WHEN own.c IS NOT NULL THEN {sql_list(certify.TRUSTED_CHECKS)} ELSE {required_sql('trusted')} END AS rt,
    CASE WHEN own.c IS NOT NULL THEN coalesce(z, {sql_list(certify.CERTIFIED_CHECKS)}) ELSE {required_sql('certified')} END AS rc
    FROM facts LEFT JOIN own ON own.c = facts.c),
  fan AS (
    SELECT k, gate_order, x.check_id, x.ok, x.s FROM gates g JOIN pol ON k = scorecard_id, LATERAL (
      SELECT 'basic_execution_validation' AS check_id, passed AS ok, score AS s WHERE gate_type = 'engine'
      UNION ALL SELECT 'functional_validation', passed, score WHERE gate_type = 'engine'
      UNION ALL SELECT 'advanced_agent_validation', score >= t_agent, score WHERE gate_type = 'engine'
      UNION ALL SELECT 'basic_security_validation', passed, score WHERE gate_type = 'security'
      UNION ALL SELECT 'advanced_security_validation', passed AND score >= 0.9, score WHERE gate_type = 'security'
      UNION ALL SELECT 'enterprise_security_review', passed AND score >= 0.9 AND findings_count = 0, greatest(0.0, 1 - findings_count * 0.1)
        WHERE gate_type = 'security'
      UNION ALL SELECT 'content_quality_review', passed, score WHERE gate_type = 'quality'
      UNION ALL SELECT 'instruction_quality', score >= t_instr, score WHERE gate_type = 'quality') x),
  beh AS (SELECT k, coalesce(sum(s * w) FILTER (WHERE has_data) / sum(w) FILTER (WHERE has_data), 0.0) AS s,
    count(*) FILTER (WHERE has_data) >= 2 AND count(*) FILTER (WHERE has_data AND NOT ok) = 0 AS ok FROM sub GROUP BY ALL),
  checks AS (
    SELECT k, check_id, ok, s FROM fan QUALIFY row_number() OVER (PARTITION BY k, check_id ORDER BY ok, gate_order) = 1
    UNION ALL SELECT k, unnest(['valid_skill_structure', 'enterprise_structure_validation']), valid, valid::INT::DOUBLE FROM facts
    UNION ALL SELECT k, 'metadata_compliance', meta, meta::INT::DOUBLE FROM facts
    UNION ALL SELECT k, 'evaluation_assets', assets, assets::INT::DOUBLE FROM facts
    UNION ALL SELECT k, 'operational_policy_compliance', op, op_score FROM facts
    UNION ALL SELECT k, 'enterprise_behavioral_testing', ok, s FROM beh
    UNION ALL SELECT k, unnest(['registry_governance', 'continuous_optimization']), false, 0.0 FROM facts),
  req AS (SELECT k, 'foundational' AS level, 0 AS lr, unnest(rf) AS check_id FROM pol UNION ALL
    SELECT k, 'trusted', 1, unnest(rt) FROM pol UNION ALL SELECT k, 'certified', 2, unnest(rc) FROM pol),
  grid AS (SELECT k, unnest(['foundational', 'trusted', 'certified']) AS level, unnest([0, 1, 2]) AS lr FROM facts),
  lev AS (SELECT grid.k, grid.level, grid.lr, count(req.check_id)::INT AS checks_total,
    count(*) FILTER (WHERE checks.ok)::INT AS checks_passed,
    CASE WHEN count(req.check_id) = 0 THEN 0.0 ELSE sum(coalesce(s, 0.0)) / count(req.check_id) END AS overall_score,
    string_agg(req.check_id, ',' ORDER BY req.check_id) FILTER (WHERE req.check_id IS NOT NULL AND NOT coalesce(ok, false)) AS failed
    FROM grid LEFT JOIN req ON req.k = grid.k AND req.level = grid.level
    LEFT JOIN checks ON checks.k = req.k AND checks.check_id = req.check_id GROUP BY ALL),
  hier AS (SELECT *, bool_and(checks_total > 0 AND checks_passed = checks_total) OVER (PARTITION BY k ORDER BY lr) AS passed FROM lev)"""


def certified_runs(spark, sf):
    runs = certify.resolve_policy(
        certification_facts(spark, sf), rel.certification_policies(spark, sf, "BUILDING"), F.col("profile")
    )
    return certify.certify(runs, rel.gate_rows(spark, sf), ID)


@registry.add(
    "certification_levels",
    f"""WITH {GATES}, {FACTS}, {CHECKS} SELECT k AS scorecard_id, level, passed, checks_total, checks_passed,
        checks_total - checks_passed AS checks_failed, (overall_score) + 0.0 AS overall_score, failed AS failed_checks FROM hier""",
)
def certification_levels(spark, sf):
    df = certify.certification_rows(certified_runs(spark, sf), ID)
    return rounded(
        df.withColumn("failed_checks", F.array_join(F.array_sort("failed_checks"), ",")).drop("level_rank")
    )


@registry.add(
    "certification_checks",
    f"""WITH {GATES}, {FACTS}, {CHECKS} SELECT k AS scorecard_id, check_id, ok AS passed, (s) + 0.0 AS score FROM checks""",
)
def certification_checks(spark, sf):
    return rounded(certify.check_rows(certified_runs(spark, sf), ID).drop("source_gate"))


@registry.add(
    "highest_certification",
    f"""WITH {GATES}, {FACTS}, {CHECKS}, h AS (SELECT k, max(CASE WHEN passed THEN lr ELSE -1 END) AS top FROM hier GROUP BY ALL)
        SELECT CASE top WHEN 2 THEN 'certified' WHEN 1 THEN 'trusted' WHEN 0 THEN 'foundational' ELSE 'none' END AS highest_level,
        count(*) AS n FROM h GROUP BY ALL""",
)
def highest_certification(spark, sf):
    return certified_runs(spark, sf).groupBy("highest_level").agg(F.count(F.lit(1)).alias("n"))


@registry.add(
    "certification_policy_errors",
    """SELECT 'sub-' || c_custkey AS submission_name, 'no_such_check' AS invalid_ids, c_custkey % 20 = 0 AS threshold_out_of_range
       FROM customer""",
)
def certification_policy_errors(spark, sf):
    own = rel.certification_policies(spark, sf)
    worse = own.withColumn("trusted_checks", F.array(F.lit("no_such_check"), F.lit("functional_validation"))).withColumn(
        "trusted_thresholds", F.transform_values("trusted_thresholds", lambda _, v: v + 1.0)
    )
    df = certify.invalid_check_ids(worse)
    return df.withColumn("invalid_ids", F.array_join("invalid_ids", ",")).withColumn(
        "threshold_out_of_range", F.coalesce("threshold_out_of_range", F.lit(False))
    )


@registry.add(
    "dimension_scores",
    f"""WITH {REVIEWS} SELECT k AS scorecard_id, (clarity)::DOUBLE AS clarity, (safety)::DOUBLE AS safety FROM revs WHERE state = 'ok'""",
)
def dimension_scores(spark, sf):
    docs = gates.parse_artifact(rel.review_documents(spark, sf), "artifact_text").where("artifact_state = 'ok'")
    scores = docs.select("scorecard_id", gates.dimension_scores(F.col("doc")).alias("s"))
    return rounded(scores.select("scorecard_id", F.col("s")["clarity"].alias("clarity"), F.col("s")["safety"].alias("safety")))


@registry.add(
    "scorecard_table",
    f"""WITH {ITEMS}, {CARDS}, {GATES}, {JUDGED}, {FACTS}, {CHECKS},
        top AS (SELECT k, max(CASE WHEN passed THEN lr ELSE -1 END) AS t FROM hier GROUP BY ALL),
        n AS (SELECT c.scorecard_id, count(*) FILTER (WHERE passed) AS gates_passed, count(*) FILTER (WHERE NOT passed) AS gates_failed
          FROM cards c LEFT JOIN judged j USING (scorecard_id) GROUP BY ALL)
        SELECT scorecard_id, gates_passed, gates_failed,
          CASE t WHEN 2 THEN 'certified' WHEN 1 THEN 'trusted' WHEN 0 THEN 'foundational' ELSE 'none' END AS highest_certification
        FROM n JOIN top ON k = scorecard_id""",
)
def scorecard_table(spark, sf):
    combined = scorecard.combine(judged_gates(spark, sf), ID, rel.scorecards(spark, sf))
    rows = tables.scorecard_rows(combined, certified_runs(spark, sf), ID)
    return rows.select("scorecard_id", "gates_passed", "gates_failed", "highest_certification")


@registry.add(
    "gate_ranks",
    f"""WITH {GATES} SELECT gate_type, CASE gate_type WHEN 'engine' THEN 0 WHEN 'security' THEN 1 WHEN 'quality' THEN 2 ELSE 3 END AS gate_rank,
        count(*) AS n FROM gates GROUP BY ALL""",
)
def gate_ranks(spark, sf):
    ranked = rel.gate_rows(spark, sf).withColumn("gate_rank", scorecard.gate_rank(F.col("gate_type")))
    return ranked.groupBy("gate_type", "gate_rank").agg(F.count(F.lit(1)).alias("n"))


@registry.add(
    "judge_summaries",
    """SELECT o_orderkey AS scorecard_id, 'a=' || (o_orderkey % 101) || '%, b=' || format('{:.2f}', (o_orderkey % 40) / 10.0) AS summary FROM orders""",
)
def judge_summaries(spark, sf):
    k = F.col("o_orderkey")
    doc = F.concat(
        F.lit('{"a":{"pass_rate":'), F.format_string("%.2f", (k % 101) / 100.0), F.lit('},"b":{"mean":'),
        F.format_string("%.1f", (k % 40) / 10.0), F.lit('},"c":{"note":"x"}}'),
    )
    return rel.table(spark, sf, "orders").select(
        k.alias("scorecard_id"), harness.judge_summary(F.parse_json(doc)).alias("summary")
    )
