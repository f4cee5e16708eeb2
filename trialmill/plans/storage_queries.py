"""Queries on result files and stored tables. File contents are derived from the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from trialmill.functions import scalars
from trialmill.operators import facts, gates
from trialmill.plans import gate_queries
from trialmill.plans import relations as rel
from trialmill.plans.registry import Registry, rounded
from trialmill.plans.run_queries import PAIRED_COUNTS, PAIRED_RATES, RUNS, r6
from trialmill.sinks import tables
from trialmill.sources import files as src

registry = Registry()
INT_COUNTS = ", ".join(f"{c}::INT AS {c}" for c in PAIRED_COUNTS.split(", "))


def result_files(spark, sf):
    """One result file per event: nested, flat, corrupt, job-level and wrongly typed documents."""
    k = F.col("event_id")
    amount = F.format_string("%.2f", (k % 100) / 100.0)
    body = (
        F.when(k % 9 == 0, "{ broken").when(k % 9 == 1, '{"job":1}').when(k % 9 == 2, '{"verifier_result":"text"}')
        .when(k % 9 == 3, '{"verifier_result":{"rewards":{"reward":"x"}}}')
        .when(k % 9 < 6, F.concat(F.lit('{"verifier_result":{"rewards":{"reward":'), amount, F.lit('},"reward":9}}')))
        .otherwise(F.concat(F.lit('{"verifier_result":{"reward":'), amount, F.lit("}}")))
    )
    user = F.col("user_id")
    folder = F.when(user % 4 == 0, "a2a-eval").when(k % 3 == 0, "treatment").when(k % 3 == 1, "control").otherwise("a2a-eval")
    return rel.table(spark, sf, "events").select(
        F.concat(F.lit("r"), user, F.lit("/"), folder, F.lit("/job/t"), k, F.lit("/result.json")).alias("path"),
        F.col("ts").alias("modified"),
        body.alias("content"),
    )


@registry.add(
    "trial_files",
    """WITH f AS (SELECT user_id, event_id AS k, user_id % 4 = 0 AS single, CASE WHEN user_id % 4 = 0 THEN 'treatment' WHEN event_id % 3 = 0 THEN 'treatment'
          WHEN event_id % 3 = 1 THEN 'control' END AS variant, value FROM events)
       SELECT 'r' || user_id AS pipeline_run_id, 't' || k AS trial_name, variant, single AS single_variant,
         CASE WHEN k % 9 >= 4 THEN (k % 100) / 100 END AS reward FROM f WHERE variant IS NOT NULL AND k % 9 <> 1""",
)
def trial_files(spark, sf):
    df = src.trial_rows(result_files(spark, sf))
    return rounded(df.select("pipeline_run_id", "trial_name", "variant", "single_variant", "reward"))


@registry.add(
    "grading_files",
    """SELECT 'r' || user_id AS pipeline_run_id, CASE event_id % 3 WHEN 0 THEN 'treatment' ELSE 'control' END AS variant,
         'iteration-' || (event_id % 5 + 1) || '-' || CASE event_id % 3 WHEN 0 THEN 'treatment' ELSE 'control' END AS trial_name,
         CASE WHEN event_id % 7 = 0 THEN 0.0 ELSE (event_id % 100) / 100 END AS reward
       FROM events WHERE event_id % 3 < 2 AND event_id % 5 + 1 <= 3""",
)
def grading_files(spark, sf):
    k = F.col("event_id")
    part = F.when(k % 3 == 0, "with_skill").when(k % 3 == 1, "without_skill").otherwise("other")
    body = F.when(k % 7 == 0, '{"summary":{}}').otherwise(
        F.concat(F.lit('{"summary":{"pass_rate":'), F.format_string("%.2f", (k % 100) / 100.0), F.lit("}}"))
    )
    files = rel.table(spark, sf, "events").select(
        F.concat(F.lit("r"), "user_id", F.lit("/iteration-"), k % 5 + 1, F.lit("/e"), k, F.lit("/"), part, F.lit("/grading.json")).alias("path"),
        body.alias("content"),
    )
    return rounded(src.grading_rows(files, 3))


@registry.add(
    "benchmark_files",
    """WITH f AS (SELECT o_custkey, o_orderkey, o_orderkey % 4 = 0 AND o_custkey % 2 = 0 AS own FROM orders),
        a AS (SELECT o_custkey, bool_or(own) AS any_own FROM f GROUP BY ALL)
       SELECT 'r' || o_custkey AS pipeline_run_id, count(*) FILTER (WHERE own OR NOT any_own) AS n FROM f JOIN a USING (o_custkey)
       GROUP BY ALL HAVING count(*) FILTER (WHERE own OR NOT any_own) > 0""",
)
def benchmark_files(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    folder = F.when((k % 4 == 0) & (c % 2 == 0), "iteration-2").otherwise("deep/iteration-9")
    files = rel.table(spark, sf, "orders").select(
        F.concat(F.lit("r"), c, F.lit("/"), folder, F.lit("/benchmark.json")).alias("path"), F.lit("{}").alias("content")
    )
    return src.benchmark_rows(files, 3).groupBy("pipeline_run_id").agg(F.count(F.lit(1)).alias("n"))


@registry.add(
    "preferred_run_document",
    """WITH f AS (SELECT o_custkey AS c, o_orderkey AS k, CASE o_orderkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS rank, o_orderkey % 10 = 0 AS bad FROM orders)
       SELECT 's' || c AS submission_name, CASE rank WHEN 2 THEN 'run' || k ELSE '' END AS run_dir FROM f WHERE NOT bad
       QUALIFY row_number() OVER (PARTITION BY c ORDER BY rank, CASE rank WHEN 2 THEN 'run' || k ELSE '' END DESC) = 1""",
)
def preferred_run_document(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    rest = F.when(k % 5 == 0, "report.json").when(k % 5 == 1, "summary.json").otherwise(F.concat(F.lit("run"), k, F.lit("/summary.json")))
    files = rel.table(spark, sf, "orders").select(
        F.concat(F.lit("s"), c, F.lit("/"), rest).alias("path"), F.when(k % 10 == 0, "{bad").otherwise("{}").alias("content")
    )
    return src.preferred_run_document(files).select("submission_name", "run_dir")


def checkpoint_files(spark, sf):
    """One metrics checkpoint per order; every tenth cannot be read, every third has no model call."""
    k = F.col("o_orderkey")
    calls = F.when(k % 3 == 0, F.lit("{}")).otherwise(F.concat(
        F.lit('{"review":{"prompt_tokens":'), k, F.lit(',"completion_tokens":'), k % 7, F.lit(',"model_name":"m'), k % 2, F.lit('"},"scan":{}}')
    ))
    text = F.concat(F.lit('{"token_usage":'), calls, F.lit(',"timings":{"scan":{"start_time":1.5,"end_time":'), k, F.lit("},\"review\":{}}}"))
    return rel.table(spark, sf, "orders").select(
        F.concat(F.lit("r"), k, F.lit("/"), F.when(k % 11 == 0, "other.json").otherwise("_metrics_checkpoint.json")).alias("path"),
        F.when(k % 10 == 0, "{bad").otherwise(text).alias("content"),
    )


@registry.add(
    "checkpoint_calls",
    """WITH k AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 10 <> 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 3 <> 0)
       SELECT 'r' || k AS pipeline_run_id, 'review' AS phase, k AS prompt_tokens, (k % 7)::BIGINT AS completion_tokens, 'm' || (k % 2) AS model FROM k
       UNION ALL SELECT 'r' || k, 'scan', 0, 0, NULL FROM k""",
)
def checkpoint_calls(spark, sf):
    return src.metrics_checkpoints(checkpoint_files(spark, sf))[0]


@registry.add(
    "checkpoint_timings",
    """WITH k AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 10 <> 0 AND o_orderkey % 11 <> 0)
       SELECT 'r' || k AS pipeline_run_id, 'scan' AS phase, 1.5::DOUBLE AS start_time, k::DOUBLE AS end_time FROM k
       UNION ALL SELECT 'r' || k, 'review', NULL, NULL FROM k""",
)
def checkpoint_timings(spark, sf):
    return src.metrics_checkpoints(checkpoint_files(spark, sf))[1]


@registry.add(
    "readable_reports",
    """SELECT 'r' || o_orderkey AS pipeline_run_id, o_orderstatus, o_orderkey * 2 AS uplift FROM orders WHERE o_orderkey % 10 <> 0 AND o_orderkey % 7 <> 0""",
)
def readable_reports(spark, sf):
    k = F.col("o_orderkey")
    orders = rel.table(spark, sf, "orders")
    files = orders.where(k % 7 != 0).select(
        F.concat(F.lit("r"), k, F.lit("/report.json")).alias("path"),
        F.when(k % 10 == 0, "not json").otherwise(F.concat(F.lit('{"uplift":'), k * 2, F.lit("}"))).alias("content"),
    )
    runs = orders.select(F.concat(F.lit("r"), k).alias("pipeline_run_id"), "o_orderstatus")
    found = src.readable_reports(runs, src.documents(files, "report.json"))
    return found.select("pipeline_run_id", "o_orderstatus", F.try_variant_get("doc", "$.uplift", "bigint").alias("uplift"))


@registry.add(
    "run_dirs",
    """SELECT DISTINCT 'runs/c' || o_custkey || '/i' || (o_orderkey % 3) AS run_dir FROM orders WHERE o_orderkey % 5 < 3""",
)
def run_dirs(spark, sf):
    k = F.col("o_orderkey")
    name = F.when(k % 5 == 0, "summary.yaml").when(k % 5 < 3, "summary.json").otherwise("notes.txt")
    path = F.concat(F.when(k % 2 == 0, "./").otherwise(""), F.lit("runs/c"), "o_custkey", F.when(k % 4 == 1, "//").otherwise("/"), F.lit("i"), k % 3, F.lit("/"), name)
    return src.run_dirs(rel.table(spark, sf, "orders").select(path.alias("path")))


def job_manifest(spark, sf):
    k = F.col("event_id")
    return rel.table(spark, sf, "events").select(
        F.concat(
            F.lit("s"), "user_id", F.when(k % 2 == 0, "/treatment/job").otherwise("/control/job"), F.floor(k / 1000), F.lit("/t"), k,
            F.when(k % 3 == 0, "/verifier/x.log").when(k % 3 == 1, "/result.json").otherwise("/notes.txt"),
        ).alias("path"),
        F.col("ts").alias("modified"),
    )


@registry.add(
    "newest_job_trials",
    """WITH f AS (SELECT 's' || user_id AS submission_name, CASE WHEN event_id % 2 = 0 THEN 'treatment' ELSE 'control' END AS variant,
          'job' || (event_id // 1000) AS job, 't' || event_id AS trial_dir, event_id % 3 AS w, ts FROM events),
        n AS (SELECT submission_name, variant, arg_max(job, ts) AS job FROM f GROUP BY ALL)
       SELECT submission_name, variant, job, count(*) AS n FROM f JOIN n USING (submission_name, variant, job) WHERE w < 2 GROUP BY ALL""",
)
def newest_job_trials(spark, sf):
    dirs = src.trial_dirs(job_manifest(spark, sf))
    return dirs.groupBy("submission_name", "variant", "job").agg(F.count(F.lit(1)).alias("n"))


@registry.add(
    "materialised_cases",
    """SELECT 's' || user_id AS submission_name, count(DISTINCT 'c' || (event_id % 40)) AS n_cases FROM events GROUP BY ALL""",
)
def materialised_cases(spark, sf):
    case = scalars.case_of_trial(F.concat(F.lit("c"), F.col("event_id") % 40, F.lit("__"), "event_id"))
    return rel.table(spark, sf, "events").groupBy(F.concat(F.lit("s"), "user_id").alias("submission_name")).agg(
        F.countDistinct(case).alias("n_cases")
    )


@registry.add(
    "stored_reports",
    f"""WITH {RUNS} SELECT submission_name, pipeline_run_id, eval_engine, {INT_COUNTS}, {r6(PAIRED_RATES)},
        {r6('uplift mean_reward_gap')}, recommendation FROM runs""",
)
def stored_reports(spark, sf):
    docs = tables.report_documents(rel.runs(spark, sf), ["pipeline_run_id"])
    parsed = docs.select("pipeline_run_id", F.col("document").alias("artifact_text"), F.try_parse_json("document").alias("doc"))
    names = ["submission_name", "pipeline_run_id", "eval_engine", *[c.strip() for c in PAIRED_COUNTS.split(",")],
             *PAIRED_RATES.split(), "uplift", "mean_reward_gap", "recommendation"]
    return rounded(tables.report_runs(parsed).select(*names))


@registry.add(
    "stored_trials",
    """WITH t AS (SELECT o_orderkey AS k, v, i FROM orders, (VALUES ('treatment'), ('control')) x(v), range(3) r(i))
       SELECT 'r' || k AS pipeline_run_id, v AS variant, i::INT AS trial_no, 't' || i AS trial_name,
         CASE WHEN i = 2 THEN NULL ELSE (k + i) % 3 / 4.0 END AS reward, coalesce(i < 2 AND (k + i) % 3 > 0, false) AS passed FROM t""",
)
def stored_trials(spark, sf):
    k = F.col("o_orderkey")

    def trial(i):
        reward = F.lit("null") if i == 2 else ((k + i) % 3 / 4.0).cast("string")
        return F.concat(F.lit(f'{{"trial_name":"t{i}","passed":true,"reward":'), reward, F.lit("}"))

    listed = F.concat(F.lit("["), F.concat_ws(",", *[trial(i) for i in range(3)]), F.lit("]"))
    text = F.concat(F.lit('{"trials":{"treatment":'), listed, F.lit(',"control":'), listed, F.lit("}}"))
    docs = rel.table(spark, sf, "orders").select(
        F.concat(F.lit("r"), k).alias("pipeline_run_id"), text.alias("artifact_text"), F.try_parse_json(text).alias("doc")
    )
    return tables.report_trials(docs)


@registry.add(
    "stored_scans",
    f"""WITH {gate_queries.FINDINGS} SELECT scorecard_id::VARCHAR AS pipeline_run_id, mode AS scan_mode, mode <> 'block' OR serious = 0 AS passed,
          n::INT AS findings_count, (SELECT count(*) FROM raw WHERE raw.scorecard_id = arts.scorecard_id AND severity = 'critical')::INT AS critical_count
        FROM arts WHERE state = 'ok'""",
)
def stored_scans(spark, sf):
    docs = gates.parse_artifact(rel.scan_documents(spark, sf), "artifact_text").where("artifact_state = 'ok'")
    scans = docs.select(
        F.col("scorecard_id").cast("string").alias("pipeline_run_id"), F.lit("s").alias("submission_name"), F.lit("cisco").alias("scanner"),
        F.col("mode").alias("scan_mode"), "doc",
    )
    return tables.scan_rows(scans).select("pipeline_run_id", "scan_mode", "passed", "findings_count", "critical_count")


@registry.add(
    "new_runs_only",
    """SELECT count(*) AS n, sum(l_orderkey)::BIGINT AS keys FROM (SELECT DISTINCT l_orderkey FROM lineitem
       WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'))""",
)
def new_runs_only(spark, sf):
    incoming = rel.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("pipeline_run_id"))
    stored = rel.table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("pipeline_run_id"))
    fresh = tables.new_rows(incoming, stored, ["pipeline_run_id"])
    return fresh.agg(F.count(F.lit(1)).alias("n"), F.sum("pipeline_run_id").alias("keys"))


@registry.add(
    "scan_upsert",
    """WITH e AS (SELECT user_id, event_type, event_id, floor(value)::BIGINT AS v, ts FROM events)
       SELECT user_id AS pipeline_run_id, event_type AS scanner, arg_max(v, event_id) AS findings_count,
         arg_max(v % 7, event_id) AS critical_count, arg_max(v % 5, event_id) AS high_count, arg_max(v % 2 = 0, event_id) AS passed,
         'm' || min(event_id) AS scan_mode FROM e GROUP BY ALL""",
)
def scan_upsert(spark, sf):
    v = F.floor("value").cast("bigint")
    rows = rel.table(spark, sf, "events").select(
        F.col("user_id").alias("pipeline_run_id"), F.col("event_type").alias("scanner"), F.concat(F.lit("m"), "event_id").alias("scan_mode"),
        (v % 2 == 0).alias("passed"), v.alias("findings_count"), (v % 7).alias("critical_count"), (v % 5).alias("high_count"),
        F.col("event_id").alias("seq"),
    )
    return tables.upsert_scans(rows.where("seq % 2 = 0"), rows.where("seq % 2 = 1")).drop("seq")


@registry.add(
    "content_run_keys",
    "SELECT doc_id, 'content-' || sha256(text)[1:16] AS pipeline_run_id FROM documents",
)
def content_run_keys(spark, sf):
    key = tables.run_key(F.lit(None).cast("string"), F.col("text"))
    return rel.table(spark, sf, "documents").select("doc_id", key.alias("pipeline_run_id"))


def scorecard_listing(spark, sf):
    k = F.col("o_orderkey")
    return rel.table(spark, sf, "orders").select(
        F.concat(F.lit("reports/r"), F.lpad(k.cast("string"), 12, "0"), F.lit("/scorecard.json")).alias("path"),
        F.when(k % 50 == 0, "{no").otherwise(F.concat(F.lit('{"pipeline_run_id":"r'), k, F.lit('"}'))).alias("content"),
    )


STORED = "SELECT DISTINCT l_orderkey FROM lineitem WHERE l_linenumber = 1"


@registry.add(
    "backfill_counts",
    f"""SELECT CASE WHEN o_orderkey % 50 = 0 THEN 'error' WHEN o_orderkey IN ({STORED}) THEN 'skipped' ELSE 'processed' END AS outcome, count(*) AS n
       FROM orders GROUP BY ALL""",
)
def backfill_counts(spark, sf):
    return tables.backfill_counts(backfill(spark, sf))


def backfill(spark, sf):
    stored = rel.table(spark, sf, "lineitem").where("l_linenumber = 1").select(F.concat(F.lit("r"), "l_orderkey").alias("pipeline_run_id"))
    return tables.backfill_outcomes(scorecard_listing(spark, sf), stored)


@registry.add(
    "backfill_errors",
    """SELECT 'reports/r' || lpad(o_orderkey::VARCHAR, 12, '0') || '/scorecard.json' AS path FROM orders WHERE o_orderkey % 50 = 0""",
)
def backfill_errors(spark, sf):
    return tables.last_errors(backfill(spark, sf))


@registry.add(
    "resume_after_key",
    """SELECT 'reports/r' || lpad(o_orderkey::VARCHAR, 12, '0') || '/scorecard.json' AS path FROM orders
       WHERE 'reports/r' || lpad(o_orderkey::VARCHAR, 12, '0') || '/scorecard.json' > 'reports/r000000000777/scorecard.json'""",
)
def resume_after_key(spark, sf):
    return src.after_key(scorecard_listing(spark, sf), "reports/", "reports/r000000000777/scorecard.json").select("path")


@registry.add(
    "summary_rows",
    f"""WITH {RUNS} SELECT pipeline_run_id, upper(CASE WHEN treatment_n_trials % 2 = 0 THEN 'warn' ELSE recommendation END) AS recommendation FROM runs""",
)
def summary_rows(spark, sf):
    runs = rel.runs(spark, sf)
    cards = runs.where("treatment_n_trials % 2 = 0").select(
        "pipeline_run_id", F.lit("warn").alias("recommendation"), F.lit("r").alias("recommendation_reason"),
        F.lit(1).alias("gates_passed"), F.lit(0).alias("gates_failed"),
    )
    return facts.summary_rows(runs.select("pipeline_run_id", "recommendation"), cards, ["pipeline_run_id"]).select(
        "pipeline_run_id", "recommendation"
    )


@registry.add(
    "enriched_reports",
    """WITH s AS (SELECT l_orderkey AS k, sum(l_linenumber)::BIGINT AS f, bool_and(l_returnflag <> 'R') AS ok FROM lineitem GROUP BY ALL),
        e AS (SELECT l_orderkey AS k, count(*) AS t, count(*) FILTER (WHERE l_tax > 0.03) AS p FROM lineitem GROUP BY ALL)
       SELECT o_orderkey AS pipeline_run_id, f AS scan_findings, ok AS scans_passed, t AS edge_total, p AS edge_passed,
         CASE WHEN o_orderstatus = 'F' THEN true END AS degraded, 'pr-' || o_custkey AS related_pr FROM orders LEFT JOIN s ON s.k = o_orderkey LEFT JOIN e ON e.k = o_orderkey""",
)
def enriched_reports(spark, sf):
    lines, orders = rel.table(spark, sf, "lineitem"), rel.table(spark, sf, "orders")
    run = F.col("l_orderkey").alias("pipeline_run_id")
    scans = lines.select(run, F.col("l_linenumber").cast("bigint").alias("findings_count"), (F.col("l_returnflag") != "R").alias("passed"))
    edges = lines.select(run, (F.col("l_tax") > 0.03).alias("passed"))
    reports = orders.select(F.col("o_orderkey").alias("pipeline_run_id"))
    degraded = orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("pipeline_run_id"), F.lit(True).alias("degraded"))
    changes = orders.select(F.col("o_orderkey").alias("pipeline_run_id"), F.concat(F.lit("pr-"), "o_custkey").alias("related_pr"))
    return tables.enrich_reports(reports, scans, edges, degraded, changes)


@registry.add(
    "certification_documents",
    f"""WITH {gate_queries.GATES}, {gate_queries.FACTS}, {gate_queries.CHECKS},
        h AS (SELECT k, max(CASE WHEN passed THEN lr ELSE -1 END) AS top, max(CASE WHEN lr = 1 THEN checks_passed END) AS trusted_passed FROM hier GROUP BY ALL)
        SELECT k AS scorecard_id, CASE top WHEN 2 THEN 'certified' WHEN 1 THEN 'trusted' WHEN 0 THEN 'foundational' ELSE 'none' END AS highest_level,
          trusted_passed FROM h""",
)
def certification_documents(spark, sf):
    docs = tables.certification_documents(gate_queries.certified_runs(spark, sf), ["scorecard_id"])
    return docs.select(
        "scorecard_id", F.get_json_object("document", "$.highest_level").alias("highest_level"),
        F.get_json_object("document", "$.levels.trusted.checks_passed").cast("int").alias("trusted_passed"),
    )


@registry.add(
    "stored_gate_joins",
    f"""WITH {gate_queries.GATES}, {gate_queries.CARDS} SELECT combination, gate_type, count(*) AS n, count(DISTINCT scorecard_id) AS n_cards
        FROM cards JOIN gates USING (scorecard_id) GROUP BY ALL""",
)
def stored_gate_joins(spark, sf):
    joined = rel.scorecards(spark, sf).join(rel.gate_rows(spark, sf), "scorecard_id")
    return joined.groupBy("combination", "gate_type").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("scorecard_id").alias("n_cards")
    )
