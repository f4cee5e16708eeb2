"""Queries that write the partitioned history and read it back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialmill.operators import certify
from trialmill.plans import gate_queries
from trialmill.plans import relations as rel
from trialmill.plans.registry import Registry, rounded
from trialmill.session import shared_folder
from trialmill.sinks import tables
from trialmill.sinks.history import HistoryStore, merge_scans
from trialmill.sources.file_index import indexed_files

registry = Registry()
BUCKETS = 8


def store(spark) -> HistoryStore:
    return HistoryStore(spark, shared_folder(spark, "history"), buckets=BUCKETS)


def kept(rows: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder, for inputs that every table of a batch reads again."""
    folder = shared_folder(rows.sparkSession, name)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def run_trials(spark, sf) -> DataFrame:
    """An order with its line items as trials, per row."""
    reward = F.round(F.col("l_discount") * 10, 1)
    trial = F.struct(F.concat(F.lit("t"), "l_linenumber").alias("trial_name"), reward.alias("reward"))
    lines = rel.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(trial)).alias("treatment"), F.count(F.lit(1)).alias("n")
    )
    orders = rel.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return kept(orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).drop("l_orderkey"), "run-trials")


def run_reports(trials: DataFrame, word: str) -> DataFrame:
    """A report document per order: one treatment trial per line item."""
    doc = F.struct(
        F.concat(F.lit("sub-"), "o_custkey").alias("submission_name"),
        F.struct(F.lit("harbor").alias("eval_engine")).alias("provenance"),
        F.struct(F.lit(word).alias("recommendation"), F.struct(F.col("n").alias("n_trials")).alias("treatment")).alias("summary"),
        F.struct("treatment").alias("trials"),
    )
    rows = trials.select(F.concat(F.lit("r"), "o_orderkey").alias("pipeline_run_id"), F.to_json(doc).alias("artifact_text"), "o_orderstatus", "o_orderpriority")
    return rows.withColumn("doc", F.try_parse_json("artifact_text"))


def batch_of(reports: DataFrame) -> dict[str, DataFrame]:
    return {"evaluation_runs": tables.report_runs(reports), "trials": tables.report_trials(reports)}


@registry.add(
    "stored_history_runs",
    """WITH n AS (SELECT l_orderkey, count(*) AS n, sum(round(l_discount * 10, 1)) AS s FROM lineitem GROUP BY ALL)
       SELECT 'r' || o_orderkey AS pipeline_run_id, 'sub-' || o_custkey AS submission_name, 'harbor' AS eval_engine, n::INT AS treatment_n_trials,
         CASE WHEN o_orderstatus = 'F' THEN 'first' ELSE 'second' END AS recommendation, n AS n_trials, s AS reward_sum FROM orders JOIN n ON l_orderkey = o_orderkey""",
)
def stored_history_runs(spark, sf):
    """Finished orders first, twice with one batch id and once more without, then all orders with another verdict."""
    history = store(spark)
    rows = run_trials(spark, sf)
    first, second = run_reports(rows, "first"), run_reports(rows, "second")
    done = first.where("o_orderstatus = 'F'")
    for batch_id in ("day-1", "day-1", None):
        history.store(batch_of(done), batch_id)
    history.store(batch_of(second), "day-2")
    trials = history.read("trials").groupBy("pipeline_run_id").agg(F.count(F.lit(1)).alias("n_trials"), F.sum("reward").alias("reward_sum"))
    runs = history.read("evaluation_runs").join(trials, "pipeline_run_id", "left")
    return rounded(runs.select("pipeline_run_id", "submission_name", "eval_engine", "treatment_n_trials", "recommendation", "n_trials", "reward_sum"))


def scans_of(orders: DataFrame, scanner: str) -> DataFrame:
    return orders.select(
        "pipeline_run_id", F.lit("s").alias("submission_name"), F.lit(scanner).alias("scanner"), F.lit("warn").alias("scan_mode"),
        F.try_parse_json(F.concat(F.lit('{"findings":[{"severity":"HIGH","id":"'), F.substring("o_orderpriority", 1, 1), F.lit('"}]}'))).alias("doc"),
    )


@registry.add(
    "stored_scan_rows",
    """SELECT 'r' || o_orderkey AS pipeline_run_id, CASE WHEN o_orderpriority = '1-URGENT' THEN 'at once' ELSE 'with the run' END AS scanner,
         1 AS high_count FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""",
)
def stored_scan_rows(spark, sf):
    """Scans of urgent orders are stored by themselves before the runs come with scans of their own."""
    history = store(spark)
    reports = run_reports(run_trials(spark, sf), "x")
    history.store({"security_scans": tables.scan_rows(scans_of(reports.where("o_orderpriority = '1-URGENT'"), "at once"))})
    history.store(batch_of(reports) | {"security_scans": tables.scan_rows(scans_of(reports, "with the run"))})
    return history.read("security_scans").select("pipeline_run_id", "scanner", "high_count")


def gate_documents(spark, sf) -> DataFrame:
    """A scorecard document per order with its gate rows."""
    ordered = F.array_sort(F.collect_list(F.struct("gate_order", "gate_name", "gate_type", "passed", "score", "findings_count")))
    gate = lambda g: F.struct(
        g["gate_name"].alias("gate_name"), g["gate_type"].alias("gate_type"), F.when(g["gate_type"] == "security", "cisco").alias("policy_key"),
        g["passed"].alias("passed"), F.round(g["score"], 6).alias("score"), F.array_repeat(F.struct(F.lit("x").alias("rule_id")), g["findings_count"]).alias("findings"),
        F.when(g["passed"], F.struct(g["gate_type"].alias("kind"))).alias("details"),
    )
    cards = rel.gate_rows(spark, sf).groupBy("scorecard_id").agg(F.transform(ordered, gate).alias("gates"))
    text = F.to_json(F.struct(F.lit("sub").alias("submission_name"), F.struct(F.lit("all_pass").alias("combination")).alias("policy"), "gates"))
    rows = kept(cards.select(F.concat(F.lit("r"), "scorecard_id").alias("pipeline_run_id"), text.alias("artifact_text")), "gate-documents")
    return rows.withColumn("doc", F.try_parse_json("artifact_text"))


@registry.add(
    "stored_gate_results",
    f"""WITH {gate_queries.GATES} SELECT 'r' || scorecard_id AS pipeline_run_id, (row_number() OVER (PARTITION BY scorecard_id ORDER BY gate_order) - 1)::INT AS gate_no,
          gate_name, gate_type, CASE gate_type WHEN 'security' THEN 'cisco' ELSE gate_name END AS policy_key, passed, round(score, 6)::DOUBLE AS score, 'warn' AS mode,
          findings_count::INT AS findings_count, CASE WHEN passed THEN '{{"kind":"' || gate_type || '"}}' END AS details_json, 'all_pass' AS combination_mode FROM gates""",
)
def stored_gate_results(spark, sf):
    """Scorecards with their gates are stored with their runs and read back."""
    history, cards = store(spark), gate_documents(spark, sf)
    runs = cards.select("pipeline_run_id", F.lit("sub").alias("submission_name"))
    history.store({"evaluation_runs": runs, "scorecards": tables.scorecard_document_rows(cards), "gate_results": tables.gate_result_rows(cards)})
    gates = history.read("gate_results").join(history.read("scorecards").select("pipeline_run_id", "combination_mode"), "pipeline_run_id")
    names = ["pipeline_run_id", "gate_no", "gate_name", "gate_type", "policy_key", "passed", "score", "mode", "findings_count", "details_json", "combination_mode"]
    return rounded(gates.select(*names))


@registry.add(
    "stored_certifications",
    f"""WITH {gate_queries.GATES}, {gate_queries.FACTS}, {gate_queries.CHECKS} SELECT 'r' || k AS pipeline_run_id, level, passed, checks_total, checks_passed,
        checks_total - checks_passed AS checks_failed, failed AS failed_checks FROM hier""",
)
def stored_certifications(spark, sf):
    """Three rows per certified run, stored with it."""
    run = F.concat(F.lit("r"), "scorecard_id").alias("pipeline_run_id")
    rows = certify.certification_rows(gate_queries.certified_runs(spark, sf), ["scorecard_id"])
    history = store(spark)
    runs = rel.scorecards(spark, sf).select(run, "submission_name")
    history.store({"evaluation_runs": runs, "certifications": rows.select(run, *[c for c in rows.columns if c != "scorecard_id"])})
    return history.read("certifications").select("pipeline_run_id", "level", "passed", "checks_total", "checks_passed", "checks_failed", F.array_join(F.array_sort("failed_checks"), ",").alias("failed_checks"))


@registry.add(
    "merged_scans",
    """WITH e AS (SELECT user_id, event_type, event_id, floor(value)::BIGINT AS v FROM events)
       SELECT 'u' || user_id AS pipeline_run_id, event_type AS scanner, arg_max(v, event_id) AS findings_count, 'm' || min(event_id) AS scan_mode,
         arg_max(v % 2 = 0, event_id) AS passed, arg_max('f' || v, event_id) AS finding FROM e GROUP BY ALL""",
)
def merged_scans(spark, sf):
    """Scans replaced by run and scanner in the stored table: last counters and findings, first mode."""
    v = F.floor("value").cast("bigint")
    rows = rel.table(spark, sf, "events").select(
        F.concat(F.lit("u"), "user_id").alias("pipeline_run_id"), F.col("event_type").alias("scanner"), F.concat(F.lit("m"), "event_id").alias("scan_mode"),
        (v % 2 == 0).alias("passed"), v.alias("findings_count"), F.array(F.struct(F.concat(F.lit("f"), v).alias("rule_id"))).alias("findings"),
        F.col("event_id").alias("seq"),
    )
    history = store(spark)
    half = (rows.agg(F.max("seq")).first()[0] or 0) // 2
    history.merge("security_scans", rows.where(F.col("seq") > half), merge_scans)  # the later half first
    history.merge("security_scans", rows.where(F.col("seq") <= half), merge_scans)
    history.compact("security_scans")
    stored = history.read("security_scans")
    return stored.select("pipeline_run_id", "scanner", "findings_count", "scan_mode", "passed", F.col("findings")[0]["rule_id"].alias("finding"))


@registry.add(
    "indexed_run_files",
    """SELECT c_nationkey::VARCHAR AS submission_name, c_mktsegment AS run_dir, count(*) AS n, sum(c_custkey)::BIGINT AS keys
       FROM customer WHERE c_nationkey < 20 GROUP BY ALL""",
)
def indexed_run_files(spark, sf):
    """A file per nation and segment is written, and the files of some nations are read through the file index."""
    root = shared_folder(spark, "run-files")
    lines = rel.table(spark, sf, "customer").select(F.col("c_nationkey").alias("s"), F.col("c_mktsegment").alias("r"), F.col("c_custkey").cast("string").alias("value"))
    lines.repartition("s", "r").write.partitionBy("s", "r").text(root)
    files = indexed_files(spark, root, "part-*.txt", partitions=8)
    folder = lambda name: F.url_decode(F.regexp_extract("path", f"{name}=([^/]*)/", 1))
    found = files.select(folder("s").alias("submission_name"), folder("r").alias("run_dir"), F.explode(F.split(F.rtrim("content", F.lit("\n")), "\n")).alias("k"))
    found = found.where(F.col("submission_name").cast("int") < 20)
    return found.groupBy("submission_name", "run_dir").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("k").cast("long")).alias("keys"))
