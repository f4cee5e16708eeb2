"""Stored history: rows for the tables, idempotent appends and counters that are replaced.

Tables are folders of parquet files. A write is a Spark append of new rows only: rows whose key is
already stored are left out by an anti-join, and duplicates inside one batch are dropped before it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trialmill.functions.scalars import content_key
from trialmill.operators.gates import count_severity, findings_of

# Fixed values
STATS = ("n_trials", "n_passed", "n_failed", "n_errors", "pass_rate", "mean_reward", "median_reward", "std_reward")


def row_id(*natural_key: str) -> Column:
    """Stable identifier from the natural key, so that a retried task writes the same rows."""
    return F.sha2(F.concat_ws("\u0001", *[F.col(k).cast("string") for k in natural_key]), 256)


def run_key(run_id: Column, raw: Column) -> Column:
    return F.coalesce(F.nullif(run_id, F.lit("")), content_key(raw))


def report_runs(reports: DataFrame) -> DataFrame:
    """``evaluation_runs`` rows from report documents: pipeline_run_id (nullable), artifact_text, doc."""

    def text(path: str) -> Column:
        return F.try_variant_get("doc", path, "string")

    def number(path: str) -> Column:
        return F.try_variant_get("doc", path, "double")

    columns = [
        run_key(F.col("pipeline_run_id"), F.col("artifact_text")).alias("pipeline_run_id"),
        text("$.submission_name").alias("submission_name"),
        *[text(f"$.provenance.{c}").alias(c) for c in ("commit_sha", "treatment_image_ref", "control_image_ref", "harbor_fork_revision", "eval_engine")],
        text("$.summary.recommendation").alias("recommendation"),
        *[number(f"$.summary.{c}").alias(c) for c in ("uplift", "mean_reward_gap", "ttest_p_value", "fisher_p_value")],
    ]
    for variant in ("treatment", "control"):
        for stat in STATS:
            kind = "int" if stat.startswith("n_") else "double"
            columns.append(F.try_variant_get("doc", f"$.summary.{variant}.{stat}", kind).alias(f"{variant}_{stat}"))
    rows = reports.where(F.col("doc").isNotNull()).select(*columns, F.col("artifact_text").alias("report_json"))
    return rows.withColumn("id", row_id("pipeline_run_id"))


def report_trials(reports: DataFrame) -> DataFrame:
    """``trials`` rows: the report's map of variants to trial lists."""
    by_variant = reports.where(F.col("doc").isNotNull()).select(
        run_key(F.col("pipeline_run_id"), F.col("artifact_text")).alias("pipeline_run_id"),
        F.explode(F.try_variant_get("doc", "$.trials", "map<string,array<struct<trial_name:string,reward:double>>>")).alias("variant", "_list"),
    )
    return by_variant.select("pipeline_run_id", "variant", F.posexplode("_list").alias("trial_no", "_t")).select(
        "pipeline_run_id", "variant", "trial_no", "_t.trial_name", "_t.reward",
        F.coalesce(F.col("_t.reward") > 0, F.lit(False)).alias("passed"),
    )


def scan_rows(scans: DataFrame) -> DataFrame:
    """``security_scans`` rows with counters, from pipeline_run_id, submission_name, scanner, scan_mode, doc."""
    df = scans.withColumn("findings", findings_of(F.col("doc")))
    critical, high = count_severity(F.col("findings"), "critical"), count_severity(F.col("findings"), "high")
    return df.select(
        "pipeline_run_id", "submission_name", "scanner", "scan_mode",
        ((F.col("scan_mode") != "block") | (critical + high == 0)).alias("passed"),
        F.size("findings").alias("findings_count"), critical.alias("critical_count"), high.alias("high_count"), "findings",
    )


def scorecard_rows(combined: DataFrame, certified: DataFrame, key: list[str]) -> DataFrame:
    """``scorecards`` rows: verdict, counters and the highest certification."""
    return combined.join(certified.select(*key, F.col("highest_level").alias("highest_certification")), key, "left").withColumn(
        "highest_certification", F.coalesce("highest_certification", F.lit("none"))
    )


def new_rows(incoming: DataFrame, stored: DataFrame | None, key: list[str]) -> DataFrame:
    """Rows whose key is not stored yet; of several with one key inside the batch one is kept."""
    unique = incoming.dropDuplicates(key)
    return unique if stored is None else unique.join(stored.select(*key), key, "left_anti")


def children_of(rows: DataFrame, new_parents: DataFrame, key: list[str]) -> DataFrame:
    """Child rows of newly stored parents only, so that a run is stored with all its rows or not at all."""
    return rows.join(new_parents.select(*key), key, "left_semi")


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table, or None before the first write."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def store_runs(runs: DataFrame, trials: DataFrame, folder: str) -> DataFrame:
    """Append new runs and their trials; running it again adds nothing.

    Trials are written first and the run row last: a run whose write was interrupted has no run row, so
    the next attempt repeats it. Trials that did get written are left out then by their own key.
    """
    spark = runs.sparkSession
    fresh = new_rows(runs, read_table(spark, f"{folder}/evaluation_runs"), ["pipeline_run_id"])
    rows = children_of(trials, fresh, ["pipeline_run_id"])
    new_rows(rows, read_table(spark, f"{folder}/trials"), ["pipeline_run_id", "variant", "trial_no"]).write.mode(
        "append"
    ).parquet(f"{folder}/trials")
    fresh.write.mode("append").parquet(f"{folder}/evaluation_runs")
    return spark.read.parquet(f"{folder}/evaluation_runs")


def store_scans(scans: DataFrame, folder: str) -> None:
    """Scans are skipped by run id on their own, whether or not the run row exists."""
    stored = read_table(scans.sparkSession, f"{folder}/security_scans")
    fresh = scans.dropDuplicates(["pipeline_run_id", "scanner"])
    if stored is not None:
        fresh = fresh.join(stored.select("pipeline_run_id"), "pipeline_run_id", "left_anti")
    fresh.write.mode("append").parquet(f"{folder}/security_scans")


def upsert_scans(stored: DataFrame, incoming: DataFrame, key: tuple[str, ...] = ("pipeline_run_id", "scanner")) -> DataFrame:
    """Counters of the last write; scanner, mode and creation time of the first.

    Both sides have ``seq``. One aggregation with partial combine, no ordering of a key's rows.
    """
    both = stored.unionByName(incoming)
    last = ["passed", "findings_count", "critical_count", "high_count"]
    first = [c for c in ("scan_mode", "created_at", "submission_name") if c in both.columns]
    return both.groupBy(*key).agg(
        *[F.min_by(c, "seq").alias(c) for c in first],
        *[F.max_by(c, "seq").alias(c) for c in last],
        F.max("seq").alias("seq"),
    )


def backfill_outcomes(listing: DataFrame, stored: DataFrame) -> DataFrame:
    """Every listed scorecard as error (unreadable), skipped (stored) or processed (new)."""
    doc = F.try_parse_json("content")
    df = listing.select("path", doc.alias("doc")).withColumn("pipeline_run_id", F.try_variant_get("doc", "$.pipeline_run_id", "string"))
    known = stored.select("pipeline_run_id", F.lit(True).alias("_known")).distinct()
    outcome = (
        F.when(F.col("pipeline_run_id").isNull(), "error").when(F.col("_known"), "skipped").otherwise("processed")
    )
    return df.join(known, "pipeline_run_id", "left").withColumn("outcome", outcome).drop("_known")


def backfill_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def last_errors(outcomes: DataFrame, most: int | None = None) -> DataFrame:
    """Paths of all errors, or of the last ``most`` by name."""
    errors = outcomes.where("outcome = 'error'").select("path")
    return errors if most is None else errors.orderBy(F.col("path").desc()).limit(most)


def enrich_reports(
    reports: DataFrame, scans: DataFrame, edge_cases: DataFrame, degradation: DataFrame, changes: DataFrame
) -> DataFrame:
    """Reports with scan counters, edge-case counts, degradation and change data, by left joins on the run.

    Scans and edge cases are counted per run before the join.
    """
    run = ["pipeline_run_id"]
    found = scans.groupBy(*run).agg(
        F.sum("findings_count").alias("scan_findings"), F.bool_and("passed").alias("scans_passed")
    )
    edges = edge_cases.groupBy(*run).agg(
        F.count(F.lit(1)).alias("edge_total"), F.count_if("passed").alias("edge_passed")
    )
    return (
        reports.join(found, run, "left").join(edges, run, "left").join(degradation, run, "left").join(changes, run, "left")
    )


def write_documents(rows: DataFrame, path: str, partition: str | None = None) -> None:
    """JSON documents, one line per run."""
    writer = rows.write.mode("append")
    (writer.partitionBy(partition) if partition else writer).json(path)


def report_documents(runs: DataFrame, key: list[str]) -> DataFrame:
    """Report document per analysed run, in the shape :func:`report_runs` reads."""

    def side(v: str) -> Column:
        return F.struct(*[F.col(f"{v}_{s}").alias(s) for s in STATS]).alias(v)

    measures = ["uplift", "mean_reward_gap", "ttest_p_value", "fisher_p_value", "recommendation"]
    provenance = F.struct("pipeline_run_id", "eval_engine").alias("provenance")
    summary = F.struct(side("treatment"), side("control"), *measures).alias("summary")
    return runs.select(*key, F.to_json(F.struct("submission_name", provenance, summary)).alias("document"))


def certification_documents(certified: DataFrame, key: list[str]) -> DataFrame:
    """Certification document per run: highest level and, per level, result and failed checks."""
    levels = F.struct(*[F.col(x) for x in ("foundational", "trusted", "certified")])
    return certified.select(*key, F.to_json(F.struct("highest_level", levels.alias("levels"))).alias("document"))


_GATE = (
    "struct<gate_name:string,gate_type:string,policy_key:string,passed:boolean,score:double,mode:string,threshold:double,"
    "findings:array<variant>,message:string,details:variant,evaluated_at:string>"
)


def scorecard_document_rows(scorecards: DataFrame) -> DataFrame:
    """``scorecards`` rows from scorecard documents: pipeline_run_id, artifact_text, doc."""

    def text(path: str) -> Column:
        return F.try_variant_get("doc", path, "string")

    counters = ("gates_passed", "gates_failed", "blocking_gates_passed", "blocking_gates_failed")
    return scorecards.where(F.col("doc").isNotNull()).select(
        run_key(F.col("pipeline_run_id"), F.col("artifact_text")).alias("pipeline_run_id"),
        *[text(f"$.{c}").alias(c) for c in ("submission_name", "eval_engine", "recommendation", "recommendation_reason")],
        text("$.policy.combination").alias("combination_mode"),
        *[F.try_variant_get("doc", f"$.{c}", "int").alias(c) for c in counters],
        F.coalesce(text("$.highest_certification"), F.lit("none")).alias("highest_certification"),
        F.col("artifact_text").alias("scorecard_json"),
    )


def gate_result_rows(scorecards: DataFrame) -> DataFrame:
    """``gate_results`` rows: one per gate of a scorecard document, in its order.

    A gate without a policy key is looked up by its name. Empty details are null; a missing mode is warn.
    """
    gates = scorecards.where(F.col("doc").isNotNull()).select(
        run_key(F.col("pipeline_run_id"), F.col("artifact_text")).alias("pipeline_run_id"),
        F.posexplode(F.try_variant_get("doc", "$.gates", f"array<{_GATE}>")).alias("gate_no", "g"),
    )
    details = F.to_json("g.details")
    return gates.select(
        "pipeline_run_id", "gate_no", "g.gate_name", "g.gate_type",
        F.coalesce(F.nullif("g.policy_key", F.lit("")), "g.gate_name").alias("policy_key"),
        "g.passed", "g.score", F.coalesce("g.mode", F.lit("warn")).alias("mode"), "g.threshold",
        F.coalesce(F.size("g.findings"), F.lit(0)).alias("findings_count"), "g.message",
        F.when(details != "{}", details).alias("details_json"), "g.evaluated_at",
    )


def certification_rows(scorecards: DataFrame) -> DataFrame:
    """``certifications`` rows: one per level of a scorecard document that was certified; no failed check is null."""
    level = "struct<level:string,passed:boolean,checks_total:int,checks_passed:int,checks:array<struct<check_id:string,passed:boolean>>>"
    levels = F.array(*[F.try_variant_get("doc", f"$.certification.{x}", level) for x in ("foundational", "trusted", "certified")])
    rows = scorecards.where(F.col("doc").isNotNull()).select(
        run_key(F.col("pipeline_run_id"), F.col("artifact_text")).alias("pipeline_run_id"), F.explode(levels).alias("l")
    )
    failed = F.transform(F.filter("l.checks", lambda c: ~c["passed"]), lambda c: c["check_id"])
    return rows.where("l is not null").select(
        "pipeline_run_id", "l.level", "l.passed", "l.checks_total", "l.checks_passed",
        (F.col("l.checks_total") - F.col("l.checks_passed")).alias("checks_failed"),
        F.when(F.size(failed) > 0, failed).alias("failed_checks"),
    )
