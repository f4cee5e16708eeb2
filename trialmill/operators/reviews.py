"""Reviews and judge answers, prompts from edge cases, and helpers over submission files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from trialmill.functions.stats import let, ratio
from trialmill.functions.text import strip
from trialmill.operators.textscan import scanned_files

# Fixed values
FAIL_WORDS = ("fail", "not ready", "problematic", "reject")
EDGE_CASE_ASSERTIONS = (
    "The response handles the edge case appropriately without crashing or producing nonsensical output",
    "The response acknowledges limitations or uncertainty when the input is unusual",
    "The response remains helpful and coherent despite the edge case conditions",
)
CRITERIA_HEADINGS = (
    "Workflow",
    "When to Use This Skill",
    "Common Issues",
    "Critical: Human-in-the-Loop",
    "Security Considerations",
)
NULL_LIKE = ("null", "none", "n/a", "")
SUB = "submission_name"


def normalize_review(reviews: DataFrame, key: list[str]) -> DataFrame:
    """Overall score (mean of dimensions where missing), recommendation (bands 0.6, 0.4), passed."""
    dims = F.map_values(F.try_variant_get("doc", "$.dimensions", "map<string,variant>"))
    scores = F.transform(dims, lambda d: F.coalesce(F.try_variant_get(d, "$.score", "double"), F.lit(0.0)))
    mean = ratio(F.aggregate(scores, F.lit(0.0), lambda acc, s: acc + s), F.size(scores), 0.0)
    overall = F.coalesce(F.try_variant_get("doc", "$.overall_score", "double"), mean)
    df = reviews.withColumn("overall_score", overall)
    band = F.when(F.col("overall_score") >= 0.6, "pass").when(F.col("overall_score") >= 0.4, "warn").otherwise("fail")
    df = df.withColumn("recommendation", F.coalesce(F.try_variant_get("doc", "$.recommendation", "string"), band))
    advisory = F.col("eval_engine") == "aeh"
    return df.select(
        *key, "overall_score", "recommendation", (advisory | (F.col("recommendation") != "fail")).alias("passed")
    )


def parse_verdict(answer: Column) -> Column:
    """Struct (passed, issues) from a reviewer's answer.

    JSON, else the text from the first to the last brace, else words: failing words beat passing ones and
    an answer without either passes.
    """
    whole = F.try_parse_json(answer)
    found = F.coalesce(whole, F.try_parse_json(F.nullif(F.regexp_extract(answer, r"(?s)\{.*\}", 0), F.lit(""))))
    flag = F.coalesce(F.try_variant_get(found, "$.pass", "boolean"), F.lit(False))
    listed = F.try_variant_get(found, "$.issues", "array<string>")
    single = F.try_variant_get(found, "$.issues", "string")
    none = F.array().cast("array<string>")
    issues = F.coalesce(listed, F.when(single.isNotNull(), F.array(single)), none)
    lower = F.lower(answer)
    bad = F.lit(False)
    for w in FAIL_WORDS:
        bad = bad | lower.contains(w)
    return (
        F.when(found.isNotNull(), F.struct(flag.alias("passed"), issues.alias("issues")))
        .when(bad, F.struct(F.lit(False).alias("passed"), F.array(strip(answer)).alias("issues")))
        .otherwise(F.struct(F.lit(True).alias("passed"), none.alias("issues")))
    )


def combine_reviewers(verdicts: DataFrame, key: list[str]) -> DataFrame:
    """All reviewers of a submission together: issues carry the reviewer's name.

    A reviewer that fails without naming an issue does not fail the set.
    """
    told = (~F.col("passed")) & (F.size("issues") > 0)
    named = F.transform("issues", lambda i: F.concat(F.lit("["), "reviewer", F.lit("] "), i))
    return verdicts.groupBy(*key).agg(
        (~F.bool_or(told)).alias("passed"),
        F.array_sort(F.flatten(F.collect_list(F.when(told, named)))).alias("issues"),
    )


def fallback_score(response: Column) -> Column:
    """0.0 for an error, 0.1 for at most ten characters, else 0.5."""
    text = strip(response)
    return F.when(text.startswith("ERROR:"), 0.0).when(F.length(text) <= 10, 0.1).otherwise(0.5)


def is_generated(path: Column, content: Column) -> Column:
    """Whether a file was written by the generator, by its suffix."""
    name = F.substring_index(path, "/", -1)
    return F.coalesce(
        F.when(name == "scenario_brief.json", True)
        .when(name.endswith(".py"), content.startswith("# Generated by AI"))
        .when(name.endswith(".md"), content.contains("<!-- Generated by AI -->"))
        .when(name.endswith(".json"), F.try_variant_get(F.try_parse_json(content), "$._generated_by", "string") == "ai"),
        F.lit(False),
    )


def artifact_prefix(at: Column, submission: Column, run: Column) -> Column:
    return F.concat_ws("_", F.date_format(at, "yyyyMMdd_HHmmss"), submission, run)


def edge_case_prompts(files: DataFrame) -> DataFrame:
    """Prompt table from ``edge_cases/*.md``; blank files are skipped."""
    stem = F.regexp_extract("file_path", r"\Aedge_cases/([^/]+)\.md\z", 1)
    prompt = strip(F.col("content"))
    return files.where((stem != "") & (prompt != "")).select(
        SUB,
        F.concat(F.lit("edge-"), stem).alias("id"),
        F.concat(F.lit("Edge case: "), F.replace(stem, F.lit("_"), F.lit(" "))).alias("name"),
        prompt.alias("prompt"),
        F.array(*[F.lit(a) for a in EDGE_CASE_ASSERTIONS]).alias("assertions"),
    )


def quality_criteria(content: Column, fallback_chars: int | None = None) -> Column:
    """The five headings of interest with their text, else the whole body (or its first ``fallback_chars``)."""
    body = F.when(content.startswith("---\n"), F.regexp_replace(content, r"\A---\n(?s:.*?)\n---\n", "")).otherwise(content)

    def section(body: Column, heading: str) -> Column:
        # without the heading, a text would be read once more from every "## " on; the last heading of the match is that of the text
        may = body.contains(heading) & body.contains("## ")
        whole = F.when(may, F.regexp_extract(body, rf"(?s)## .*\Q{heading}\E.*?\n.*?(?=\n## |\z)", 0))
        head = lambda v: F.regexp_extract(v["whole"], rf"(?s)\A## .*\Q{heading}\E.*?\n", 0)
        text = lambda v: F.substr(v["whole"], F.length(v["head"]) + 1)
        both = let({"whole": whole}, lambda v: let({"whole": v["whole"], "head": head(v)}, lambda w: F.when(w["head"] != "", F.concat(strip(w["head"]), F.lit("\n"), strip(text(w))))))
        return F.when(may, both)

    def chosen(v: Column) -> Column:
        rest = v["body"] if fallback_chars is None else F.substring(v["body"], 1, fallback_chars)
        return F.when(F.size(v["found"]) > 0, F.array_join(v["found"], "\n\n")).otherwise(rest)

    found = lambda v: F.array_compact(F.array(*[section(v["body"], h) for h in CRITERIA_HEADINGS]))
    return let({"body": body}, lambda v: let({"body": v["body"], "found": found(v)}, chosen))


def scenario_gaps(briefs: DataFrame, texts: DataFrame) -> DataFrame:
    """Values of a scenario brief that its texts do not mention, by an equi-join on the submission.

    ``briefs``: submission_name, project_files array, expected_outputs map. ``texts``: submission_name,
    instruction, tests.
    """
    df = briefs.join(texts, SUB, "left")
    instruction = F.coalesce("instruction", F.lit(""))
    tests = F.coalesce("tests", F.lit(""))
    wanted = F.filter(F.map_entries("expected_outputs"), lambda e: ~F.lower(e["value"]).isin(*NULL_LIKE))

    def absent(text: Column) -> Column:
        return F.transform(
            F.filter(wanted, lambda e: ~text.contains(e["value"])), lambda e: F.concat(e["key"], F.lit("="), e["value"])
        )

    return df.select(
        SUB,
        F.filter("project_files", lambda p: ~instruction.contains(F.substring_index(p, "/", -1))).alias("files_missing"),
        absent(tests).alias("outputs_missing_in_tests"),
        absent(instruction).alias("outputs_missing_in_instruction"),
    )


def detect_harness(submissions: DataFrame, manifest: DataFrame) -> DataFrame:
    """Whether a submission is a harness one, and an advisory review where required files are missing."""
    p = F.col("file_path")
    flags = manifest.groupBy(SUB).agg(
        F.bool_or(p.isin("eval.yaml", "eval-control.yaml", "eval-treatment.yaml")).alias("_eval"),
        F.bool_or(p == "metadata.yaml").alias("_meta"),
        F.bool_or(p.startswith("cases/")).alias("_cases"),
    )
    df = submissions.join(flags, SUB, "left").withColumns(
        {c: F.coalesce(c, F.lit(False)) for c in ("_eval", "_meta", "_cases")}
    )
    missing = F.array_compact(
        F.array(
            F.when(~F.col("_meta"), "metadata.yaml"),
            F.when(~F.col("_eval"), "eval.yaml or eval-control/treatment.yaml"),
            F.when(~F.col("_cases"), "cases/"),
        )
    )
    harness = F.coalesce(F.col("eval_engine") == "aeh", F.lit(False)) | F.col("_eval")
    advisory = harness & (F.size(missing) > 0)
    return df.select(
        SUB,
        harness.alias("is_harness"),
        F.when(advisory, F.array_join(missing, ", ")).alias("missing"),
        F.when(advisory, 0.5).alias("overall_score"),
        F.when(advisory, "warn").alias("recommendation"),
        F.when(advisory, True).alias("passed"),
    )


def main_skill_file(files: DataFrame) -> DataFrame:
    """The skill file of a submission: ``skills/SKILL.md``, then one folder down, then any, by name."""
    p = F.col("file_path")
    rank = F.when(p == "skills/SKILL.md", 0).when(p.rlike(r"\Askills/[^/]+/SKILL\.md\z"), 1).otherwise(2)
    own = files.where(F.substring_index(p, "/", -1) == "SKILL.md")
    return own.groupBy(SUB).agg(F.min(F.struct(rank.alias("rank"), p.alias("file_path"))).alias("_best")).select(
        SUB, F.col("_best.file_path").alias("file_path")
    )


def shown_findings(
    findings: DataFrame, key: list[str], limit: int | None = None, message_chars: int | None = None
) -> DataFrame:
    """Findings per scan with their position; with ``limit`` the first ones, and how many more there are.

    The rank filter is applied before the shuffle too, and the totals combine on the map side.
    """
    shown_no = F.row_number().over(W.partitionBy(*key).orderBy("finding_no"))
    message = F.col("message") if message_chars is None else F.substring("message", 1, message_chars)
    ranked = findings.withColumn("shown_no", shown_no)
    if limit is None:
        return ranked.select(*key, "shown_no", "severity", "rule_id", message.alias("message"), F.lit(0).cast("bigint").alias("more"))
    totals = findings.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return ranked.where(F.col("shown_no") <= limit).join(totals, key).select(
        *key, "shown_no", "severity", "rule_id", message.alias("message"),
        F.greatest(F.col("_n") - limit, F.lit(0)).alias("more"),
    )


def first_cases(cases: DataFrame, key: list[str], limit: int | None = None) -> DataFrame:
    """Cases of a submission by name with their position; with ``limit`` the first ones."""
    order = W.partitionBy(*key).orderBy("case_id")
    ranked = cases.withColumn("case_no", F.row_number().over(order))
    return ranked if limit is None else ranked.where(F.col("case_no") <= limit)


def review_input(files: DataFrame, limit: int | None = None) -> DataFrame:
    """Files in name order with their characters so far; with ``limit`` up to, not including, the first that exceeds it.

    Only names and lengths are shuffled, and the running sum spills.
    """
    order = W.partitionBy(SUB).orderBy("file_path").rowsBetween(W.unboundedPreceding, W.currentRow)
    sizes = scanned_files(files).select(SUB, "file_path", F.length("content").cast("bigint").alias("n_chars"))
    summed = sizes.withColumn("chars_upto", F.sum("n_chars").over(order))
    return summed if limit is None else summed.where(F.col("chars_upto") <= limit)
