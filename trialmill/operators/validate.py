"""Structure of submissions per engine, and rules on their metadata.

Errors about one file come from that file's row alone; errors about a whole submission come from one
aggregation of flags over its manifest, which combines on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialmill.functions.text import strip
from trialmill.operators.textscan import front_matter, yaml_scalar

# Fixed values
MAX_SUPPORTIVE_BYTES = 50 * 1024 * 1024
VERSION = r"\A\d+\.\d+\z"
NAME = r"\A[a-z0-9][a-z0-9._-]*\z"
MAX_TRIALS = 100
SKILL_ENGINES = ("harbor", "ase", "both")
SUB = "submission_name"


def metadata_errors(metadata: DataFrame) -> DataFrame:
    """One row per broken rule; null values take the defaults and are fine.

    ``copies``: array of (src, dest). Columns that are absent are not checked.
    """
    have = set(metadata.columns)
    rules: list[tuple[str, Column]] = []

    def rule(column: str, broken: Column, message: str) -> None:
        if column in have:
            rules.append((message, F.coalesce(broken, F.lit(False))))

    c = F.col
    rule("name", F.coalesce(~c("name").rlike(NAME), F.lit(True)), "name must be OCI-safe")
    rule("schema_version", ~c("schema_version").rlike(VERSION), "schema_version must be MAJOR.MINOR")
    for field in ("agent_timeout_sec", "agent_setup_timeout_sec", "verifier_timeout_sec", "build_timeout_sec",
                  "cpus", "memory_mb", "storage_mb"):
        rule(field, c(field) <= 0, f"{field} must be above 0")
    rule("n_trials", ~c("n_trials").between(1, MAX_TRIALS), "n_trials must be in 1..100")
    rule("threshold", ~c("threshold").between(0.0, 1.0), "threshold must be in [0, 1]")
    rule("weight", c("weight") < 0, "weight must not be negative")
    if "copies" in have:
        src = F.transform("copies", lambda x: F.regexp_replace(x["src"], "/+$", ""))
        dest = F.transform("copies", lambda x: F.regexp_replace(x["dest"], "/+$", ""))
        rule("copies", F.exists(src, lambda s: s.contains("..") | s.startswith("/") | (s == "")), "src must be relative")
        rule("copies", F.exists(dest, lambda d: d.contains("..") | ~d.startswith("/")), "dest must be absolute")
        rule("copies", F.size(F.array_distinct(src)) < F.size(src), "duplicate src")
    issues = F.array_compact(F.array(*[F.when(broken, F.lit(message)) for message, broken in rules]))
    return metadata.select(SUB, F.explode(issues).alias("error"))


def _evals_errors(content: Column) -> Column:
    doc = F.try_parse_json(content)
    evals = F.try_variant_get(doc, "$.evals", "array<variant>")

    def filled(e: Column, name: str) -> Column:
        text = F.coalesce(F.try_variant_get(e, f"$.{name}", "string"), F.lit(""))
        return (text != "") & ~text.isin("[]", "{}", "null", "false", "0")

    each = F.flatten(
        F.transform(
            evals,
            lambda e: F.array_compact(
                F.array(
                    F.when(~filled(e, "prompt"), "evals/evals.json: missing required 'prompt' field"),
                    F.when(
                        ~filled(e, "assertions") & ~filled(e, "expected_output"),
                        "evals/evals.json: must have 'assertions' or 'expected_output'",
                    ),
                )
            ),
        )
    )
    return (
        F.when(doc.isNull(), F.array(F.lit("evals/evals.json is not valid JSON")))
        .when(~F.schema_of_variant(doc).startswith("OBJECT"), F.array(F.lit("evals/evals.json must be a JSON object")))
        .when(F.coalesce(F.size(evals), F.lit(0)) <= 0, F.array(F.lit("evals/evals.json must contain a non-empty 'evals' array")))
        .otherwise(each)
    )


def _has_key(content: Column, key: str) -> Column:
    """Top-level YAML key with a value on its line or an indented block below."""
    return content.rlike(rf"(?m)^{key}[ \t]*:(?:[ \t]+[^\s#\[{{]|[ \t]*[\[{{][^\]}}\s]|[ \t]*(?:#.*)?\n+(?:[ \t]+\S|-[ \t]))")


def file_errors(files: DataFrame) -> DataFrame:
    """Errors of single files: submission_name, error. ``files`` carry eval_engine, and mode for harness runs."""
    p, text = F.col("file_path"), F.col("content")
    engine = F.col("eval_engine")
    empty = strip(text) == ""
    skill_file = p.rlike(r"\Askills/(?:[^/]+/)?SKILL\.md\z")
    block = front_matter(text)
    harness_config = (engine == "aeh") & p.rlike(r"\Aeval(?:-control|-treatment)?\.yaml\z")
    task_file = (engine == "mcpchecker") & p.rlike(r"\Atasks/.*\.ya?ml\z")
    kind = yaml_scalar(text, "kind")
    version = F.coalesce(yaml_scalar(text, "apiVersion"), F.lit(""))
    task_eval = (engine == "mcpchecker") & (p == "eval.yaml")

    def one(when: Column, message: Column) -> Column:
        return F.when(F.coalesce(when, F.lit(False)), F.array(message))

    issues = [
        one(engine.isin(*SKILL_ENGINES) & skill_file & empty, F.concat(p, F.lit(" is empty"))),
        one(engine.isin("harbor", "both") & (p == "instruction.md") & empty, F.lit("instruction.md is empty")),
        one(engine.isin("harbor", "both") & p.rlike(r"\Aedge_cases/[^/]+\.md\z") & empty, F.concat(p, F.lit(" is empty"))),
        one(
            engine.isin("harbor", "both") & p.rlike(r"\Aedge_cases/[^/]+\z") & ~p.endswith(".md"),
            F.concat(F.lit("edge_cases/ contains a non-.md file: "), F.substring_index(p, "/", -1)),
        ),
        one(engine.isin("ase", "both") & skill_file & block.isNull(), F.concat(p, F.lit(" is missing YAML frontmatter"))),
        one(
            engine.isin("ase", "both") & skill_file & block.isNotNull() & (F.coalesce(yaml_scalar(block, "name"), F.lit("")) == ""),
            F.concat(p, F.lit(" frontmatter is missing required 'name' field")),
        ),
        F.when(engine.isin("ase", "both") & (p == "evals/evals.json"), _evals_errors(text)),
        one(task_eval & (F.coalesce(kind, F.lit("")) != "Eval"), F.lit("eval.yaml: 'kind' must be 'Eval'")),
        one(task_eval & ~version.startswith("mcpchecker/"), F.lit("eval.yaml: 'apiVersion' must start with 'mcpchecker/'")),
        one(task_eval & ~text.rlike(r"(?m)^metadata:[ \t]*\n(?:[ \t]+.*\n)*?[ \t]+name:[ \t]*\S"), F.lit("eval.yaml: 'metadata.name' is required")),
        one((engine == "mcpchecker") & (p == "mcp-config.yaml") & ~_has_key(text, "mcpServers"), F.lit("mcp-config.yaml: 'mcpServers' section is required")),
        one(task_file & (F.coalesce(kind, F.lit("")) != "Task"), F.concat(p, F.lit(": 'kind' must be 'Task'"))),
        one(task_file & ~text.rlike(r"(?m)^spec:[ \t]*\n(?:[ \t]+.*\n)*?[ \t]+prompt:[ \t]*\S"), F.concat(p, F.lit(": 'spec.prompt' is required"))),
        one(harness_config & ~_has_key(text, "models"), F.concat(p, F.lit(": 'models' section is required"))),
        one(
            harness_config & text.rlike(r"(?m)^models[ \t]*:[ \t]*\n[ \t]+\S") & ~text.rlike(r"(?m)^models:[ \t]*\n(?:[ \t]+.*\n)*?[ \t]+skill:[ \t]*\S"),
            F.concat(p, F.lit(": 'models.skill' is required")),
        ),
        one(harness_config & ~_has_key(text, "judges"), F.concat(p, F.lit(": 'judges' section is required"))),
        one(
            (engine == "aeh") & (p == "eval-treatment.yaml")
            & ~text.rlike(r"(?m)^outputs:[ \t]*\n(?:[ \t]*-[ \t]+(?:path:[ \t]*\S|[^\s:]+[ \t]*$)|(?:[ \t]*-.*\n|[ \t]+.*\n)*?[ \t]+path:[ \t]*\S)"),
            F.concat(p, F.lit(": pairwise mode requires outputs: with at least one path")),
        ),
        one(
            (engine == "aeh") & (p == "eval-treatment.yaml") & ~text.rlike(r"(?im)^[ \t]*-?[ \t]*name:[ \t]*[\"']?pairwise|^[ \t]+pairwise[ \t]*:|^[ \t]*-?[ \t]*type:[ \t]*[\"']?llm"),
            F.concat(p, F.lit(": pairwise mode requires a 'pairwise' LLM judge")),
        ),
    ]
    none = F.array().cast("array<string>")
    return files.select(SUB, F.explode(F.flatten(F.array(*[F.coalesce(i, none) for i in issues]))).alias("error"))


def submission_errors(files: DataFrame) -> DataFrame:
    """Errors of whole submissions from flags over their files: submission_name, error."""
    p = F.col("file_path")
    engine, mode = F.col("eval_engine"), F.coalesce("mode", F.lit("single"))

    def some(condition: Column) -> Column:
        return F.bool_or(F.coalesce(condition, F.lit(False)))

    flags = {
        "metadata": some(p == "metadata.yaml"),
        "skills": some(p.startswith("skills/")),
        "skill": some(p.rlike(r"\Askills/(?:[^/]+/)?SKILL\.md\z")),
        "instruction": some(p == "instruction.md"),
        "tests": some(p == "tests/test_outputs.py"),
        "edge_dir": some(p.startswith("edge_cases/")),
        "edge_md": some(p.rlike(r"\Aedge_cases/[^/]+\.md\z")),
        "eval": some(p == "eval.yaml"),
        "control": some(p == "eval-control.yaml"),
        "treatment": some(p == "eval-treatment.yaml"),
        "mcp": some(p == "mcp-config.yaml"),
        "tasks_dir": some(p.startswith("tasks/")),
        "task_file": some(p.rlike(r"\Atasks/.*\.ya?ml\z")),
        "toml": some(p == "task.toml"),
        "cases_dir": some(p.startswith("cases/")),
        "case": some(p.rlike(r"\Acases/[^/]+/")),
        "bytes": F.coalesce(F.sum(F.when(p.startswith("supportive/"), F.col("size"))), F.lit(0)),
        "meta_name": F.max(F.when(p == "metadata.yaml", yaml_scalar(F.col("content"), "name"))),
        "wrong_skill": F.max(
            F.when(p.rlike(r"\Aeval(?:-control|-treatment)?\.yaml\z"), yaml_scalar(F.col("content"), "skill"))
        ),
        "least_skill": F.min(
            F.when(p.rlike(r"\Aeval(?:-control|-treatment)?\.yaml\z"), yaml_scalar(F.col("content"), "skill"))
        ),
    }
    df = files.groupBy(SUB, "eval_engine", mode.alias("mode")).agg(*[v.alias(k) for k, v in flags.items()])
    f = {k: F.col(k) for k in flags}
    skilled, docker = engine.isin(*SKILL_ENGINES), engine.isin("harbor", "both")
    task, harness = engine == "mcpchecker", engine == "aeh"
    pair = F.col("mode") == "pairwise"
    mismatch = f["meta_name"].isNotNull() & (
        (f["wrong_skill"] != f["meta_name"]) | (f["least_skill"] != f["meta_name"])
    )
    rules = [
        (~f["metadata"], "metadata.yaml is missing"),
        (skilled & ~f["skills"], "skills/ directory is missing"),
        (skilled & f["skills"] & ~f["skill"], "skills/ must contain at least one SKILL.md"),
        (docker & ~f["instruction"], "instruction.md is missing"),
        (docker & ~f["tests"], "test_outputs.py is missing"),
        (docker & f["edge_dir"] & ~f["edge_md"], "edge_cases/ directory exists but contains no .md files"),
        (engine.isin("ase", "both") & ~f["skill"], "No SKILL.md found under skills/"),
        (task & ~f["eval"], "eval.yaml is required"),
        (task & ~f["mcp"], "mcp-config.yaml is required"),
        (task & ~f["tasks_dir"], "tasks/ directory is required"),
        (task & f["tasks_dir"] & ~f["task_file"], "tasks/ must contain at least one .yaml task file"),
        ((engine == "a2a") & ~f["instruction"] & ~f["toml"] & ~f["tasks_dir"], "instruction.md, task.toml, or tasks/ is required"),
        (harness & ~pair & ~f["eval"], "eval.yaml is required"),
        (harness & pair & ~f["control"], "missing eval-control.yaml"),
        (harness & pair & ~f["treatment"], "missing eval-treatment.yaml"),
        (harness & ~f["cases_dir"], "cases/ directory is required"),
        (harness & f["cases_dir"] & ~f["case"], "cases/ must contain at least one case directory"),
        (harness & mismatch, "skill must match metadata.name"),
        (skilled & (f["bytes"] > MAX_SUPPORTIVE_BYTES), "supportive/ exceeds 50 MB limit"),
    ]
    issues = F.array_compact(F.array(*[F.when(F.coalesce(r, F.lit(False)), F.lit(m)) for r, m in rules]))
    return df.select(SUB, F.explode(issues).alias("error"))


def case_errors(files: DataFrame) -> DataFrame:
    """Harness case directories without input.yaml."""
    cases = files.where((F.col("eval_engine") == "aeh") & F.col("file_path").rlike(r"\Acases/[^/]+/"))
    folder = F.concat(F.lit("cases/"), F.element_at(F.split("file_path", "/"), 2))
    return (
        cases.groupBy(SUB, folder.alias("_case"))
        .agg(F.bool_or(F.col("file_path") == F.concat(folder, F.lit("/input.yaml"))).alias("_ok"))
        .where("NOT _ok")
        .select(SUB, F.concat("_case", F.lit(": missing required input.yaml")).alias("error"))
    )


def plugin_errors(files: DataFrame) -> DataFrame:
    """Directories listed as ``plugin_dirs`` that hold no skill file, by an anti-join on their path."""
    configs = files.where((F.col("eval_engine") == "aeh") & F.col("file_path").rlike(r"\Aeval(?:-control|-treatment)?\.yaml\z"))
    listed = F.regexp_extract("content", r"(?m)^[ \t]+plugin_dirs:[ \t]*\n((?:[ \t]+-[ \t]+.*(?:\n|\z))+)", 1)
    entries = configs.select(
        SUB, F.col("file_path").alias("_config"), F.explode(F.regexp_extract_all(listed, F.lit(r"-[ \t]+[\"']?([^\s\"']+)"), 1)).alias("_dir")
    ).withColumn("_dir", F.regexp_replace("_dir", r"^\./|/+$", ""))
    skill = files.where(F.col("file_path").endswith("/SKILL.md"))
    parts = F.split("file_path", "/")
    homes = skill.select(
        SUB,
        F.explode(
            F.array_compact(
                F.array(
                    F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/"),
                    F.when(F.size(parts) > 2, F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 2, F.lit(1))), "/")),
                )
            )
        ).alias("_dir"),
    ).distinct()
    return entries.join(homes, [SUB, "_dir"], "left_anti").select(
        SUB, F.concat("_config", F.lit(": plugin_dirs '"), "_dir", F.lit("/' must contain SKILL.md")).alias("error")
    )


def validate_submissions(files: DataFrame) -> DataFrame:
    """All errors. ``files``: submission_name, eval_engine, mode, file_path, size, content."""
    return (
        submission_errors(files).unionByName(file_errors(files)).unionByName(case_errors(files)).unionByName(plugin_errors(files))
    )


def validation_result(submissions: DataFrame, errors: DataFrame) -> DataFrame:
    """``valid`` and the number of errors per submission."""
    n = errors.groupBy(SUB).agg(F.count(F.lit(1)).alias("_n"))
    return submissions.join(n, SUB, "left").select(
        *submissions.columns, F.coalesce("_n", F.lit(0)).alias("n_errors"), F.col("_n").isNull().alias("valid")
    )
