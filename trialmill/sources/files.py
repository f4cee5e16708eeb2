"""Result and submission files as tables.

Files are read whole through Spark's file source, whose listing passes through the driver; for folders with very many
files :mod:`trialmill.sources.file_index` lists in the tasks. A path column tells which run a file belongs to. JSON is kept as VARIANT: absent, corrupt and
readable documents stay distinguishable, and numbers keep their JSON type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from trialmill.functions.scalars import trial_reward
from trialmill.operators.textscan import normal_path, yaml_scalar

# Fixed values
SINGLE_VARIANT_DIR = "a2a-eval"
AB_DIRS = ("treatment", "control")
TREATMENT_PART = "with_skill"
CONTROL_PART = "without_skill"


def read_files(spark: SparkSession, root: str, name_glob: str) -> DataFrame:
    """path (relative to ``root``), modified, size, content: one row per file, whole."""
    raw = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", name_glob)
        .load(root)
    )
    return raw.select(
        relative_path(F.col("path"), root).alias("path"),
        F.col("modificationTime").alias("modified"),
        F.col("length").alias("size"),
        F.make_valid_utf8(F.col("content").cast("string")).alias("content"),  # bytes that are no UTF-8 are replaced
    )


def relative_path(path: Column, root: str) -> Column:
    plain = F.regexp_replace(path, r"\A[a-zA-Z0-9+.-]+:(?://[^/]*)?(?=/)", "")
    base = "/" + root.split(":", 1)[-1].strip("/") + "/"
    return F.when(plain.contains(base), F.substring_index(plain, base, -1)).otherwise(plain)


def _split(path: Column) -> Column:
    return F.split(path, "/")


def _parent(path: Column) -> Column:
    return F.coalesce(F.try_element_at(_split(path), F.lit(-2)), F.lit(""))


def trial_rows(files: DataFrame, run: Column | None = None) -> DataFrame:
    """Trials from ``<run>/<variant>/.../<trial>/result.json``.

    A readable document without ``verifier_result`` is a job's and is left out. A corrupt one, or one
    whose reward is no number, is an error trial with a null reward. The single-variant folder counts
    only in runs that have neither a treatment nor a control folder.
    """
    parts = _split(F.col("path"))
    doc = F.try_parse_json("content")
    keys = F.map_keys(F.try_variant_get(doc, "$", "map<string,variant>"))
    job = doc.isNotNull() & ~F.coalesce(F.array_contains(keys, "verifier_result"), F.lit(False))
    rows = files.where(F.col("path").endswith("result.json") & ~job).select(
        (F.try_element_at(parts, F.lit(1)) if run is None else run).alias("pipeline_run_id"),
        F.try_element_at(parts, F.lit(2)).alias("_folder"),
        _parent(F.col("path")).alias("trial_name"),
        trial_reward(doc).alias("reward"),
        F.col("modified").alias("created_at"),
    )
    ab = files.select(
        (F.try_element_at(parts, F.lit(1)) if run is None else run).alias("pipeline_run_id"), F.try_element_at(parts, F.lit(2)).alias("_f")
    ).groupBy("pipeline_run_id").agg(F.bool_or(F.col("_f").isin(*AB_DIRS)).alias("_ab"))
    known = rows.join(ab, "pipeline_run_id")
    variant = F.when(F.col("_ab") & F.col("_folder").isin(*AB_DIRS), F.col("_folder")).when(
        ~F.col("_ab") & (F.col("_folder") == SINGLE_VARIANT_DIR), "treatment"
    )
    return known.withColumn("variant", variant).where(F.col("variant").isNotNull()).select(
        "pipeline_run_id", "variant", (~F.col("_ab")).alias("single_variant"), "trial_name", "reward", "created_at"
    )


def grading_rows(files: DataFrame, iterations: int) -> DataFrame:
    """Gradings of iterations 1 to ``iterations``, directly below the run; the path tells the variant.

    A missing rate is 0.0. An unreadable document is an error trial: its reward is null.
    """
    parts = _split(F.col("path"))
    number = F.regexp_extract("path", r"\A[^/]+/iteration-(\d+)/", 1)
    variant = F.when(F.array_contains(parts, TREATMENT_PART), "treatment").when(
        F.array_contains(parts, CONTROL_PART), "control"
    )
    doc = F.try_parse_json("content")
    df = files.where(F.col("path").endswith("grading.json") & (number != ""))
    return (
        df.withColumn("iteration", number.cast("int"))
        .withColumn("variant", variant)
        .where(F.col("variant").isNotNull() & F.col("iteration").between(1, iterations))
        .select(
            F.element_at(parts, 1).alias("pipeline_run_id"),
            "variant",
            F.concat(F.lit("iteration-"), "iteration", F.lit("-"), "variant").alias("trial_name"),
            F.when(doc.isNotNull(), F.coalesce(F.try_variant_get(doc, "$.summary.pass_rate", "double"), F.lit(0.0))).alias("reward"),
        )
    )


def benchmark_rows(files: DataFrame, iterations: int) -> DataFrame:
    """Benchmark documents in the iterations' own folders, else all that a run has."""
    own = F.regexp_extract("path", r"\A[^/]+/iteration-(\d+)/benchmark\.json\z", 1)
    df = files.where(F.col("path").endswith("benchmark.json")).select(
        F.element_at(_split(F.col("path")), 1).alias("pipeline_run_id"), "path",
        F.try_parse_json("content").alias("doc"), own.alias("_own"),
    ).withColumn("_mine", (F.col("_own") != "") & F.coalesce(F.nullif("_own", F.lit("")).cast("int").between(1, iterations), F.lit(False)))
    any_own = df.groupBy("pipeline_run_id").agg(F.bool_or("_mine").alias("_any"))
    return df.join(any_own, "pipeline_run_id").where(F.col("_mine") | ~F.col("_any")).drop("_own", "_mine", "_any")


def edge_case_gradings(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cases, gradings) from ``<run>/<case>/.../grading.json``; every case folder is listed."""
    parts = _split(F.col("path"))
    key = [F.element_at(parts, 1).alias("pipeline_run_id"), F.element_at(parts, 2).alias("name")]
    doc = F.try_parse_json("content")
    cases = files.where(F.size(parts) > 2).select(*key).distinct()
    gradings = files.where(F.col("path").endswith("grading.json") & F.array_contains(parts, TREATMENT_PART)).select(
        *key,
        F.coalesce(F.try_variant_get(doc, "$.summary.passed", "bigint"), F.lit(0)).alias("n_passed"),
        F.coalesce(F.try_variant_get(doc, "$.summary.total", "bigint"), F.lit(0)).alias("n_total"),
        doc.isNull().alias("corrupt"),
    )
    return cases, gradings


def documents(files: DataFrame, name: str, alias: str = "doc") -> DataFrame:
    """One document per run folder: pipeline_run_id, artifact_state, doc. Absent ones need a left join."""
    doc = F.try_parse_json("content")
    return files.where(F.substring_index("path", "/", -1) == name).select(
        F.element_at(_split(F.col("path")), 1).alias("pipeline_run_id"),
        "path",
        F.col("content").alias("artifact_text"),
        F.when(doc.isNull(), "corrupt").otherwise("ok").alias("artifact_state"),
        doc.alias(alias),
    )


def with_artifact(runs: DataFrame, docs: DataFrame) -> DataFrame:
    """Runs with their document, ``artifact_state`` absent where there is none."""
    return runs.join(docs.drop("path"), "pipeline_run_id", "left").withColumn(
        "artifact_state", F.coalesce("artifact_state", F.lit("absent"))
    )


def readable_reports(runs: DataFrame, docs: DataFrame) -> DataFrame:
    """Runs whose report can be read; a missing or corrupt report gives no row."""
    return runs.join(docs.where("artifact_state = 'ok'"), "pipeline_run_id")


def preferred_run_document(files: DataFrame) -> DataFrame:
    """Per submission the report, else its summary, else the summary of the newest run folder by name.

    An unreadable report counts as not there. ``files`` are paths ``<submission>/[<run>/]<name>``.
    """
    parts = _split(F.col("path"))
    name, depth = F.element_at(parts, -1), F.size(parts)
    doc = F.try_parse_json("content")
    rank = (
        F.when((name == "report.json") & (depth == 2) & doc.isNotNull(), 0)
        .when((name == "summary.json") & (depth == 2), 1)
        .when((name == "summary.json") & (depth == 3), 2)
    )
    run = F.when(depth == 3, F.element_at(parts, 2)).otherwise("")
    candidates = files.select(F.element_at(parts, 1).alias("submission_name"), rank.alias("_rank"), run.alias("run_dir"), "path", doc.alias("doc")).where(
        F.col("_rank").isNotNull() & (F.col("doc").isNotNull() | (F.col("_rank") == 1))
    )
    best = W.partitionBy("submission_name").orderBy("_rank", F.col("run_dir").desc())
    return candidates.withColumn("_nth", F.row_number().over(best)).where("_nth = 1").drop("_nth", "_rank")


def newest_job(manifest: DataFrame, by_name: bool = False) -> DataFrame:
    """Newest job folder per submission and variant, by modification time or by its time-stamped name.

    ``manifest`` has paths ``<submission>/<variant>/<job>/...`` and a ``modified`` time.
    """
    parts = _split(F.col("path"))
    keys = [F.element_at(parts, 1).alias("submission_name"), F.element_at(parts, 2).alias("variant")]
    jobs = manifest.where(F.size(parts) > 3).select(*keys, F.element_at(parts, 3).alias("job"), "modified")
    newest = F.max("job") if by_name else F.max_by("job", F.struct("modified", "job"))
    return jobs.groupBy("submission_name", "variant").agg(newest.alias("job"))


def trial_dirs(manifest: DataFrame, by_name: bool = False) -> DataFrame:
    """Trial folders of the newest jobs: those that hold a verifier folder or a result file."""
    parts = _split(F.col("path"))
    inside = manifest.where(F.size(parts) > 4).select(
        F.element_at(parts, 1).alias("submission_name"), F.element_at(parts, 2).alias("variant"),
        F.element_at(parts, 3).alias("job"), F.element_at(parts, 4).alias("trial_dir"), F.element_at(parts, 5).alias("_what"),
    )
    found = inside.where(F.col("_what").isin("verifier", "result.json")).drop("_what").distinct()
    return found.join(newest_job(manifest, by_name), ["submission_name", "variant", "job"], "left_semi")


def run_dirs(manifest: DataFrame) -> DataFrame:
    """Distinct folders that hold a summary, whatever way their path is written."""
    folder = normal_path(F.regexp_replace("path", r"/?[^/]*\z", ""))
    return manifest.where(F.substring_index("path", "/", -1).isin("summary.yaml", "summary.json")).select(
        folder.alias("run_dir")
    ).distinct()


def after_key(listing: DataFrame, prefix: str = "", last_key: str | None = None, limit: int | None = None) -> DataFrame:
    """Scorecard objects under a prefix, in key order after ``last_key``."""
    chosen = listing.where(F.col("path").startswith(prefix) & F.col("path").endswith("/scorecard.json"))
    if last_key is not None:
        chosen = chosen.where(F.col("path") > last_key)
    ordered = chosen.orderBy("path")
    return ordered if limit is None else ordered.limit(limit)


def metrics_checkpoints(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(calls per phase, timings) from readable ``_metrics_checkpoint.json`` documents."""
    docs = documents(files, "_metrics_checkpoint.json").where("artifact_state = 'ok'")
    usage = docs.select(
        "pipeline_run_id", F.explode(F.try_variant_get("doc", "$.token_usage", "map<string,variant>")).alias("phase", "_u")
    ).select(
        "pipeline_run_id", "phase",
        F.coalesce(F.try_variant_get("_u", "$.prompt_tokens", "bigint"), F.lit(0)).alias("prompt_tokens"),
        F.coalesce(F.try_variant_get("_u", "$.completion_tokens", "bigint"), F.lit(0)).alias("completion_tokens"),
        F.try_variant_get("_u", "$.model_name", "string").alias("model"),
    )
    times = docs.select(
        "pipeline_run_id", F.explode(F.try_variant_get("doc", "$.timings", "map<string,variant>")).alias("phase", "_t")
    ).select(
        "pipeline_run_id", "phase",
        F.try_variant_get("_t", "$.start_time", "double").alias("start_time"),
        F.try_variant_get("_t", "$.end_time", "double").alias("end_time"),
    )
    return usage, times


def submission_files(spark: SparkSession, root: str) -> DataFrame:
    """Submission files: submission_name, file_path (inside it), size, content."""
    files = read_files(spark, root, "*")
    return files.select(
        F.element_at(_split(F.col("path")), 1).alias("submission_name"),
        F.regexp_replace("path", r"\A[^/]+/", "").alias("file_path"),
        "size",
        "content",
    )


# Block style only: a key's direct children share the indentation of its first one (groups 1 and 2).
_BLANK = r"[ \t]*(?:#.*)?\n"
_EVALUATION = (
    rf"(?m)^gate_policy:{_BLANK}(?:{_BLANK})*([ \t]+)"
    rf"(?:(?!evaluation:)[^\s#].*\n(?:{_BLANK}|\1[ \t]+.*\n)*\1(?=\S))*evaluation:"
)
_THRESHOLD = rf"{_BLANK}(?:{_BLANK})*(\1[ \t]+)(?:(?!threshold:)[^\s#].*\n(?:{_BLANK}|\2[ \t]+.*\n)*\2(?=\S))*threshold:[ \t]*([^\s#]*)"
_NUMBER = r"\A['\"]?([-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?)['\"]?\z"


def metadata_thresholds(files: DataFrame, default: float) -> DataFrame:
    """Evaluation threshold of every submission's metadata, ``default`` where it has none.

    ``threshold_state``: own, default, or "not understood" where a policy is written in flow style or the value
    is no number; the threshold is null then.
    """
    text = F.concat(F.regexp_replace("content", r"\r\n?", "\n"), F.lit("\n"))
    written = F.regexp_extract(text, _EVALUATION + _THRESHOLD, 3)
    number = F.nullif(F.regexp_extract(written, _NUMBER, 1), F.lit("")).try_cast("double")
    flow = text.rlike(r"(?m)^gate_policy:[ \t]*[^\s#]") | text.rlike(_EVALUATION + r"[ \t]*[^\s#]")
    has_line = text.rlike(_EVALUATION + _THRESHOLD)
    state = (
        F.when(flow | (has_line & number.isNull()), "not understood").when(number.isNotNull(), "own").otherwise("default")
    )
    return files.where(F.col("file_path") == "metadata.yaml").select(
        "submission_name",
        yaml_scalar(F.col("content"), "name").alias("name"),
        yaml_scalar(F.col("content"), "eval_engine").alias("eval_engine"),
        F.when(state == "own", number).when(state == "default", F.lit(default)).alias("threshold"),
        state.alias("threshold_state"),
    )
