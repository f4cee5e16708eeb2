"""Questions about stored runs: latest, history, trend, score variance and degradation.

All of them keep only the newest few runs per submission through ``row_number``/``rank`` filters,
which Spark also applies before the shuffle, so a submission with very many runs sends a few rows
per task instead of its whole history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from trialmill.functions.ranks import positions
from trialmill.functions.text import decimals, percent

# Fixed values
DEGRADATION_THRESHOLD = 0.85
MONITORED_THRESHOLD = 0.80
VARIANCE_WINDOW = 5


def _newest(keys: list[str], tie: bool = True):
    order = [F.col("created_at").desc()]
    if tie:
        order.append(F.col("pipeline_run_id").desc())
    return W.partitionBy(*keys).orderBy(*order)


def latest_runs(runs: DataFrame) -> DataFrame:
    """Latest run of every submission; runs that share the latest time are all kept."""
    return (
        runs.withColumn("_rank", F.rank().over(_newest(["submission_name"], tie=False)))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def list_latest(runs: DataFrame) -> DataFrame:
    """Every submission's latest run, newest first."""
    return latest_runs(runs).orderBy(F.col("created_at").desc())


def latest_of(runs: DataFrame, submission: str) -> DataFrame:
    return runs.where(F.col("submission_name") == submission).orderBy(F.col("created_at").desc()).limit(1)


def history(runs: DataFrame, submission: str | None = None) -> DataFrame:
    """Runs newest first, of one submission or grouped by submission for all."""
    if submission is not None:
        return runs.where(F.col("submission_name") == submission).orderBy(F.col("created_at").desc())
    return runs.orderBy("submission_name", F.col("created_at").desc())


def trend(runs: DataFrame, submission: str | None = None) -> DataFrame:
    """Verdict, uplift, rates and sizes over time, oldest first."""
    chosen = runs if submission is None else runs.where(F.col("submission_name") == submission)
    order = ["created_at"] if submission is not None else ["submission_name", "created_at"]
    return chosen.select(
        "submission_name", "pipeline_run_id", "created_at", "recommendation", "uplift",
        "treatment_pass_rate", "control_pass_rate", "treatment_n_trials", "control_n_trials",
    ).orderBy(*order)


def numbered_history(runs: DataFrame, oldest_first: bool = False) -> DataFrame:
    """Runs with their ``position`` in the submission's history and ``rows_of_key``, its number of runs.

    Newest first unless ``oldest_first``; equal times are ordered by run id. The order is a column, so nothing is
    sorted as a whole and a submission with most of the runs is no single task.
    """
    order = [F.col("created_at"), F.col("pipeline_run_id")]
    return positions(runs, ["submission_name"], [c.asc() if oldest_first else c.desc() for c in order]).drop("part")


def history_page(numbered: DataFrame, size: int, after: int = 0) -> DataFrame:
    """The runs of every submission that follow position ``after``, ``size`` at most."""
    return numbered.where(F.col("position").between(after + 1, after + size))


def numbered_latest(runs: DataFrame) -> DataFrame:
    """Every submission's latest run with its ``position`` among all of them, newest first."""
    order = [F.col("created_at").desc(), F.col("submission_name").asc(), F.col("pipeline_run_id").asc()]
    return positions(latest_runs(runs), [], order).drop("part", "rows_of_key")


# Fixed values
TREND = ("uplift", "treatment_pass_rate", "control_pass_rate", "treatment_n_trials", "control_n_trials")


def trend_changes(runs: DataFrame) -> DataFrame:
    """Trend with positions, oldest first, and ``<measure>_change`` against the run before; null for the first run.

    Neighbours meet in a join on submission and position, which no submission crowds.
    """
    rows = numbered_history(runs, oldest_first=True).select("submission_name", "pipeline_run_id", "created_at", "recommendation", *TREND, "position")
    before = rows.select("submission_name", (F.col("position") + 1).alias("position"), *(F.col(c).alias(f"_{c}") for c in TREND))
    rows = rows.join(before, ["submission_name", "position"], "left")
    return rows.withColumns({f"{c}_change": F.col(c) - F.col(f"_{c}") for c in TREND}).drop(*(f"_{c}" for c in TREND))


def score_ratio(current: Column, previous: Column) -> Column:
    """current / previous; a previous score of 0 gives 0 for another 0 and infinity otherwise."""
    return (
        F.when(previous == 0, F.when(current == 0, F.lit(0.0)).otherwise(F.lit(float("inf"))))
        .otherwise(F.try_divide(current, previous))
    )


def judge_degradation(pairs: DataFrame, threshold: Column | float) -> DataFrame:
    """Add ratio, verdict and message to rows with current_score, previous_score and enough_runs."""
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))

    def shown(score: str) -> Column:
        return F.coalesce(percent(F.col(score), 2), F.lit("N/A"))

    rate, bound = F.coalesce(decimals(F.col("ratio"), 2), F.lit("N/A")), F.concat(F.col("threshold").cast("string"), F.lit(")"))
    return (
        pairs.withColumn("threshold", limit)
        .withColumn(
            "ratio",
            F.when(F.col("enough_runs"), score_ratio(F.col("current_score"), F.col("previous_score"))),
        )
        .withColumn("degraded", F.coalesce(F.col("ratio") < F.col("threshold"), F.lit(False)))
        .withColumn(
            "message",
            F.when(~F.col("enough_runs"), F.concat(F.lit("Not enough data: found "), "n_runs", F.lit(" run(s), need at least 2")))
            .when(F.col("degraded"), F.concat(F.lit("Degradation detected: score dropped from "), shown("previous_score"), F.lit(" to "), shown("current_score"), F.lit(" (ratio: "), rate, F.lit(" < "), bound))
            .otherwise(F.concat(F.lit("No degradation: score is "), shown("current_score"), F.lit(" (ratio: "), rate, F.lit(" >= "), bound)),
        )
    )


def degradation(
    runs: DataFrame,
    threshold: Column | float = DEGRADATION_THRESHOLD,
    by: tuple[str, ...] = ("submission_name",),
    score: str = "treatment_pass_rate",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Newest run against the one before it, for every submission (and engine, if in ``by``)."""
    keys = list(by)
    recent = (
        runs.withColumn("_nth", F.row_number().over(_newest(keys)))
        .where(F.col("_nth") <= 2)
    )

    def nth(column: str, n: int) -> Column:
        return F.max(F.when(F.col("_nth") == n, F.col(column)))

    pairs = recent.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_runs"),
        nth(score, 1).alias("current_score"),
        nth(score, 2).alias("previous_score"),
        nth("pipeline_run_id", 1).alias("current_run_id"),
        nth("pipeline_run_id", 2).alias("previous_run_id"),
        *[nth(c, 1).alias(c) for c in carry],
    )
    return judge_degradation(pairs.withColumn("enough_runs", F.col("n_runs") >= 2), threshold)


def degradation_against(
    scores: DataFrame,
    runs: DataFrame,
    threshold: Column | float = DEGRADATION_THRESHOLD,
    by: tuple[str, ...] = ("submission_name",),
) -> DataFrame:
    """Scores not stored yet (``current_score``, ``current_run_id``) against the newest stored run."""
    keys = list(by)
    last = (
        runs.withColumn("_nth", F.row_number().over(_newest(keys)))
        .where(F.col("_nth") == 1)
        .select(
            *keys,
            F.col("treatment_pass_rate").alias("previous_score"),
            F.col("pipeline_run_id").alias("previous_run_id"),
        )
    )
    pairs = (
        scores.join(last, keys, "left")
        .withColumn("enough_runs", F.col("previous_run_id").isNotNull())
        .withColumn("n_runs", F.col("enough_runs").cast("int"))
    )
    return judge_degradation(pairs, threshold)


def monitored_degradation(runs: DataFrame, monitored: DataFrame) -> DataFrame:
    """Degradation of monitored submissions, each with its own threshold (0.80 where none is given)."""
    chosen = runs.join(
        monitored.select("submission_name", "eval_engine", F.col("threshold").alias("_own")),
        ["submission_name", "eval_engine"],
    )
    own = F.coalesce(F.col("_own"), F.lit(MONITORED_THRESHOLD))
    return degradation(chosen, own, by=("submission_name", "eval_engine"), carry=("_own",)).drop("_own")


def score_variance(
    runs: DataFrame,
    window: int = VARIANCE_WINDOW,
    by: tuple[str, ...] = ("submission_name",),
    score: str = "treatment_pass_rate",
) -> DataFrame:
    """Variance and mean of the newest ``window`` scores; variance is 0.0 below two scores."""
    keys = list(by)
    recent = runs.withColumn("_nth", F.row_number().over(_newest(keys))).where(F.col("_nth") <= window)
    listed = F.array_sort(F.collect_list(F.when(F.col(score).isNotNull(), F.struct("_nth", score))))
    return recent.groupBy(*keys).agg(
        F.coalesce(F.var_samp(score), F.lit(0.0)).alias("score_variance"),
        F.count(score).alias("run_count"),
        F.avg(score).alias("mean_score"),
        F.transform(listed, lambda s: s[score]).alias("scores"),
    )
