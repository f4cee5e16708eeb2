"""Queries on trials, run summaries, statistical tests and run history."""

from __future__ import annotations

from pyspark.sql import functions as F

from trialmill.functions.stats import significance_marker
from trialmill.operators import history, summary
from trialmill.plans import relations as rel
from trialmill.plans.registry import Registry, rounded

registry = Registry()

TRIALS = """trials AS (
  SELECT 'sub-' || user_id AS submission_name,
         'sub-' || user_id || '-' || strftime(date_trunc('week', ts), '%Y%m%d') AS pipeline_run_id,
         CASE WHEN user_id % 2 = 0 THEN 'harbor' ELSE 'ase' END AS eval_engine,
         CASE WHEN event_id % 2 = 0 THEN 'treatment' ELSE 'control' END AS variant,
         'task__' || event_id AS trial_name,
         CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN 0.0 ELSE least(1.0, value / 100.0) END AS reward,
         ts AS created_at, event_id
  FROM events)"""
ENGINE_TRIALS = """engine_trials AS (
  SELECT submission_name,
         pipeline_run_id || CASE WHEN event_id % 4 < 2 THEN '-h' ELSE '-a' END AS pipeline_run_id,
         CASE WHEN event_id % 4 < 2 THEN 'harbor' ELSE 'ase' END AS eval_engine,
         variant, reward, CAST(date_trunc('week', created_at) AS DATE) AS created_at
  FROM trials)"""


def variant_sql(source: str, head: str, condition: str) -> str:
    f = f"FILTER (WHERE {condition})"
    return f"""
         count(*) {f} AS {head}n_trials,
         count(*) FILTER (WHERE {condition} AND reward > 0) AS {head}n_passed,
         count(*) FILTER (WHERE {condition} AND reward IS NOT NULL AND reward <= 0) AS {head}n_failed,
         count(*) FILTER (WHERE {condition} AND reward IS NULL) AS {head}n_errors,
         coalesce(count(*) FILTER (WHERE {condition} AND reward > 0) / nullif(count(*) {f}, 0), 0.0) AS {head}pass_rate,
         avg(reward) {f} AS {head}mean_reward,
         median(reward) {f} AS {head}median_reward,
         stddev_samp(reward) {f} AS {head}std_reward"""


def paired_sql(source: str, name: str) -> str:
    return f"""{name} AS (
  SELECT submission_name, pipeline_run_id, eval_engine,
         {variant_sql(source, 'treatment_', "variant = 'treatment'")},
         {variant_sql(source, 'control_', "variant = 'control'")}
  FROM {source} GROUP BY ALL)"""


VERDICT = """verdicts AS (
  SELECT *, treatment_pass_rate - control_pass_rate AS uplift,
         treatment_mean_reward - control_mean_reward AS mean_reward_gap,
         CASE WHEN treatment_n_trials = 0 OR control_n_trials = 0 THEN 'fail'
              WHEN treatment_n_passed = 0 AND control_n_passed = 0 THEN 'fail'
              WHEN round(coalesce(treatment_mean_reward - control_mean_reward, treatment_pass_rate - control_pass_rate), 12) >= 0
              THEN 'pass' ELSE 'fail' END AS recommendation,
         (treatment_n_trials BETWEEN 1 AND 14) OR (control_n_trials BETWEEN 1 AND 14) AS small_sample
  FROM paired)"""
RUNS = f"""{TRIALS}, {ENGINE_TRIALS}, {paired_sql('engine_trials', 'paired')}, {VERDICT},
times AS (SELECT pipeline_run_id, min(created_at) AS created_at FROM engine_trials GROUP BY ALL),
runs AS (SELECT v.*, t.created_at FROM verdicts v JOIN times t USING (pipeline_run_id))"""


def r6(names: str) -> str:
    return ", ".join(f"({n}) + 0.0 AS {n}" for n in names.split())


COUNTS = "n_trials n_passed n_failed n_errors"
RATES = "pass_rate mean_reward median_reward std_reward"
PAIRED_COUNTS = ", ".join(f"{v}_{c}" for v in ("treatment", "control") for c in COUNTS.split())
PAIRED_RATES = " ".join(f"{v}_{c}" for v in ("treatment", "control") for c in RATES.split())


@registry.add("trial_rewards", f"WITH {TRIALS} SELECT pipeline_run_id, variant, trial_name, (reward) AS reward, "
              "coalesce(reward > 0, false) AS passed FROM trials")
def trial_rewards(spark, sf):
    df = rel.trials(spark, sf)
    return rounded(
        df.select("pipeline_run_id", "variant", "trial_name", "reward", summary.passed(F.col("reward")).alias("passed"))
    )


@registry.add(
    "variant_summary",
    f"""WITH {TRIALS}, s AS (SELECT submission_name, pipeline_run_id, eval_engine, variant,
        {variant_sql('trials', '', 'true')} FROM trials GROUP BY ALL)
        SELECT submission_name, pipeline_run_id, eval_engine, variant,
               {COUNTS.replace(' ', ', ')}, {r6(RATES)} FROM s""",
)
def variant_summary(spark, sf):
    return rounded(summary.variant_summary(rel.trials(spark, sf)))


@registry.add(
    "ab_analysis",
    f"""WITH {TRIALS}, {paired_sql('trials', 'paired')}, {VERDICT}
        SELECT submission_name, pipeline_run_id, eval_engine, {PAIRED_COUNTS}, {r6(PAIRED_RATES)},
               {r6('uplift mean_reward_gap')}, small_sample, recommendation FROM verdicts""",
)
def ab_analysis(spark, sf):
    return rounded(summary.analyse_ab_runs(rel.trials(spark, sf)).drop("ttest_p_value", "fisher_p_value"))


@registry.add(
    "single_variant_verdict",
    f"""WITH {TRIALS}, s AS (SELECT submission_name, pipeline_run_id, eval_engine,
        {variant_sql('trials', '', 'true')} FROM trials GROUP BY ALL)
        SELECT submission_name, pipeline_run_id, eval_engine, 'treatment' AS variant, {COUNTS.replace(' ', ', ')},
               {r6(RATES)}, (pass_rate) AS uplift, (mean_reward) AS mean_reward_gap,
               n_trials BETWEEN 1 AND 14 AS small_sample,
               CASE WHEN n_passed > 0 AND mean_reward >= 0.5 THEN 'pass' ELSE 'fail' END AS recommendation
        FROM s""",
)
def single_variant_verdict(spark, sf):
    return rounded(summary.analyse_single_runs(rel.trials(spark, sf)))


@registry.add(
    "quick_mean_reward",
    """SELECT 'sub-' || user_id AS submission_name, (avg(coalesce(
           nullif(CASE WHEN event_type = 'view' THEN 0.0 ELSE value / 100.0 END, 0.0),
           CASE WHEN event_id % 3 = 0 THEN NULL ELSE 0.25 END, 0.0))) + 0.0 AS mean_reward
       FROM events GROUP BY ALL""",
)
def quick_mean_reward(spark, sf):
    files = rel.table(spark, sf, "events").select(
        F.concat(F.lit("sub-"), "user_id").alias("submission_name"),
        F.when(F.col("event_type") == "view", 0.0).otherwise(F.col("value") / 100.0).alias("nested_reward"),
        F.when(F.col("event_id") % 3 != 0, 0.25).alias("flat_reward"),
    )
    return rounded(summary.quick_mean(files, ["submission_name"]))


@registry.add(
    "welch_ttest",
    f"""WITH {TRIALS}, {paired_sql('trials', 'paired')}, m AS (
          SELECT pipeline_run_id, treatment_n_trials - treatment_n_errors AS n1, treatment_mean_reward AS m1,
                 treatment_std_reward ^ 2 AS v1, control_n_trials - control_n_errors AS n2,
                 control_mean_reward AS m2, control_std_reward ^ 2 AS v2 FROM paired),
        d AS (SELECT *, (m1 - m2) / sqrt(v1 / n1 + v2 / n2) AS t,
                 (v1 / n1 + v2 / n2) ^ 2 / ((v1 / n1) ^ 2 / (n1 - 1) + (v2 / n2) ^ 2 / (n2 - 1)) AS df
              FROM m WHERE n1 >= 2 AND n2 >= 2 AND v1 + v2 > 0),
        q AS (SELECT pipeline_run_id, df, atan(abs(t) / sqrt(df)) / 400 AS h FROM d),
        g AS (SELECT pipeline_run_id, df, h, unnest(range(401)) AS i FROM q),
        a AS (SELECT pipeline_run_id, any_value(df) AS df, any_value(h) AS h,
                 sum((CASE WHEN i IN (0, 400) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * cos(h * i) ^ (df - 1)) AS s
              FROM g GROUP BY ALL)
        SELECT m.pipeline_run_id, CASE WHEN n1 < 2 OR n2 < 2 THEN NULL WHEN v1 + v2 > 0 THEN
                 (greatest(0.0, 1 - 2 * exp(lgamma((a.df + 1) / 2) - lgamma(a.df / 2)) / sqrt(pi()) * a.s * a.h / 3)) + 0.0
               WHEN m1 <> m2 THEN 0.0 END AS ttest_p_value
        FROM m LEFT JOIN a USING (pipeline_run_id)""",
)
def welch_ttest(spark, sf):
    return rounded(summary.analyse_ab_runs(rel.trials(spark, sf)).select("pipeline_run_id", "ttest_p_value"))


@registry.add(
    "fisher_exact",
    f"""WITH {TRIALS}, {paired_sql('trials', 'paired')}, t AS (
          SELECT pipeline_run_id, treatment_n_passed AS a, treatment_n_failed AS b, control_n_passed AS c,
                 control_n_failed AS d FROM paired),
        x AS (SELECT *, unnest(range(greatest(0, a - d), least(a + b, a + c) + 1)) AS k FROM t
              WHERE a + b > 0 AND c + d > 0),
        p AS (SELECT *, -(lgamma(k + 1) + lgamma(a + b - k + 1) + lgamma(a + c - k + 1) + lgamma(d - a + k + 1)) AS lw,
                 -(lgamma(a + 1) + lgamma(b + 1) + lgamma(c + 1) + lgamma(d + 1)) AS lo FROM x),
        s AS (SELECT pipeline_run_id, sum(exp(lw - lo)) FILTER (WHERE lw <= lo + 1e-7) / sum(exp(lw - lo)) AS p
              FROM p GROUP BY ALL)
        SELECT pipeline_run_id, (p) AS fisher_p_value,
               CASE WHEN p < 0.001 THEN ' ***' WHEN p < 0.01 THEN ' **' WHEN p < 0.05 THEN ' *' ELSE '' END AS marker
        FROM t LEFT JOIN s USING (pipeline_run_id)""",
)
def fisher_exact(spark, sf):
    df = summary.analyse_ab_runs(rel.trials(spark, sf)).select(
        "pipeline_run_id", "fisher_p_value", significance_marker(F.col("fisher_p_value")).alias("marker")
    )
    return rounded(df)


RUN_COLUMNS = "submission_name, pipeline_run_id, eval_engine, CAST(created_at AS VARCHAR) AS created_at, recommendation"


def run_rows(df):
    return rounded(
        df.select(
            "submission_name", "pipeline_run_id", "eval_engine", F.col("created_at").cast("string").alias("created_at"),
            "recommendation", "uplift", "treatment_pass_rate",
        )
    )


@registry.add(
    "latest_runs",
    f"""WITH {RUNS} SELECT {RUN_COLUMNS}, {r6('uplift treatment_pass_rate')} FROM runs
        JOIN (SELECT submission_name, max(created_at) AS created_at FROM runs GROUP BY ALL)
        USING (submission_name, created_at)""",
)
def latest_runs(spark, sf):
    return run_rows(history.list_latest(rel.runs(spark, sf)))


@registry.add("run_history", f"WITH {RUNS} SELECT {RUN_COLUMNS}, {r6('uplift treatment_pass_rate')} FROM runs")
def run_history(spark, sf):
    return run_rows(history.history(rel.runs(spark, sf)))


@registry.add(
    "run_trend",
    f"""WITH {RUNS} SELECT submission_name, pipeline_run_id, CAST(created_at AS VARCHAR) AS created_at, recommendation,
        {r6('uplift treatment_pass_rate control_pass_rate')}, treatment_n_trials, control_n_trials FROM runs""",
)
def run_trend(spark, sf):
    df = history.trend(rel.runs(spark, sf))
    return rounded(df.withColumn("created_at", F.col("created_at").cast("string")))


BY_TIME = "PARTITION BY submission_name ORDER BY created_at, pipeline_run_id"


@registry.add(
    "history_positions",
    f"""WITH {RUNS} SELECT submission_name, pipeline_run_id, row_number() OVER (PARTITION BY submission_name ORDER BY created_at DESC, pipeline_run_id DESC) AS position,
        count(*) OVER (PARTITION BY submission_name) AS rows_of_key FROM runs""",
)
def history_positions(spark, sf):
    return history.numbered_history(rel.runs(spark, sf)).select("submission_name", "pipeline_run_id", "position", "rows_of_key")


@registry.add(
    "trend_changes",
    f"""WITH {RUNS} SELECT submission_name, pipeline_run_id, recommendation, row_number() OVER w AS position, (uplift - lag(uplift) OVER w) + 0.0 AS uplift_change,
        (treatment_pass_rate - lag(treatment_pass_rate) OVER w) + 0.0 AS treatment_pass_rate_change,
        (control_pass_rate - lag(control_pass_rate) OVER w) + 0.0 AS control_pass_rate_change,
        treatment_n_trials - lag(treatment_n_trials) OVER w AS treatment_n_trials_change, control_n_trials - lag(control_n_trials) OVER w AS control_n_trials_change
        FROM runs WINDOW w AS ({BY_TIME})""",
)
def trend_changes(spark, sf):
    df = history.trend_changes(rel.runs(spark, sf))
    return rounded(df.select("submission_name", "pipeline_run_id", "recommendation", "position", *[f"{c}_change" for c in history.TREND]))


@registry.add(
    "latest_positions",
    f"""WITH {RUNS}, top AS (SELECT *, rank() OVER (PARTITION BY submission_name ORDER BY created_at DESC) AS r FROM runs)
        SELECT submission_name, pipeline_run_id, row_number() OVER (ORDER BY created_at DESC, submission_name, pipeline_run_id) AS position FROM top WHERE r = 1""",
)
def latest_positions(spark, sf):
    return history.numbered_latest(rel.runs(spark, sf)).select("submission_name", "pipeline_run_id", "position")


@registry.add(
    "latest_run_of_one",
    f"""WITH {RUNS} SELECT submission_name, CAST(max(created_at) AS VARCHAR) AS created_at FROM runs
        WHERE submission_name = (SELECT min(submission_name) FROM runs) GROUP BY ALL""",
)
def latest_run_of_one(spark, sf):
    runs = rel.runs(spark, sf)
    name = runs.agg(F.min("submission_name")).first()[0]
    return history.latest_of(runs, name).select("submission_name", F.col("created_at").cast("string").alias("created_at"))


def degradation_sql(keys: str, threshold: str, source: str = "runs") -> str:
    return f"""ordered AS (
          SELECT *, row_number() OVER w AS nth, lead(treatment_pass_rate) OVER w AS previous_score,
                 lead(pipeline_run_id) OVER w AS previous_run_id, count(*) OVER (PARTITION BY {keys}) AS n
          FROM {source} WINDOW w AS (PARTITION BY {keys} ORDER BY created_at DESC, pipeline_run_id DESC)),
        judged AS (
          SELECT {keys}, treatment_pass_rate AS current_score, previous_score, pipeline_run_id AS current_run_id,
                 previous_run_id, least(n, 2) AS n_runs, {threshold} AS threshold,
                 CASE WHEN previous_run_id IS NULL THEN NULL
                      WHEN previous_score = 0 THEN CASE WHEN treatment_pass_rate = 0 THEN 0.0 ELSE 'Infinity'::DOUBLE END
                      ELSE treatment_pass_rate / previous_score END AS ratio
          FROM ordered WHERE nth = 1)
        SELECT {keys}, {r6('current_score previous_score threshold ratio')}, current_run_id, previous_run_id, n_runs,
               coalesce(ratio < threshold, false) AS degraded,
               CASE WHEN n_runs < 2 THEN 'Not enough data: found ' || n_runs || ' run(s), need at least 2'
                 WHEN ratio < threshold THEN printf('Degradation detected: score dropped from %.2f%% to %.2f%% (ratio: %.2f < ', previous_score * 100, current_score * 100, ratio) || threshold || ')'
                 ELSE 'No degradation: score is ' || coalesce(printf('%.2f%%', current_score * 100), 'N/A') || ' (ratio: ' || coalesce(printf('%.2f', ratio), 'N/A') || ' >= ' || threshold || ')' END AS message
        FROM judged"""


@registry.add("degradation", f"WITH {RUNS}, {degradation_sql('submission_name', '0.85::DOUBLE')}")
def degradation(spark, sf):
    return rounded(history.degradation(rel.runs(spark, sf)).drop("enough_runs"))


@registry.add(
    "degradation_by_engine", f"WITH {RUNS}, {degradation_sql('submission_name, eval_engine', '0.85::DOUBLE')}"
)
def degradation_by_engine(spark, sf):
    df = history.degradation(rel.runs(spark, sf), by=("submission_name", "eval_engine"))
    return rounded(df.drop("enough_runs"))


MONITORED = """monitored AS (
  SELECT DISTINCT 'sub-' || c_custkey AS submission_name, CASE WHEN c_custkey % 2 = 0 THEN 'harbor' ELSE 'ase' END AS eval_engine,
         CASE WHEN c_custkey % 3 = 0 THEN 0.9 END AS own FROM customer)"""


@registry.add(
    "monitored_degradation",
    f"""WITH {RUNS}, {MONITORED},
        chosen AS (SELECT runs.*, own FROM runs JOIN monitored USING (submission_name, eval_engine)),
        {degradation_sql('submission_name, eval_engine', 'coalesce(own, 0.80)::DOUBLE', 'chosen')}""",
)
def monitored_degradation(spark, sf):
    key = F.col("c_custkey")
    monitored = (
        rel.table(spark, sf, "customer")
        .select(
            F.concat(F.lit("sub-"), key).alias("submission_name"),
            F.when(key % 2 == 0, "harbor").otherwise("ase").alias("eval_engine"),
            F.when(key % 3 == 0, 0.9).alias("threshold"),
        )
        .distinct()
    )
    return rounded(history.monitored_degradation(rel.runs(spark, sf), monitored).drop("enough_runs"))


@registry.add(
    "degradation_of_new_score",
    f"""WITH {RUNS}, incoming AS (SELECT 'sub-' || user_id AS submission_name, avg(CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END)
          AS current_score FROM events GROUP BY ALL),
        last AS (SELECT submission_name, treatment_pass_rate AS previous_score, pipeline_run_id AS previous_run_id FROM runs
          QUALIFY row_number() OVER (PARTITION BY submission_name ORDER BY created_at DESC, pipeline_run_id DESC) = 1),
        j AS (SELECT *, CASE WHEN previous_score = 0 THEN CASE WHEN current_score = 0 THEN 0.0 ELSE 'Infinity'::DOUBLE END
          ELSE current_score / previous_score END AS ratio FROM incoming LEFT JOIN last USING (submission_name))
        SELECT submission_name, {r6('current_score previous_score ratio')}, previous_run_id,
               coalesce(ratio < 0.85, false) AS degraded FROM j""",
)
def degradation_of_new_score(spark, sf):
    incoming = (
        rel.table(spark, sf, "events")
        .groupBy(F.concat(F.lit("sub-"), "user_id").alias("submission_name"))
        .agg(F.avg(F.when(F.col("value") > 50, 1.0).otherwise(0.0)).alias("current_score"))
    )
    df = history.degradation_against(incoming, rel.runs(spark, sf))
    return rounded(
        df.select("submission_name", "current_score", "previous_score", "ratio", "previous_run_id", "degraded")
    )


@registry.add(
    "score_variance",
    f"""WITH {RUNS}, last AS (SELECT * FROM runs QUALIFY row_number() OVER
          (PARTITION BY submission_name ORDER BY created_at DESC, pipeline_run_id DESC) <= 5)
        SELECT submission_name, (coalesce(var_samp(treatment_pass_rate), 0.0)) + 0.0 AS score_variance,
               count(treatment_pass_rate) AS run_count, (avg(treatment_pass_rate)) + 0.0 AS mean_score
        FROM last GROUP BY ALL""",
)
def score_variance(spark, sf):
    return rounded(history.score_variance(rel.runs(spark, sf)).drop("scores"))
