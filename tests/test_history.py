import datetime as dt

import pytest

from trialmill.operators import history

SCHEMA = (
    "submission_name string, pipeline_run_id string, eval_engine string, created_at timestamp, "
    "treatment_pass_rate double, recommendation string, uplift double, control_pass_rate double, "
    "treatment_n_trials int, control_n_trials int"
)


def runs(spark, scores, name="s", engine="harbor"):
    start = dt.datetime(2026, 1, 1)
    rows = [(name, f"{name}-{i}", engine, start + dt.timedelta(days=i), x, "pass", 0.1, 0.5, 5, 5) for i, x in enumerate(scores)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize(
    "scores, degraded, ratio",
    [([0.8], False, None), ([0.8, 0.82], False, 1.025), ([0.9, 0.7], True, 0.7 / 0.9), ([1.0, 0.85], False, 0.85),
     ([1.0, 0.84], True, 0.84), ([0.0, 0.5], False, float("inf")), ([0.0, 0.0], True, 0.0), ([0.1, 0.9, 0.2], True, 0.2 / 0.9)],
)
def test_degradation(spark, scores, degraded, ratio):
    row = history.degradation(runs(spark, scores)).first()
    assert row.degraded is degraded
    assert row.ratio == (None if ratio is None else pytest.approx(ratio))
    assert row.previous_run_id == (f"s-{len(scores) - 2}" if len(scores) > 1 else None)


def test_against_external_score_needs_one_run(spark):
    new = spark.createDataFrame([("s", 0.5, "x"), ("t", 0.5, "y")], "submission_name string, current_score double, current_run_id string")
    got = {r.submission_name: (r.degraded, r.previous_score) for r in history.degradation_against(new, runs(spark, [0.2, 0.9])).collect()}
    assert got == {"s": (True, 0.9), "t": (False, None)}


def test_latest_keeps_ties(spark):
    a = runs(spark, [0.1, 0.2])
    b = runs(spark, [0.3, 0.4], engine="ase").withColumnRenamed("pipeline_run_id", "x")
    both = a.unionByName(b.selectExpr("*", "concat(x, '-ase') AS pipeline_run_id").drop("x"))
    assert {r.pipeline_run_id for r in history.latest_runs(both).collect()} == {"s-1", "s-1-ase"}


def test_variance_of_last_five(spark):
    row = history.score_variance(runs(spark, [9.0, 0.1, 0.2, 0.3, 0.4, 0.5])).first()
    assert row.run_count == 5 and row.score_variance == pytest.approx(0.025) and row.scores == [0.5, 0.4, 0.3, 0.2, 0.1]
    one = history.score_variance(runs(spark, [0.7])).first()
    assert (one.score_variance, one.run_count, one.mean_score) == (0.0, 1, 0.7)


def test_order_of_history_trend_and_latest(spark):
    df = runs(spark, [0.1, 0.2, 0.3])
    assert [r.pipeline_run_id for r in history.history(df, "s").collect()] == ["s-2", "s-1", "s-0"]
    assert [r.pipeline_run_id for r in history.trend(df, "s").collect()] == ["s-0", "s-1", "s-2"]
    assert history.latest_of(df, "s").first().pipeline_run_id == "s-2"


def test_newest_runs_are_limited_before_the_shuffle(spark):
    plan = history.degradation(runs(spark, [0.1, 0.2]))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_positions_pages_and_changes(spark):
    rows = [("a", f"r{i}", i // 2, "pass", i / 10, i / 20, None, i, i) for i in range(7)] + [("b", "x", 3, "fail", None, 0.5, 0.5, 1, 2)]
    schema = (
        "submission_name string, pipeline_run_id string, created_at int, recommendation string, uplift double, "
        "treatment_pass_rate double, control_pass_rate double, treatment_n_trials int, control_n_trials int"
    )
    runs = spark.createDataFrame(rows, schema).repartition(3)
    numbered = history.numbered_history(runs)
    place = {(r.submission_name, r.pipeline_run_id): r.position for r in numbered.collect()}
    assert place == {("a", f"r{i}"): 7 - i for i in range(7)} | {("b", "x"): 1}
    assert sorted(r.pipeline_run_id for r in history.history_page(numbered, 3, after=2).collect()) == ["r2", "r3", "r4"]
    got = {(r.submission_name, r.position): r for r in history.trend_changes(runs).collect()}
    assert got["a", 1].uplift_change is None and got["a", 2].uplift_change == 0.1 and got["a", 5].treatment_n_trials_change == 1
    assert got["a", 3].control_pass_rate_change is None and got["b", 1].uplift_change is None and len(got) == 8
    latest = {r.pipeline_run_id: r.position for r in history.numbered_latest(runs).collect()}
    assert latest == {"r6": 1, "x": 2}
    plan = history.trend_changes(runs)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan  # what was sorted has been written down
