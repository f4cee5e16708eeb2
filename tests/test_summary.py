import math
import random
import statistics
from fractions import Fraction
from math import comb

import pytest
from pyspark.sql import functions as F

from trialmill.functions.stats import fisher_p, log_gamma, significance_marker, student_two_sided, welch_p
from trialmill.operators import summary
from trialmill.operators.hot import spread_median

SCHEMA = "submission_name string, pipeline_run_id string, eval_engine string, variant string, reward double"
MAIN = {"treatment": [1.0, 0.8, 0.6, 0.0, 1.0], "control": [0.5, 0.0, 0.3, 0.0, 0.0]}


def trials(spark, runs):
    rows = [("s", run, "harbor", v, x) for run, sides in runs.items() for v, xs in sides.items() for x in xs]
    return spark.createDataFrame(rows, SCHEMA)


def test_main_fixture(spark):
    row = summary.analyse_ab_runs(trials(spark, {"r": MAIN})).first()
    assert (row.treatment_n_trials, row.treatment_n_passed, row.treatment_n_failed) == (5, 4, 1)
    assert row.treatment_pass_rate == pytest.approx(0.8)
    assert row.treatment_mean_reward == pytest.approx(0.68)
    assert row.ttest_p_value == pytest.approx(0.04809, abs=1e-5)
    assert row.recommendation == "pass" and row.small_sample


def test_one_empty_side_fails_and_has_null_statistics(spark):
    row = summary.analyse_ab_runs(trials(spark, {"r": {"treatment": [1.0, None]}})).first()
    assert row.control_n_trials == 0 and row.control_pass_rate == 0.0 and row.control_mean_reward is None
    assert row.recommendation == "fail" and row.ttest_p_value is None and row.fisher_p_value is None
    assert row.treatment_n_errors == 1 and row.treatment_std_reward is None


def test_nobody_passes_fails(spark):
    row = summary.analyse_ab_runs(trials(spark, {"r": {"treatment": [0.0, 0.0], "control": [0.0]}}), -1.0).first()
    assert row.recommendation == "fail"


def test_threshold_uses_gap_then_uplift(spark):
    df = trials(spark, {"a": {"treatment": [0.9], "control": [0.5]}, "b": {"treatment": [0.5], "control": [None]}})
    got = {r.pipeline_run_id: r.recommendation for r in summary.analyse_ab_runs(df, 0.3).collect()}
    assert got == {"a": "pass", "b": "pass"}
    got = {r.pipeline_run_id: r.recommendation for r in summary.analyse_ab_runs(df, 0.5).collect()}
    assert got == {"a": "fail", "b": "pass"}


def test_summaries_against_plain_python(spark):
    rng = random.Random(3)
    runs = {None: {"treatment": [0.25, None, 0.75, 0.5], "control": [None]}}
    for i in range(12):
        sides = {v: [rng.choice([None, 0.0, rng.random(), 7.5, -2.0]) for _ in range(rng.randrange(0, 40))] for v in MAIN}
        runs[f"r{i}"] = {v: xs for v, xs in sides.items() if xs}
    df = trials(spark, runs).cache()

    def expected(xs):
        known = [x for x in xs if x is not None]
        return (
            len(xs), sum(x > 0 for x in known), sum(x <= 0 for x in known), len(xs) - len(known),
            statistics.mean(known) if known else None, statistics.median(known) if known else None,
            statistics.stdev(known) if len(known) > 1 else None,
        )

    names = "n_trials n_passed n_failed n_errors mean_reward median_reward std_reward".split()

    def same(row, head, xs):
        for name, want in zip(names, expected(xs), strict=True):
            assert row[head + name] == (pytest.approx(want, abs=1e-12) if isinstance(want, float) else want)

    singles = summary.variant_summary(df).collect()
    assert len(singles) == sum(len(sides) for sides in runs.values())
    for row in singles:
        same(row, "", runs[row.pipeline_run_id][row.variant])
    pairs = summary.paired_summary(df).collect()
    assert len(pairs) == sum(bool(sides) for sides in runs.values())
    for row in pairs:
        for v in MAIN:
            same(row, f"{v}_", runs[row.pipeline_run_id].get(v, []))


def test_spread_median_equals_statistics_median(spark):
    rng = random.Random(5)
    data = {g: [rng.choice([rng.gauss(0, 50), rng.random(), 0.0]) for _ in range(n)] for g, n in enumerate((1, 2, 7, 500))}
    rows = [(g, x) for g, xs in data.items() for x in xs]
    got = {r.g: r.m for r in spread_median(spark.createDataFrame(rows, "g int, x double"), ["g"], "x", "m").collect()}
    assert got == pytest.approx({g: statistics.median(xs) for g, xs in data.items()})


def test_spread_median_of_infinite_values_and_nan(spark):
    inf = math.inf
    data = {0: [-inf, 1.0, inf], 1: [inf, inf, 1.0], 2: [-inf, -inf, 5.0], 3: [1e300, 2e300, inf], 4: [1.0, 2.0, math.nan]}
    rows = [(g, x) for g, xs in data.items() for x in xs]
    got = {r.g: r.m for r in spread_median(spark.createDataFrame(rows, "g int, x double"), ["g"], "x", "m").collect()}
    assert got == {0: 1.0, 1: inf, 2: -inf, 3: 2e300, 4: 2.0}


def exact_fisher(a, b, c, d):
    r1, r2, c1 = a + b, c + d, a + c
    terms = [comb(r1, x) * comb(r2, c1 - x) for x in range(max(0, c1 - r2), min(r1, c1) + 1)]
    observed = comb(r1, a) * comb(r2, c)
    return float(Fraction(sum(t for t in terms if t <= observed), sum(terms)))


def test_fisher_against_exact_integers(spark):
    rng = random.Random(1)
    tables = [(5, 5, 5, 5), (0, 7, 3, 4), (80, 40, 60, 60), (1, 0, 0, 1), (0, 3, 0, 3), (3, 0, 3, 0)]
    tables += [tuple(rng.randrange(0, 60) for _ in range(4)) for _ in range(60)]
    tables = [t for t in tables if t[0] + t[1] and t[2] + t[3]]
    df = spark.createDataFrame(tables, "a long, b long, c long, d long")
    for r in df.select("*", fisher_p(*[F.col(x) for x in "abcd"]).alias("p")).collect():
        assert r.p == pytest.approx(exact_fisher(r.a, r.b, r.c, r.d), rel=1e-9)


def test_fisher_empty_row_and_very_large_tables(spark):
    rows = [(0, 0, 1, 2), (30_000, 30_000, 30_300, 29_700), (500_000, 0, 0, 500_000)]
    df = spark.createDataFrame(rows, "a long, b long, c long, d long")
    got = [r.p for r in df.select(fisher_p(*[F.col(x) for x in "abcd"]).alias("p")).collect()]
    assert got[0] is None and got[2] == 0.0
    assert got[1] == pytest.approx(0.0843, abs=5e-4)


def log_space_fisher(a, b, c, d):
    """The whole support, whatever its size, from logarithms of factorials kept as a table of exact-rounded sums."""
    r1, r2, c1 = a + b, c + d, a + c
    low, high = max(0, c1 - r2), min(r1, c1)
    logs = {a: 0.0}
    for x in range(a, high):
        logs[x + 1] = logs[x] + math.log((r1 - x) * (c1 - x) / ((x + 1) * (r2 - c1 + x + 1)))
    for x in range(a, low, -1):
        logs[x - 1] = logs[x] - math.log((r1 - x + 1) * (c1 - x + 1) / (x * (r2 - c1 + x)))
    top = max(logs.values())
    whole = math.fsum(math.exp(v - top) for v in logs.values())
    tail = math.fsum(math.exp(v) for v in logs.values() if v <= 1e-7)
    return math.exp(-top - math.log(whole)) * tail


def test_fisher_has_one_rule_around_twenty_thousand_terms_and_far_beyond(spark):
    tables = [
        (10_100, 9_899, 9_900, 10_099), (10_100, 9_900, 9_900, 10_100), (10_100, 9_901, 9_900, 10_101),
        (250_600, 249_400, 249_400, 250_600), (12_000, 8_001, 8_000, 12_001), (3, 29_997, 40, 29_960),
    ]
    df = spark.createDataFrame(tables, "a long, b long, c long, d long")
    for r in df.select("*", fisher_p(*[F.col(x) for x in "abcd"]).alias("p")).collect():
        assert r.p == pytest.approx(log_space_fisher(r.a, r.b, r.c, r.d), rel=1e-7) and r.p > 0.0


def test_student_tail_against_known_values(spark):
    cases = [(1.0, 1.0, 0.5), (2.0, 2.0, 1 - 2 / math.sqrt(6)), (1.96, 1e9, 0.04999579), (0.0, 5.0, 1.0), (60.0, 1e6, 0.0)]
    df = spark.createDataFrame(cases, "t double, df double, p double")
    for r in df.select("p", student_two_sided(F.col("t"), F.col("df")).alias("got")).collect():
        assert r.got == pytest.approx(r.p, abs=1e-7)


def test_welch_degenerate_cases(spark):
    rows = [(5, 1.0, 0.0, 5, 1.0, 0.0), (5, 1.0, 0.0, 5, 0.5, 0.0), (1, 1.0, None, 5, 0.5, 0.1)]
    df = spark.createDataFrame(rows, "a long, b double, c double, d long, e double, f double")
    got = [r.p for r in df.select(welch_p(*[F.col(x) for x in "abcdef"]).alias("p")).collect()]
    assert got == [None, 0.0, None]


def test_log_gamma_and_markers(spark):
    df = spark.createDataFrame([(x,) for x in (0.5, 1.0, 3.5, 42.0, 170.0)], "x double")
    for r in df.select("x", log_gamma(F.col("x")).alias("g")).collect():
        assert r.g == pytest.approx(math.lgamma(r.x), abs=1e-11)
    marks = spark.createDataFrame([(0.0005,), (0.005,), (0.03,), (0.05,), (None,)], "p double")
    assert [r.m for r in marks.select(significance_marker(F.col("p")).alias("m")).collect()] == [" ***", " **", " *", "", ""]


def test_single_variant_threshold(spark):
    df = trials(spark, {"a": {"x": [0.4, 0.6]}, "b": {"x": [0.2, 0.3]}})
    got = {r.pipeline_run_id: r.recommendation for r in summary.analyse_single_runs(df).collect()}
    assert got == {"a": "pass", "b": "fail"}
    got = {r.pipeline_run_id: r.recommendation for r in summary.analyse_single_runs(df, 0.25).collect()}
    assert got == {"a": "pass", "b": "pass"}


def test_verdict_does_not_depend_on_row_order(spark):
    from trialmill.operators.summary import analyse_ab_runs

    rows = [("s", "r", "e", v, x) for v, xs in (("treatment", (0.3, 0.2, 0.1)), ("control", (0.1, 0.2, 0.3))) for x in xs]
    df = spark.createDataFrame(rows, "submission_name string, pipeline_run_id string, eval_engine string, variant string, reward double")
    for trials in (df.coalesce(1), df.orderBy("reward").coalesce(1), df.orderBy("variant", "reward").repartition(3)):
        assert analyse_ab_runs(trials).first().recommendation == "pass"
